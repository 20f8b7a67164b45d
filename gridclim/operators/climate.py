"""The climate context of a record: normals with terciles, exact grouped percentiles, drought indices and sustained phases.

Everything is sums by key, prefix sums over value or time buckets, and equi-joins: no list of a group's values is made,
and a key that holds a third of all rows is cut by its buckets.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridclim.functions import special
from gridclim.functions.special import let

TERCILES = (1 / 3, 2 / 3)
#: Value buckets within which a group's values are ranked.
BUCKETS = 1024
#: Means of a bin of one year, and sums.
MEANS, SUMS = ("tmax", "tmin", "srad"), ("precip", "et0")
#: Months of the rolling sums of a drought index.
SCALES = (1, 3, 6, 12)
# fixed values: the index at or under which a drought alert has a status
ALERTS = (("red", -1.5), ("yellow", -1.0), ("watch", -0.5))
#: Months of a block of a long series, and the least length of a phase.
BLOCK, SUSTAINED = 512, 5
#: A deviation of composites, which lie in -1 to 1, up to which they are equal but for rounding.
FLAT = 1e-9


# Percentiles


def value_edges(rows: DataFrame, value: str, buckets: int = BUCKETS) -> list[float]:
    """Increasing bounds that part a column's values into about equal numbers: a sketch's percentiles, at most `buckets` doubles. Any
    bounds give right results; these give even ones."""
    marks = rows.agg(F.percentile_approx(value, F.array(*[F.lit(k / buckets) for k in range(1, buckets)]), F.lit(100 * buckets))).first()[0]
    return sorted(set(marks or []))


def grouped_percentiles(rows: DataFrame, keys: list[str], value: str, probabilities: list[float], buckets: int = BUCKETS) -> DataFrame:
    """keys, probability, n and percentile: exact, interpolated between neighbours, for each group.

    Equal values of a group are counted before they meet. Values fall into buckets by bounds over the whole column; the
    buckets' counts, added up by group, tell in which buckets the wanted ranks lie, and only those are ranked by value. So a task ranks
    no more than one bucket of a group, about a `buckets`-th of all rows, however large the group is. Null and NaN values do not
    count; a null key is a key like others; a group without values has no row.
    """
    known = rows.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    edges = value_edges(known, "_v", buckets)
    counted = known.groupBy(*keys, "_v").agg(F.count("*").alias("_n"))
    bucket = Bucketizer(splits=[float("-inf"), *edges, float("inf")], inputCol="_v", outputCol="_b") if edges else None
    counted = (bucket.transform(counted) if bucket else counted.withColumn("_b", F.lit(0.0))).withColumn("_b", F.col("_b").cast("int"))

    by_key = Window.partitionBy(*keys)
    sums = counted.groupBy(*keys, "_b").agg(F.sum("_n").alias("_in"))
    placed = sums.withColumn("_end", F.sum("_in").over(by_key.orderBy("_b"))).withColumn("_all", F.sum("_in").over(by_key))
    rank = (F.col("_all") - 1) * F.col("_p")
    asked = F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("_p")
    ranks = placed.select("*", asked).select("*", F.explode(F.array_distinct(F.array(F.floor(rank), F.ceil(rank)))).alias("_rank"))
    begin = F.col("_end") - F.col("_in")
    wanted = ranks.where((F.col("_rank") >= begin) & (F.col("_rank") < F.col("_end"))).select(*keys, "_b", begin.alias("_begin"), "_all", "_p", "_rank")
    open_ = wanted.groupBy(*keys, "_b").agg(F.min("_begin").alias("_begin"), F.collect_list(F.struct("_p", "_rank", "_all")).alias("_asked"))

    inner = counted.alias("c").join(open_.alias("o"), [F.col(f"c.{k}").eqNullSafe(F.col(f"o.{k}")) for k in [*keys, "_b"]]).select("c.*", "_begin", "_asked")
    upto = F.sum("_n").over(Window.partitionBy(*keys, "_b").orderBy("_v")) + F.col("_begin")
    ranked = inner.withColumn("_upto", upto).select("*", F.explode("_asked").alias("_a")).where((F.col("_a._rank") < F.col("_upto")) & (F.col("_a._rank") >= F.col("_upto") - F.col("_n")))
    low, high = F.min("_v"), F.max("_v")
    found = ranked.groupBy(*keys, F.col("_a._p").alias("_p")).agg(low.alias("_low"), high.alias("_high"), F.first("_a._all").alias("n"))
    exact = (F.col("n") - 1) * F.col("_p")
    return found.select(*keys, F.col("_p").alias("probability"), "n", (F.col("_low") + (F.col("_high") - F.col("_low")) * (exact - F.floor(exact))).alias("percentile"))


# Normals


def pentad(date) -> Column:
    """Number of the five days of a year, 1 to 73. 29 February belongs to the twelfth, so that bins hold the same days every year."""
    day, year = F.dayofyear(date), F.year(date)
    leap = (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))
    return F.floor((day - F.when(leap & (day > 60), 1).otherwise(0) - 1) / 5).cast("int") + 1


def normals(rows: DataFrame, keys: list[str], first_year: int, last_year: int, scale: str = "month", means=MEANS, sums=SUMS, terciles_of: str = "precip") -> DataFrame:
    """keys, period, scale, bin, n_years, the mean over years of each variable, and sd, p33 and p67 of `terciles_of`.

    A bin (a month, or a pentad of a year) of a year is first a mean or a sum of its days; the statistics are over the years of the
    baseline that have the variable at all. A bin without years has no row; n_years counts those with any row, so that a normal from few
    years shows. sd is that of a sample, null for one year.
    """
    if scale not in ("month", "pentad"):
        raise ValueError(f"unknown scale {scale!r}; known: month, pentad")
    in_bin = F.month("date") if scale == "month" else pentad("date")
    inside = rows.where(F.col("date").between(F.lit(f"{first_year}-01-01").cast("date"), F.lit(f"{last_year}-12-31").cast("date")))
    yearly = inside.groupBy(*keys, in_bin.cast("int").alias("bin"), F.year("date").alias("year")).agg(*[F.avg(c).alias(c) for c in means], *[F.sum(c).alias(c) for c in sums])
    by = [*keys, "bin"]
    out = yearly.groupBy(*by).agg(F.count("*").alias("n_years"), *[F.avg(c).alias(f"{c}_mean") for c in (*means, *sums)], F.stddev_samp(terciles_of).alias(f"{terciles_of}_sd"))
    parts = grouped_percentiles(yearly, by, terciles_of, list(TERCILES))
    wide = parts.groupBy(*by).agg(*[F.max(F.when(F.col("probability") == p, F.col("percentile"))).alias(f"{terciles_of}_{name}") for p, name in zip(TERCILES, ("p33", "p67"), strict=True)])
    met = out.alias("a").join(wide.alias("b"), [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in by], "left").select("a.*", f"{terciles_of}_p33", f"{terciles_of}_p67")
    return met.select(*keys, F.lit(f"{first_year}-{last_year}").alias("period"), F.lit(scale).alias("scale"), *[c for c in met.columns if c not in keys])


# Drought


def month_number(date) -> Column:
    return (F.year(date) * 12 + F.month(date) - 1).cast("int")


def month_start(number) -> Column:
    return F.make_date(F.floor(F.col(number) / 12).cast("int"), F.col(number) % 12 + 1, F.lit(1))


def rolling_sums(monthly: DataFrame, keys: list[str], value: str = "precip", scales=SCALES) -> DataFrame:
    """keys, month (its number), scale, total: the sum of a month and those before it, where all of them are there and not null.

    Each month is dealt to the months whose sums it enters and added up there, so partial sums go before the shuffle and a long series is
    not gathered.
    """
    each = F.explode(F.array(*[F.struct(F.lit(s).alias("scale"), F.lit(k).alias("after")) for s in scales for k in range(s)])).alias("e")
    dealt = monthly.where(F.col(value).isNotNull()).select(*keys, F.col("month").alias("_m"), F.col(value).alias("_x"), each)
    sums = dealt.groupBy(*keys, (F.col("_m") + F.col("e.after")).alias("month"), F.col("e.scale").alias("scale")).agg(F.sum("_x").alias("total"), F.count("*").alias("_k"), F.max("_m").alias("_last"))
    return sums.where((F.col("_k") == F.col("scale")) & (F.col("_last") == F.col("month"))).select(*keys, "month", "scale", "total")


def gamma_fit(sums: DataFrame, keys: list[str], baseline: tuple[int, int] | None = None) -> DataFrame:
    """keys, scale, calendar (1 to 12), n, dry (share of sums of zero), alpha, beta: a gamma distribution of each calendar month's
    sums, by Thom's estimate from their mean and mean logarithm, so from sums of x and log x alone.

    alpha is null where fewer than two different sums are positive.
    """
    inside = sums if baseline is None else sums.where(_in_years(baseline))
    by = [*keys, "scale", "calendar"]
    fit = inside.withColumn("calendar", F.col("month") % 12 + 1).groupBy(*by).agg(*[x.alias(n) for n, x in _moments(F.lit(True)).items()])
    return fit.select(*by, "n", *[x.alias(n) for n, x in _gamma().items()])


def _in_years(baseline: tuple[int, int]) -> Column:
    return F.col("month").between(baseline[0] * 12, baseline[1] * 12 + 11)


def _moments(inside: Column) -> dict[str, Column]:
    """What a gamma distribution takes of the totals that are inside."""
    wet = inside & (F.col("total") > 0)
    x, log = F.when(wet, F.col("total")), F.when(wet, F.log("total"))
    return {"n": F.count_if(inside), "_dry": F.count_if(inside & ~(F.col("total") > 0)), "_mean": F.avg(x), "_log": F.avg(log), "_a": F.min(x), "_b": F.max(x)}


def _gamma() -> dict[str, Column]:
    gap = F.log("_mean") - F.col("_log")
    alpha = F.when((F.col("_a") < F.col("_b")) & (gap > 0), (1 + F.sqrt(1 + 4 * gap / 3)) / (4 * gap))
    return {"dry": F.col("_dry") / F.col("n"), "alpha": alpha, "beta": F.col("_mean") / alpha}


def drought_index(monthly: DataFrame, keys: list[str], value: str = "precip", scales=SCALES, baseline: tuple[int, int] | None = None) -> DataFrame:
    """keys, month (its number), scale, total, spi: the standardised precipitation index of each month's rolling sums.

    The probability of a sum is that of its calendar month's gamma distribution, with the share of dry sums put before it, and the index
    the normal's quantile of it. Null where there is no fit, or where nothing is as low: a sum of zero with no dry ones in the baseline.
    """
    sums = rolling_sums(monthly, keys, value, scales)
    # a window and no join: a key's months of one name are as many as its years, and the sums are not computed twice
    years = Window.partitionBy(*keys, "scale", "calendar")
    moments = {n: x.over(years) for n, x in _moments(F.lit(True) if baseline is None else _in_years(baseline)).items()}
    fit = sums.withColumn("calendar", F.col("month") % 12 + 1).withColumns(moments).withColumns({n: F.when(F.col("n") > 0, x) for n, x in _gamma().items()})
    chance = F.col("dry") + (1 - F.col("dry")) * special.gamma_p(F.col("alpha"), F.col("total") / F.col("beta"))
    found = fit.select(*keys, "month", "scale", "total", F.when(F.col("alpha").isNotNull(), chance).alias("_p"))
    return found.withColumn("spi", special.normal_quantile(F.col("_p"))).drop("_p")


def alert_status(spi: Column) -> Column:
    """Status of an index: the first of ALERTS whose limit it does not pass, else green; null stays null."""
    status = F.when(spi.isNotNull(), F.lit("green"))
    for name, limit in reversed(ALERTS):
        status = F.when(spi <= limit, F.lit(name)).otherwise(status)
    return status


def drought_alerts(index: DataFrame, shares: DataFrame, keys: list[str], unit: str = "admin_id", share: str = "share") -> DataFrame:
    """unit, as_of, scale, spi, n_cells, status: the mean index of a unit's cells by their share of area in it.

    shares: keys, unit, share. Cells without an index do not count.
    """
    # no filter before the sums, which would compute each index once more
    met = index.join(shares, keys)
    known = F.when(F.col("spi").isNotNull(), F.col(share))
    sums = met.groupBy(unit, F.col("month").alias("_m"), "scale").agg(F.sum(F.col("spi") * F.col(share)).alias("_s"), F.sum(known).alias("_w"), F.count("spi").alias("n_cells"))
    found = sums.where("n_cells > 0").select(unit, "_m", "scale", (F.col("_s") / F.col("_w")).alias("spi"), "n_cells")
    return found.select(unit, month_start("_m").alias("as_of"), "scale", "spi", "n_cells", alert_status(F.col("spi")).alias("status"))


# Phases


def sustained_phases(index: DataFrame, keys: list[str], value: str = "value", step: str = "month", threshold: float = 0.5, least: int = SUSTAINED, block: int = BLOCK) -> DataFrame:
    """The rows with `phase` (1, -1, 0) and `length`: a stretch of steps all at or beyond a threshold counts from `least` steps on, and
    then for each of its steps, back to the first.

    A stretch ends at a missing step, a null value or another sign. Its number is a prefix sum of the stretches' starts: within
    blocks of steps, and over the blocks' sums, so that one long series is dealt to many tasks. Steps are whole numbers, one
    row each.
    """
    sign = F.when(F.col(value) >= threshold, 1).when(F.col(value) <= -threshold, -1).otherwise(0)
    rows = index.withColumn("_s", sign).withColumn("_block", F.floor(F.col(step) / block).cast("long"))
    before = rows.select(*[F.col(k).alias(f"_k{n}") for n, k in enumerate(keys)], (F.col(step) + 1).alias("_t"), F.col("_s").alias("_before"))
    same = [F.col(k).eqNullSafe(F.col(f"_k{n}")) for n, k in enumerate(keys)]
    marked = rows.join(before, [*same, F.col(step) == F.col("_t")], "left").select(*rows.columns, F.when(F.col("_before") == F.col("_s"), 0).otherwise(1).alias("_new"))
    base = marked.groupBy(*keys, "_block").agg(F.sum("_new").alias("_n")).withColumn("_base", F.sum("_n").over(Window.partitionBy(*keys).orderBy("_block")) - F.col("_n")).drop("_n")
    inner = F.sum("_new").over(Window.partitionBy(*keys, "_block").orderBy(step))
    at = marked.withColumn("_in", inner).alias("m").join(base.alias("b"), [F.col(f"m.{k}").eqNullSafe(F.col(f"b.{k}")) for k in [*keys, "_block"]])
    islands = at.select("m.*", (F.col("_in") + F.col("_base")).alias("_island"))
    sizes = islands.groupBy(*keys, "_island").agg(F.count("*").alias("_size"))
    met = islands.alias("i").join(sizes.alias("z"), [F.col(f"i.{k}").eqNullSafe(F.col(f"z.{k}")) for k in [*keys, "_island"]])
    held = (F.col("_s") != 0) & (F.col("_size") >= least)
    return met.select(*[f"i.{c}" for c in index.columns], F.when(held, F.col("_s")).otherwise(0).cast("int").alias("phase"), F.when(held, F.col("_size")).otherwise(0).cast("long").alias("length"))


def seasonal_anomaly(monthly: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """keys, month, value: three-month means of the anomalies from each calendar month's mean, where the month and both neighbours are there."""
    by = [*keys, "_c"]
    known = monthly.where(F.col(value).isNotNull()).withColumn("_c", F.col("month") % 12)
    usual = known.groupBy(*by).agg(F.avg(value).alias("_usual"))
    off = known.alias("k").join(usual.alias("u"), [F.col(f"k.{c}").eqNullSafe(F.col(f"u.{c}")) for c in by]).select(*[f"k.{k}" for k in keys], "month", (F.col(value) - F.col("_usual")).alias("_off"))
    dealt = off.select(*keys, "month", "_off", F.explode(F.array(*map(F.lit, (-1, 0, 1)))).alias("_d"))
    sums = dealt.groupBy(*keys, (F.col("month") + F.col("_d")).alias("month")).agg(F.avg("_off").alias("value"), F.count("*").alias("_n"))
    return sums.where("_n = 3").select(*keys, "month", "value")


# Forecast skill


def hindcast_skill(hindcasts: DataFrame, observed: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """keys, calendar (1 to 12), lead, n_years, hindcast_mean, hindcast_sd, obs_mean, obs_sd, bias and skill_acc, the anomaly
    correlation of hindcasts with what was observed in their target month.

    hindcasts: keys, init (month number), lead (months), value; of members and of several issues in a month the mean counts. observed:
    keys, month, value, one row for each month. A hindcast is verified by the observation of init + lead. Anomalies are from the
    climatology of the other years: with n years, that of year i is x_i - (S - x_i) / (n - 1), which is n / (n - 1) times the plain anomaly, so
    leaving a year out needs the sums alone: one pass over the pairs and no join of years with each other. Null with fewer than three
    years, or where either side does not vary.
    """
    target = (F.col("init") + F.col("lead")).cast("int")
    issued = hindcasts.where(F.col(value).isNotNull()).groupBy(*keys, target.alias("month"), F.col("lead").cast("int").alias("lead")).agg(F.avg(value).alias("_x"))
    seen = observed.where(F.col(value).isNotNull()).select(*keys, F.col("month").cast("int").alias("month"), F.col(value).cast("double").alias("_y"))
    by = [*keys, "month"]
    met = issued.alias("h").join(seen.alias("o"), [F.col(f"h.{k}").eqNullSafe(F.col(f"o.{k}")) for k in by]).select(*[f"h.{k}" for k in by], "lead", "_x", "_y")
    moments = met.groupBy(*keys, (F.col("month") % 12 + 1).alias("calendar"), "lead").agg(
        F.count("*").alias("n_years"), F.avg("_x").alias("hindcast_mean"), F.stddev_samp("_x").alias("hindcast_sd"), F.avg("_y").alias("obs_mean"), F.stddev_samp("_y").alias("obs_sd"), F.covar_samp("_x", "_y").alias("_c")
    )
    left_out = F.pow(F.col("n_years") / (F.col("n_years") - 1), F.lit(2.0))
    spread = left_out * F.col("hindcast_sd") * F.col("obs_sd")
    acc = F.when((F.col("n_years") >= 3) & (spread > 0), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), left_out * F.col("_c") / spread)))
    return moments.withColumn("bias", F.col("hindcast_mean") - F.col("obs_mean")).withColumn("skill_acc", acc).drop("_c")


def calibrated(forecasts: DataFrame, skill: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """The forecasts (keys, init, lead, value) with `calibrated`, the value less its bias, and the skill_acc of its month and lead; null
    without hindcasts. skill holds twelve months and a few leads of a key, and joins by them."""
    by = [*keys, "calendar", "lead"]
    rows = forecasts.withColumn("calendar", ((F.col("init") + F.col("lead")) % 12 + 1).cast("int"))
    met = rows.alias("f").join(skill.select(*by, "bias", "skill_acc").alias("s"), [F.col(f"f.{k}").eqNullSafe(F.col(f"s.{k}")) for k in by], "left")
    return met.select(*[f"f.{c}" for c in forecasts.columns], (F.col(value) - F.col("bias")).alias("calibrated"), "skill_acc")


# Analogue years


def year_vectors(monthly: DataFrame, keys: list[str], variables: list[str]) -> DataFrame:
    """keys, year, part (a month and variable), z: each value standardised over the years of its key, month and variable.

    monthly: keys, month (its number) and the variables. A part without two different values says nothing and is left out; null values are missing.
    """
    each = F.explode(F.array(*[F.struct(F.lit(v).alias("variable"), F.col(v).cast("double").alias("x")) for v in variables])).alias("e")
    long = monthly.select(*keys, F.floor(F.col("month") / 12).cast("int").alias("year"), (F.col("month") % 12 + 1).cast("int").alias("calendar"), each).select(*keys, "year", "calendar", "e.*").where("x is not null")
    by = [*keys, "calendar", "variable"]
    usual = long.groupBy(*by).agg(F.avg("x").alias("_m"), F.stddev_samp("x").alias("_s")).where("_s > 0")
    met = long.alias("l").join(usual.alias("u"), [F.col(f"l.{k}").eqNullSafe(F.col(f"u.{k}")) for k in by])
    return met.select(*[f"l.{k}" for k in keys], "year", F.concat_ws(":", "l.calendar", "l.variable").alias("part"), ((F.col("x") - F.col("_m")) / F.col("_s")).alias("z"))


def analogue_years(monthly: DataFrame, keys: list[str], variables: list[str], targets: list[int], months: list[int], k: int = 3) -> DataFrame:
    """keys, target, rank, year, distance, n_parts: for each key and target year the k nearest other years, by the root mean square
    of the differences of their standardised months and variables.

    Only parts that both years have count, and a year needs at least half of the target's. Years meet the targets alone, on the part, and the
    sums of squares go before the shuffle; the k best are kept by a bounded rank before and after it. Ties go to the earlier year.
    """
    vectors = year_vectors(monthly.where((F.col("month") % 12 + 1).isin(months)), keys, variables)
    asked = vectors.where(F.col("year").isin(targets)).select(*keys, F.col("year").alias("target"), "part", F.col("z").alias("_t"))
    sizes = asked.groupBy(*keys, "target").agg(F.count("*").alias("_all"))
    by = [*keys, "part"]
    met = vectors.alias("v").join(asked.alias("a"), [*[F.col(f"v.{c}").eqNullSafe(F.col(f"a.{c}")) for c in by], F.col("year") != F.col("target")])
    sums = met.groupBy(*[F.col(f"v.{c}").alias(c) for c in keys], "target", "year").agg(F.sum(F.pow(F.col("z") - F.col("_t"), F.lit(2.0))).alias("_d"), F.count("*").alias("n_parts"))
    both = [*keys, "target"]
    known = sums.alias("s").join(sizes.alias("n"), [F.col(f"s.{c}").eqNullSafe(F.col(f"n.{c}")) for c in both]).where(2 * F.col("n_parts") >= F.col("_all"))
    found = known.select(*[f"s.{c}" for c in both], "year", F.round(F.sqrt(F.col("_d") / F.col("n_parts")), 9).alias("distance"), "n_parts")
    order = Window.partitionBy(*both).orderBy("distance", "year")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(*both, "rank", "year", "distance", "n_parts")


# Vegetation


def dekad(date) -> Column:
    """Number of the ten days of a year, 1 to 36: three a month, the last with what is left of it."""
    return ((F.month(date) - 1) * 3 + F.least(F.lit(3), F.ceil(F.dayofmonth(date) / 10))).cast("int")


def dekad_start(year: str, number: str) -> Column:
    return F.make_date(F.col(year), F.floor((F.col(number) - 1) / 3).cast("int") + 1, (F.col(number) - 1) % 3 * 10 + 1)


def vegetation_composites(scenes: DataFrame, keys: list[str], worst: int = 1) -> DataFrame:
    """keys, year, dekad, ndvi, n_scenes: the largest value of the scenes of the best quality flag of ten days.

    scenes: keys, date, ndvi, quality (0 is best). Scenes whose flag is over `worst` or null, and values that are null or outside -1 to 1, do not
    count: ten days without another have no row.
    """
    sound = F.col("ndvi").between(-1.0, 1.0) & (F.col("quality") <= worst)
    rows = scenes.where(sound).groupBy(*keys, F.year("date").alias("year"), dekad("date").alias("dekad"), "quality").agg(F.max("ndvi").alias("ndvi"), F.count("*").alias("_n"))
    return rows.groupBy(*keys, "year", "dekad").agg(F.min_by("ndvi", "quality").alias("ndvi"), F.sum("_n").alias("n_scenes"))


def vegetation_anomaly(scenes: DataFrame, keys: list[str], first_year: int, last_year: int, worst: int = 1) -> DataFrame:
    """keys, dekad_start, ndvi, ndvi_lta, anomaly_pct, z: each composite against the same ten days of the other years.

    Every ten days of the years has a row for each key with any scene in them, so missing composites show, as nulls. The long-term mean and
    deviation are those of the other years' values themselves, of which a key's ten days have one a year: subtracting a year from sums over all leaves
    rounding noise where the others are equal. Null with fewer than two other years, z also where they vary by no more than FLAT.
    """
    inside = scenes.where(F.col("date").between(F.lit(f"{first_year}-01-01").cast("date"), F.lit(f"{last_year}-12-31").cast("date")))
    found = vegetation_composites(inside, keys, worst)
    spans = inside.select(*keys).distinct().select("*", F.explode(F.sequence(F.lit(first_year), F.lit(last_year))).alias("year")).select("*", F.explode(F.sequence(F.lit(1), F.lit(36))).alias("dekad"))
    by = [*keys, "year", "dekad"]
    same = lambda a, b, names: [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in names]
    every = spans.alias("a").join(found.alias("b"), same("a", "b", by), "left").select(*[f"a.{k}" for k in by], "ndvi")
    years = found.groupBy(*keys, "dekad").agg(F.sort_array(F.collect_list(F.struct("year", "ndvi"))).alias("_years"))
    met = every.alias("e").join(years.alias("y"), same("e", "y", [*keys, "dekad"]), "left").select(*[f"e.{k}" for k in by], "ndvi", "_years")
    others = F.transform(F.filter("_years", lambda y: y["year"] != F.col("year")), lambda y: y["ndvi"])
    added = lambda values, of: F.aggregate(values, F.lit(0.0), lambda total, v: total + of(v))

    def statistics(values: Column) -> Column:
        n = F.size(values)
        mean = F.when(n >= 2, added(values, lambda v: v) / n)
        return let(mean, lambda m: F.struct(m.alias("mean"), F.sqrt(added(values, lambda v: (v - m) * (v - m)) / (n - 1)).alias("sd")))

    known = met.withColumn("_o", let(others, statistics))
    out = known.withColumn("ndvi_lta", F.col("_o.mean")).withColumn("_sd", F.when(F.col("_o.mean").isNotNull(), F.col("_o.sd")))
    pct = F.when(F.col("ndvi_lta") != 0, (F.col("ndvi") - F.col("ndvi_lta")) / F.abs("ndvi_lta") * 100)
    z = F.when(F.col("_sd") > FLAT, (F.col("ndvi") - F.col("ndvi_lta")) / F.col("_sd"))
    return out.select(*keys, dekad_start("year", "dekad").alias("dekad_start"), "ndvi", "ndvi_lta", pct.alias("anomaly_pct"), z.alias("z"))
