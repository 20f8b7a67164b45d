"""Sub-daily observations to local days, long to wide, units, derived variables and quality checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridclim.functions import physics, text

# fixed values: how each native variable is reduced over a day
REDUCERS = {"tmax": "max", "tmin": "min", "precip": "sum", "srad": "sum", "wind_u": "mean", "wind_v": "mean", "tdew": "mean"}
NATIVE = list(REDUCERS)
KEYS = ["parent_id", "child_id", "date"]
# fixed value: the largest plausible daily rain of the fine products, in mm
MOST_RAIN = 1444.34


def local_day_reduce(hourly: DataFrame, keys: list[str], minutes: str = "t_zone") -> DataFrame:
    """keys, date, variable, value: each variable's own reduction over the cell's local day. One shuffle, partial sums first."""
    by = hourly.groupBy(*keys, text.local_date("ts", minutes).alias("date"), "variable").agg(F.max("value").alias("_max"), F.min("value").alias("_min"), F.sum("value").alias("_sum"), F.avg("value").alias("_mean"))
    pick: Column = F.lit(None).cast("double")
    for name, how in REDUCERS.items():
        pick = F.when(F.col("variable") == name, F.col(f"_{how}")).otherwise(pick)
    return by.select(*keys, "date", "variable", pick.alias("value")).where("value is not null")


def to_wide(long: DataFrame, keys: list[str] = KEYS, variables: list[str] = NATIVE) -> DataFrame:
    """One row for each key with a column for each variable, in stored units; a variable without rows is null.

    One aggregation instead of a chain of outer joins; a key has one value of a variable at most.
    """
    picked = [physics.convert(v, F.max(F.when(F.col("variable") == v, physics.known("value")))).alias(v) for v in variables]
    return long.groupBy(*keys).agg(*picked)


def with_wind(wide: DataFrame) -> DataFrame:
    """Speed in place of its parts, and accumulations a hair below zero set to zero."""
    wide = wide.withColumn("wind", physics.wind_speed("wind_u", "wind_v")).drop("wind_u", "wind_v")
    return wide.withColumns({c: physics.snap_noise(c) for c in ("precip", "srad")})


def add_derived(wide: DataFrame, meta: DataFrame) -> DataFrame:
    """rh, and et0 for cells in meta (child_id, lat, elevation); other cells have a null et0."""
    known = wide.join(meta.select("child_id", F.col("lat").alias("_lat"), F.col("elevation").alias("_z")), "child_id", "left")
    et0 = physics.et0("tmax", "tmin", "srad", "wind", "tdew", "_z", "_lat", F.dayofyear("date"))
    return known.withColumns({"rh": physics.relative_humidity("tmax", "tmin", "tdew"), "et0": et0}).drop("_lat", "_z")


def build_wide(long: DataFrame, meta: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    return add_derived(with_wind(to_wide(long, keys)), meta)


def checks() -> list[tuple[str, Column]]:
    c = F.col
    return [("tmax<tmin", c("tmax") < c("tmin")), ("precip<0", c("precip") < 0), ("srad<0", c("srad") < 0), ("rh_out_of_range", (c("rh") < 0) | (c("rh") > 100)), ("et0<0", c("et0") < 0)]


def fine_checks() -> list[tuple[str, Column]]:
    return [("precip<0", F.col("precip") < 0), ("precip>max", F.col("precip") > MOST_RAIN)]


def reason(rules: list[tuple[str, Column]]) -> Column:
    """Names of the rules a row breaks, in their order, joined by semicolons; empty for none. A null breaks no rule."""
    return F.concat_ws(";", *[F.when(broken, F.lit(name)) for name, broken in rules])


def split_valid(rows: DataFrame, rules: list[tuple[str, Column]] | None = None) -> tuple[DataFrame, DataFrame]:
    """Good rows, and failures with their reason."""
    judged = rows.withColumn("reason", reason(rules or checks()))
    return judged.where("reason = ''").drop("reason"), judged.where("reason <> ''")


def to_long(wide: DataFrame, keys: list[str], variables: list[str] = text.VARIABLES) -> DataFrame:
    """keys, variable, value; nulls stay."""
    if unknown := [v for v in variables if v not in text.VARIABLES]:
        raise ValueError(f"unknown variables: {unknown}")
    return wide.select(*keys, *[F.col(v).cast("double").alias(v) for v in variables]).unpivot(keys, variables, "variable", "value")


def calendar_report(rows: DataFrame, year: int | None = None, keys: list[str] = KEYS[:2]) -> DataFrame:
    """Days present, expected and missing of each cell that has rows; expected are the year's days or those first to last."""
    span = F.datediff(F.max("date"), F.min("date")) + 1 if year is None else F.lit(366 if year % 4 == 0 and (year % 100 or year % 400 == 0) else 365)
    found = rows.groupBy(*keys).agg(F.count_distinct("date").alias("n_dates"), span.cast("long").alias("expected"))
    return found.withColumn("missing", F.col("expected") - F.col("n_dates"))


def missing_days(rows: DataFrame, keys: list[str], first: str | None = None, last: str | None = None) -> DataFrame:
    """keys, missing_date: calendar days without a row, from the cell's own first day to its last unless given."""
    given = lambda d, own: F.lit(d).cast("date") if d else own
    spans = rows.groupBy(*keys).agg(given(first, F.min("date")).alias("_a"), given(last, F.max("date")).alias("_b"))
    days = spans.select(*keys, F.explode(F.sequence("_a", "_b")).alias("date"))
    return days.join(rows.select(*keys, "date"), [*keys, "date"], "left_anti").withColumnRenamed("date", "missing_date")


def quality_summary(rows: DataFrame, failures: DataFrame, keys: list[str] = KEYS[:2]) -> DataFrame:
    """Counts of each cell: days, nulls, preliminary, repaired and impossible rows, and rows in quarantine."""
    c = F.col
    impossible = F.coalesce(c("tmax") < c("tmin"), F.lit(False)) | F.coalesce(c("precip") < 0, F.lit(False)) | F.coalesce((c("rh") < 0) | (c("rh") > 100), F.lit(False)) | F.coalesce(c("srad") < 0, F.lit(False))
    found = rows.groupBy(*keys).agg(
        F.count("*").alias("days_present"),
        F.count_if(c("tmax").isNull() | c("tmin").isNull()).alias("null_temp"),
        F.count_if(c("srad").isNull()).alias("null_srad"),
        F.count_if(c("precip").isNull()).alias("null_rain"),
        F.count_if(F.coalesce(c("is_preliminary"), F.lit(False))).alias("preliminary"),
        F.count_if(F.coalesce(c("imputed"), F.lit(0)) != 0).alias("repaired"),
        F.count_if(impossible).alias("impossible"),
    )
    bad = failures.groupBy(*keys).agg(F.count("*").alias("quarantined"))
    return found.join(bad, keys, "left").fillna(0, ["quarantined"])


def monthly(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Means and sums of each calendar month."""
    mean, total = ["tmax", "tmin", "srad", "wind", "rh"], ["precip", "et0"]
    return rows.groupBy(*keys, F.trunc("date", "month").alias("month")).agg(F.count("*").alias("n_days"), *[F.avg(c).alias(f"{c}_mean") for c in mean], *[F.sum(c).alias(f"{c}_sum") for c in total])


def restamp(rows: DataFrame, keys: list[str], first: str, last: str) -> DataFrame:
    """Every calendar day of every key; a day without a row has null values."""
    days = rows.select(*keys).distinct().withColumn("date", F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))))
    return days.join(rows, [*keys, "date"], "left")


def daily_max_of_steps(steps: DataFrame, keys: list[str], init: str) -> DataFrame:
    """keys, date, lead, value: the largest of a forecast's steps (init, ts, value) on each day after its start."""
    day = F.floor((F.unix_seconds(F.col("ts").cast("timestamp")) - F.unix_seconds(F.col(init).cast("timestamp"))) / 86400)
    led = steps.withColumn("lead", day.cast("int")).where("lead >= 0")
    return led.groupBy(*keys, init, "lead").agg(F.max("value").alias("value")).withColumn("date", F.date_add(F.to_date(init), F.col("lead")))


def defects(rows: DataFrame, variable: str, first: str, last: str, least: int) -> DataFrame:
    """Values that very many cells share on one date, most shared first: date, value, n."""
    inside = rows.where(F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    return inside.groupBy("date", F.col(variable).alias("value")).agg(F.count("*").alias("n")).where(F.col("n") > least).orderBy(F.col("n").desc(), "date", "value")


def repair_check(rows: DataFrame, variable: str) -> DataFrame:
    """For each date: rows, distinct values and least value of a variable, its repaired rows, and those of them whose derived
    variables (rh and et0) are not marked too, which must be none."""
    derived = text.IMPUTED_BITS["rh"] | text.IMPUTED_BITS["et0"]
    mask = F.coalesce(F.col("imputed").cast("int"), F.lit(0))
    hit = mask.bitwiseAND(text.IMPUTED_BITS[variable]) > 0
    return rows.groupBy("date").agg(F.count("*").alias("n_rows"), F.count_distinct(variable).alias("n_distinct"), F.min(variable).alias("least"), F.count_if(hit).alias("n_repaired"), F.count_if(hit & (mask.bitwiseAND(derived) != derived)).alias("n_missing_derived"))


def latest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
