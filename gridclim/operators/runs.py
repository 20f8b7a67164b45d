"""Run records: batches by idle gaps, throughput by level, cost models."""

from __future__ import annotations

from functools import reduce
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

GAP_SECONDS = 180


def batches(runs: DataFrame, by: list[str] = (), gap: int = GAP_SECONDS) -> DataFrame:
    """runs (started, finished in seconds, parallel) with `batch`: a new one where the level changes, or where a run starts
    more than `gap` seconds after all earlier ones of its stretch have ended. Rows without both times drop out.

    Stretches of one level come first; the running end is taken within them, as a break resets it anyway. `by` splits
    the history into independent ones and spreads the work.
    """
    order = ["started", "finished", "parallel"]
    known = runs.where("started is not null and finished is not null")
    whole, up_to = Window.partitionBy(*by).orderBy(*order), Window.unboundedPreceding
    stretch = F.sum(F.coalesce((F.lag("parallel").over(whole) != F.col("parallel")).cast("int"), F.lit(0))).over(whole.rowsBetween(up_to, 0))
    level = known.withColumn("_stretch", stretch)
    before = F.max("finished").over(Window.partitionBy(*by, "_stretch").orderBy(*order).rowsBetween(up_to, -1))
    broken = level.withColumn("_break", (before.isNull() | (F.col("started") > before + gap)).cast("int"))
    return broken.withColumn("batch", F.sum("_break").over(whole.rowsBetween(up_to, 0))).drop("_stretch", "_break")


def level_throughput(batched: DataFrame, by: list[str] = ()) -> DataFrame:
    """Tasks an hour, concurrency and median time of each level, over its batches of two runs and more."""
    each = batched.where("error is null").groupBy(*by, "batch", "parallel").agg(F.count("*").alias("n"), (F.max("finished") - F.min("started")).alias("span"), F.collect_list("seconds").alias("times"))
    some = each.where("n >= 2 and span > 0 and size(times) > 0 and parallel >= 1")
    total = some.groupBy("parallel").agg(F.sum("n").alias("tasks"), F.sum("span").alias("span"), F.sum(F.aggregate("times", F.lit(0.0), lambda a, x: a + x)).alias("busy"))
    median = some.select("parallel", F.explode("times").alias("t")).groupBy("parallel").agg(F.percentile("t", F.lit(0.5)).alias("median_task_s"))
    return total.join(median, "parallel").select("parallel", F.round(F.col("tasks") * 3600.0 / F.col("span"), 2).alias("tasks_per_hour"), F.round(F.col("busy") / F.col("span"), 2).alias("concurrency"), F.round("median_task_s", 1).alias("median_task_s"), "tasks")


def summarize(runs: DataFrame, by: list[str]) -> DataFrame:
    """Counts, and medians over the runs without an error."""
    ok = F.col("error").isNull()
    of = lambda c: F.when(ok, F.col(c))
    median = lambda c, d: F.round(F.percentile(of(c), F.lit(0.5)), d).alias(f"{c}_median")
    return runs.groupBy(*by).agg(F.count("*").alias("n"), F.count_if(ok).alias("n_ok"), F.max(F.coalesce("attempts", F.lit(1))).alias("attempts"), median("seconds", 1), F.max(of("seconds")).alias("seconds_max"), median("cost", 4), F.round(F.avg(of("cost")), 4).alias("cost_mean"), median("cells", 0))


def fit_per_task(runs: DataFrame, field: str, by: list[str] = ()) -> DataFrame:
    """fixed, per_cell, r2: least squares of a field on the cells, from three runs and more with different cells."""
    rows = runs.where(F.col("error").isNull() & (F.col("cells") != 0) & (F.col(field) != 0))
    x, y = F.col("cells").cast("double"), F.col(field).cast("double")
    fit = rows.groupBy(*by).agg(F.count("*").alias("n"), F.regr_sxx(y, x).alias("_sxx"), F.regr_intercept(y, x).alias("fixed"), F.regr_slope(y, x).alias("per_cell"), F.regr_r2(y, x).alias("r2"))
    return fit.where("n >= 3 and _sxx > 0").drop("_sxx")


def ratios(runs: DataFrame) -> DataFrame:
    """Rates that stay null, and never become 0, where a part is missing."""
    return runs.withColumns({"cost_per_1000_cells": F.try_divide(F.col("cost") * 1000, F.col("cells")), "cells_per_second": F.try_divide("cells", "seconds")})


def timings(runs: DataFrame) -> DataFrame:
    """The service's own figures of runs (created_ms, started_ms, updated_ms, used_seconds): hours used, seconds queued and
    computed. A stamp that is missing or 0 leaves what needs it null, never 0."""
    stamp = lambda c: F.when(F.col(c) != 0, F.col(c).cast("long"))
    return runs.withColumns({"used_hours": F.col("used_seconds") / 3600.0, "queue_s": (stamp("started_ms") - stamp("created_ms")) / 1000.0, "compute_s": (stamp("updated_ms") - stamp("started_ms")) / 1000.0})


def run_metrics(rows: DataFrame, by: list[str], cell: str = "child_id") -> DataFrame:
    """What a run made of its long rows (cell, date, value): rows, distinct cells and days, cell-days, and the share of known values."""
    known = F.count_if(F.col("value").isNotNull() & ~F.isnan("value"))
    found = rows.groupBy(*by).agg(F.count("*").alias("n_rows"), F.count_distinct(cell).alias("n_cells"), F.count_distinct("date").alias("n_days"), known.alias("n_valid"))
    return found.withColumn("cell_days", F.col("n_cells") * F.col("n_days")).withColumn("valid_share", F.round(F.try_divide("n_valid", "n_rows"), 12))


#: Pieces in which a sample's order is counted, and rows that are drawn for each bound between them.
PIECES, DRAWN = 64, 32


def spaced_sample(ranked: DataFrame, order: list[str], n: int) -> DataFrame:
    """n rows evenly spaced over a ranked table, its first and last included; all rows if there are no more.

    Rows go by the columns of `order`, nulls first, and rows alike in these by a hash of all. Pieces of the order are counted between
    bounds that a fixed number of rows give; only those that hold a wanted place are ranked, each by itself. The bounds
    decide how much a task ranks and never what is found.
    """
    hashed = [f.name for f in ranked.schema if not isinstance(f.dataType, T.MapType)]
    rows, key = ranked.withColumn("_tie", F.xxhash64(*hashed)), [*order, "_tie"]
    drawn = rows.select(*key).orderBy(F.xxhash64("_tie", F.lit(1)), *key).limit(PIECES * DRAWN).orderBy(*key).collect()
    known = {f.name: f.dataType for f in rows.schema}
    literal = lambda row: F.struct(*(F.lit(row[c]).cast(known[c]).alias(c) for c in key))
    bounds = [literal(row) for row in drawn[DRAWN::DRAWN]]
    piece = reduce(lambda x, y: x + y, [(F.struct(*key) >= x).cast("int") for x in bounds], F.lit(0))
    rows = rows.withColumn("_piece", piece)
    counts = dict(rows.groupBy("_piece").count().collect())
    total = sum(counts.values())
    if n >= total:
        return ranked
    places = [0] if n == 1 else sorted({round(k * (total - 1) / (n - 1)) for k in range(n)})
    ends = zip(sorted(counts), accumulate([0, *(counts[k] for k in sorted(counts))]), strict=False)
    wanted = {k: inside for k, low in ends if (inside := [x - low for x in places if low <= x < low + counts[k]])}
    ranked_piece = F.row_number().over(Window.partitionBy("_piece").orderBy(*key)) - 1
    found = [(F.col("_piece") == k) & F.col("_place").isin(inside) for k, inside in wanted.items()]
    return rows.where(F.col("_piece").isin(list(wanted))).withColumn("_place", ranked_piece).where(reduce(lambda x, y: x | y, found, F.lit(False))).select(*ranked.columns)


def cost_report(runs: DataFrame, plans: DataFrame, var_years: float, levels: DataFrame | None = None) -> DataFrame:
    """For each size of chunks: what its runs took, and the modelled total over plans (size, n_chunks, land_cells).

    The total is the fixed cost of a task times the chunks and the cost of a cell times the extent's cells, from one fit
    over all runs, times the variable-years. par_days are the days at the fastest level of `levels` against level 1.
    """
    one = F.lit(1).alias("_one")
    seen = summarize(runs, ["size"])
    cost = fit_per_task(runs, "cost").select(one, F.col("fixed").alias("cost_fixed"), F.col("per_cell").alias("cost_cell"))
    time = fit_per_task(runs, "seconds").select(one, F.col("fixed").alias("s_fixed"), F.col("per_cell").alias("s_cell"))
    total = lambda a, b: (F.col("n_chunks") * F.col(a) + F.col("land_cells") * F.col(b)) * var_years
    found = seen.join(plans, "size").withColumn("_one", F.lit(1)).join(F.broadcast(cost), "_one", "left").join(F.broadcast(time), "_one", "left")
    found = found.withColumns({"tasks": F.col("n_chunks") * var_years, "cost_total": total("cost_fixed", "cost_cell"), "serial_days": total("s_fixed", "s_cell") / 86400.0})
    if levels is None:
        return found.withColumn("par_days", F.col("serial_days")).drop("_one")
    gain = levels.agg(F.try_divide(F.max("tasks_per_hour"), F.max(F.when(F.col("parallel") == 1, F.col("tasks_per_hour")))).alias("gain")).select(one, F.coalesce("gain", F.lit(1.0)).alias("gain"))
    return found.join(F.broadcast(gain), "_one").withColumn("par_days", F.col("serial_days") / F.col("gain")).drop("_one", "gain")


def rollup(parts: DataFrame, by: list[str]) -> DataFrame:
    """Whether all planned parts are done, and how many are not."""
    return parts.groupBy(*by).agg(F.bool_and(F.coalesce("done", F.lit(False))).alias("complete"), F.count_if(~F.coalesce("done", F.lit(False))).alias("open"))
