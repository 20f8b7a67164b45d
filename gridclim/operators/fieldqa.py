"""Field checks of bronze files: days on which a whole field is constant or has implausibly little spread."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridclim.functions import physics

# fixed values: least cells judged, spread against the median, accumulated variables and their size of nothing
LEAST_CELLS, LOW_SPREAD, ACCUMULATED, DRY = 32, 0.02, ("precip", "srad"), 1e-3


def by_date(bronze: DataFrame) -> DataFrame:
    """Count, exact distinct count, spread and range of each file and date. Columns variable, file, chunk, date, value."""
    return bronze.groupBy("variable", "file", "chunk", "date").agg(F.count_distinct("value").alias("n_distinct"), F.stddev_pop("value").alias("stddev"), F.count("value").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))


def constant_fields(stats: DataFrame) -> DataFrame:
    """One value in all of at least LEAST_CELLS cells; for accumulated variables only if it is not nothing."""
    accumulated = F.col("variable").isin(*ACCUMULATED)
    return stats.where((F.col("n_distinct") == 1) & (F.col("n") >= LEAST_CELLS) & (~accumulated | (F.abs("low") > DRY))).withColumn("detector", F.lit("constant_field"))


def low_spread_fields(stats: DataFrame) -> DataFrame:
    """Spread below LOW_SPREAD of the file's median spread; never for accumulated variables."""
    median = F.percentile("stddev", F.lit(0.5)).over(Window.partitionBy("variable", "file"))
    judged = stats.withColumn("median", median)
    return judged.where(~F.col("variable").isin(*ACCUMULATED) & (F.col("median") > 0) & (F.col("stddev") < LOW_SPREAD * F.col("median")) & (F.col("n_distinct") > 1) & (F.col("n") >= LEAST_CELLS)).drop("median").withColumn("detector", F.lit("low_spread"))


def scan(bronze: DataFrame) -> DataFrame:
    """Findings of each file: in stored units, the spread by the factor alone."""
    stats = by_date(bronze)
    found = constant_fields(stats).unionByName(low_spread_fields(stats))
    spread = F.col("stddev")
    for name, (factor, _) in physics.UNITS.items():
        spread = F.when(F.col("variable") == name, F.col("stddev") * factor).otherwise(spread)
    stored = {"low": physics.convert_by("variable", "low"), "high": physics.convert_by("variable", "high"), "raw_stddev": F.col("stddev"), "stddev": spread}
    return found.withColumns(stored).select("variable", "date", "detector", "file", "chunk", F.col("n").alias("cells"), "n_distinct", "low", "high", "stddev", "raw_stddev")


def consolidate(findings: DataFrame) -> DataFrame:
    """One row for each variable, date and detector over all files: cells, range and the evidence as JSON."""
    parts = F.sort_array(F.collect_list(F.struct("file", "chunk", "cells", "n_distinct", "low", "high", "stddev")))
    found = findings.groupBy("variable", "date", "detector").agg(F.sum("cells").alias("cells"), parts.alias("files"), F.min("low").alias("min"), F.max("high").alias("max"))
    return found.select("variable", "date", "detector", "cells", F.to_json(F.struct("files", "min", "max")).alias("detail"), "min", "max")
