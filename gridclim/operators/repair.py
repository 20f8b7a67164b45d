"""Repair of a bad day of one variable: interpolation, climatology or an analogous day, tried in this order."""

from __future__ import annotations

import datetime

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridclim.functions.text import doy_distance

# fixed values: days of a gap on either side, days around the day of year, least years of a climatology
GAP, AROUND, LEAST_DATES = 3, 7, 5


def _clean(history: DataFrame, excluded: list[datetime.date]) -> DataFrame:
    rows = history.where(F.col("value").isNotNull() & ~F.isnan("value"))
    return rows.where(~F.col("date").isin(excluded)) if excluded else rows


def flanks(history: DataFrame, date: datetime.date, excluded: list[datetime.date] = (), gap: int = GAP) -> tuple[datetime.date | None, datetime.date | None]:
    """The nearest clean days before and after, one pair for all cells."""
    day = F.lit(date)
    near = _clean(history, [date, *excluded]).where(F.abs(F.datediff("date", day)) <= gap)
    found = near.agg(F.max(F.when(F.col("date") < day, F.col("date"))), F.min(F.when(F.col("date") > day, F.col("date")))).first()
    return found[0], found[1]


def interpolate(history: DataFrame, date: datetime.date, excluded: list[datetime.date] = (), gap: int = GAP) -> tuple[DataFrame, str] | None:
    """(child_id, value) by linear interpolation between the flanks, and how; none without both flanks."""
    before, after = flanks(history, date, excluded, gap)
    if before is None or after is None:
        return None
    share = (date - before).days / (after - before).days
    at = lambda d: F.max(F.when(F.col("date") == F.lit(d), F.col("value")))
    rows = history.where(F.col("date").isin(before, after)).groupBy("child_id").agg((at(before) + (at(after) - at(before)) * share).alias("value"))
    return rows.where("value is not null"), f"interpolated {before}..{after}"


def _around(history: DataFrame, date: datetime.date, excluded: list[datetime.date], days: int) -> DataFrame:
    """Clean rows of other years near the day of the year, New Year included."""
    near = doy_distance(F.dayofyear("date"), F.lit(date.timetuple().tm_yday)) <= days
    return _clean(history, list(excluded)).where(near & (F.year("date") != date.year))


def climatology(history: DataFrame, date: datetime.date, excluded: list[datetime.date] = (), days: int = AROUND, least: int = LEAST_DATES) -> tuple[DataFrame, str] | None:
    """The mean of other years' days around; none with fewer than `least` dates."""
    rows = _around(history, date, excluded, days)
    n = rows.agg(F.count_distinct("date")).first()[0]
    if n < least:
        return None
    return rows.groupBy("child_id").agg(F.avg("value").alias("value")), f"climatology n={n}"


def analog_day(history: DataFrame, date: datetime.date, excluded: list[datetime.date] = (), days: int = AROUND, seed: int = 0) -> tuple[DataFrame, str] | None:
    """All cells' values of one day of another year, drawn by the seed from the sorted dates (at most 15 a year)."""
    dates = sorted(r[0] for r in _around(history, date, excluded, days).select("date").distinct().collect())
    if not dates:
        return None
    donor = dates[int(np.random.default_rng(seed).integers(len(dates)))]
    return _clean(history, []).where(F.col("date") == F.lit(donor)).select("child_id", "value"), f"analog {donor}"


def repair_field(history: DataFrame, date: datetime.date, variable: str, excluded: list[datetime.date] = (), seed: int = 0) -> tuple[DataFrame, str]:
    """The first method that applies. Rain is not averaged: a mean day would rain everywhere."""
    steps = [] if variable == "precip" else [interpolate, climatology]
    for step in steps:
        if found := step(history, date, excluded):
            return found
    if found := analog_day(history, date, excluded, seed=seed):
        return found
    raise ValueError(f"nothing to repair {variable} on {date} from")


def targets(stored: DataFrame, quarantined: DataFrame, variable: str, date: datetime.date, constant: float | None, tolerance: float = 5e-4) -> DataFrame:
    """Distinct cells to repair: those that carry the constant value, and those in quarantine."""
    day = F.col("date") == F.lit(date)
    rows = quarantined.where(day).select("parent_id", "child_id")
    if constant is not None:
        rows = rows.unionByName(stored.where(day & (F.abs(F.col(variable) - F.lit(constant)) <= tolerance)).select("parent_id", "child_id"))
    return rows.distinct()


def reinstate(quarantined: DataFrame, values: DataFrame, variable: str) -> DataFrame:
    """Quarantined rows with the repaired value, final and marked, ready for an upsert."""
    from gridclim.functions.text import IMPUTED_BITS

    rows = quarantined.drop("reason", "detected_at").join(values.select("child_id", F.col("value").alias("_v")), "child_id")
    return rows.withColumn(variable, F.col("_v")).drop("_v").withColumn("is_preliminary", F.lit(False)).withColumn("imputed", F.lit(IMPUTED_BITS[variable]).cast("short"))


def repaired_beside(stored: DataFrame, values: DataFrame, variable: str, date) -> DataFrame:
    """child_id, before, value: a day's stored values beside the repaired ones; cells of either alone drop out."""
    day = stored.where(F.col("date") == F.lit(date).cast("date")).select("child_id", F.col(variable).alias("before"))
    return day.join(values.select("child_id", "value"), "child_id")
