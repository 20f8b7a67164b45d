"""Whole jobs: bronze files to the stored record, scans of bronze, repair of one issue, grid tables.

A job plans one DataFrame over all years and parents and lets Spark batch it; results go to partitioned tables by
guarded upserts, so that a job run twice changes nothing. Order of publication in a repair: log, record, quarantine,
registry; a run lost in between leaves a logged repair that can be repeated, never an unlogged edit.
"""

from __future__ import annotations

import datetime
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridclim.functions import physics, text
from gridclim.operators import daily, fieldqa, repair, spatial, storage
from gridclim.sources import bronze, raster

KEYS = daily.KEYS
_VALUES = [T.StructField(v, T.FloatType()) for v in text.VARIABLES]
STORED = T.StructType([T.StructField("bucket", T.StringType()), T.StructField("parent_id", T.StringType()), T.StructField("child_id", T.StringType()), T.StructField("date", T.DateType()), *_VALUES, T.StructField("is_preliminary", T.BooleanType()), T.StructField("ingested_at", T.TimestampType()), T.StructField("imputed", T.ShortType())])
QUARANTINE = T.StructType([*STORED.fields[:4], *_VALUES, T.StructField("reason", T.StringType()), T.StructField("detected_at", T.TimestampType())])
LOG = T.StructType([*STORED.fields[:4], T.StructField("variable", T.StringType()), T.StructField("method", T.StringType()), T.StructField("original_value", T.FloatType()), T.StructField("new_value", T.FloatType()), T.StructField("issue_id", T.LongType()), T.StructField("applied_at", T.TimestampType())])


@dataclass(frozen=True)
class Tables:
    """Where the tables of a record lie."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def read(self, spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
        return storage.read_stored(spark, self.path(name), schema)


def transform(spark: SparkSession, bronze_root: str, tables: Tables, meta: DataFrame, years: list[int], run: datetime.date, preliminary_months: int = 3, parents: list[str] | None = None) -> dict[str, int]:
    """Bronze files of the years into the record and the quarantine. An error if none of the years has a file."""
    long = bronze.load(spark, bronze_root, daily.NATIVE, years, parents)
    if not any(bronze.available(spark, bronze_root, daily.NATIVE, y) for y in years):
        raise ValueError(f"no bronze files for {years}")
    wide = daily.build_wide(long, meta)
    good, bad = daily.split_valid(wide)
    cutoff = F.lit(run) if preliminary_months == 0 else text.preliminary_cutoff(F.lit(run), preliminary_months)
    placed = lambda rows: rows.withColumn("bucket", storage.bucket_of())
    narrow = [F.col(v).cast("float").alias(v) for v in text.VARIABLES]
    fresh = placed(good).select("bucket", *KEYS, *narrow, text.is_preliminary("date", cutoff).alias("is_preliminary"), F.current_timestamp().alias("ingested_at"), F.lit(0).cast("short").alias("imputed"))
    storage.upsert_table(spark, tables.path("record"), fresh, STORED, KEYS, "bucket")
    failed = placed(bad).select("bucket", *KEYS, *narrow, "reason", F.current_timestamp().alias("detected_at"))
    window = in_years(years)
    repaired = tables.read(spark, "record", STORED).where(window & (F.col("imputed") != 0))
    replaced = lambda old, new, keys: storage.replace_window(old, new, window, repaired, keys)
    storage.upsert_table(spark, tables.path("quarantine"), failed, QUARANTINE, KEYS, "bucket", replaced, window)
    done = tables.read(spark, "record", STORED).where(window).count()
    return {"stored": done, "quarantined": tables.read(spark, "quarantine", QUARANTINE).where(window).count()}


def in_years(years: list[int]):
    """Rows dated in one of the years, as bounds that reach the scan's statistics."""
    each = [F.col("date").between(F.lit(datetime.date(y, 1, 1)), F.lit(datetime.date(y, 12, 31))) for y in years]
    return reduce(lambda a, b: a | b, each, F.lit(False))


def check_loaded(results: list[dict]) -> dict:
    """Sums of what the years of a load stored; an error if all of them were skipped."""
    loaded = sum(r.get("stored") or 0 for r in results)
    if results and not loaded:
        raise RuntimeError(f"all {len(results)} years were skipped: no rows were loaded")
    return {"loaded": loaded, "quarantined": sum(r.get("quarantined") or 0 for r in results), "skipped_years": [r["year"] for r in results if r.get("skipped")]}


def transform_years(spark: SparkSession, bronze_root: str, tables: Tables, meta: DataFrame, years: list[int], run: datetime.date, **options) -> dict:
    """transform of each year; years without files are skipped, but not all of them."""
    results = []
    for year in years:
        if bronze.available_any(spark, bronze_root, daily.NATIVE, year):
            results.append(transform(spark, bronze_root, tables, meta, [year], run, **options) | {"year": year})
        else:
            results.append({"year": year, "skipped": True})
    return check_loaded(results)


def ingest(tiles: DataFrame, root: str, variable: str, year: int, chunk: str | None = None, fine: bool = False) -> str:
    """Raster tiles into a bronze file of a variable and year (and chunk): long rows, masked values left out. Returns its path."""
    long = (raster.encode_fine_grid if fine else raster.encode_grid)(tiles)
    name = f"{variable}_{year}" + (f"__{chunk}" if chunk else "")
    path = f"{root.rstrip('/')}/{variable}/{name}.parquet"
    bronze.write(long, path)
    return path


def build_grid(cells: DataFrame, geopotential: DataFrame, pixels: DataFrame, offsets: DataFrame) -> DataFrame:
    """The coarse grid table: cells (row, col, child_id, parent_id, lat, lon) with elevation, land and time zone.

    offsets: child_id, t_zone where a zone is known. Land cells without one take the nearest, then the longitude's; sea
    cells the longitude's.
    """
    high = add_geopotential(cells, geopotential)
    land = spatial.land_fraction(pixels, high)
    zoned = spatial.fill_timezone(land.join(offsets.select("child_id", "t_zone"), "child_id", "left"))
    return zoned.withColumn("t_zone", F.coalesce("t_zone", text.offset_minutes_by_longitude("lon")))


def scan(spark: SparkSession, bronze_root: str, variables: list[str], years: list[int]) -> DataFrame:
    """Consolidated findings of the bronze files, one job over all of them with the file in the key."""
    return fieldqa.consolidate(fieldqa.scan(bronze.load(spark, bronze_root, variables, years)))


def histories(record: DataFrame, variable: str, date: datetime.date) -> tuple[DataFrame, DataFrame]:
    """Values of the days around a date, and of the days around its day of the year in all years: as literal bounds of
    dates, so that they reach the scan."""
    rows = record.where(F.col("date") != F.lit(date)).select("parent_id", "child_id", "date", F.col(variable).cast("double").alias("value"))
    days = lambda at, n: F.col("date").between(F.lit(at - datetime.timedelta(n)), F.lit(at + datetime.timedelta(n)))
    ends = record.agg(F.min("date"), F.max("date")).first()
    years = range(ends[0].year - 1, ends[1].year + 2) if ends[0] else []
    at = [datetime.date(y, 1, 1) + datetime.timedelta(date.timetuple().tm_yday - 1) for y in years]
    around = reduce(lambda a, b: a | b, [days(d, repair.AROUND + 1) for d in at], F.lit(False))
    return rows.where(days(date, 5)), rows.where(around & (text.doy_distance(F.dayofyear("date"), F.lit(date.timetuple().tm_yday)) <= repair.AROUND))


def rederive(rows: DataFrame, meta: DataFrame) -> DataFrame:
    """rh and et0 of stored rows from their stored inputs."""
    known = rows.drop("rh", "et0").withColumns({v: F.col(v).cast("double") for v in ("tmax", "tmin", "srad", "wind", "tdew")})
    return daily.add_derived(known, meta)


def repair_issue(spark: SparkSession, tables: Tables, meta: DataFrame, variable: str, date: datetime.date, constant: float | None, issue_id: int, excluded: list[datetime.date] = (), seed: int = 0, dry_run: bool = False) -> tuple[DataFrame, str]:
    """Repairs one variable on one day: the cells with the constant value and those in quarantine. Returns the log rows and the method.

    The history is the days around first and, only if no method finds enough there, the days around that day of all years.
    """
    record, quarantine = tables.read(spark, "record", STORED), tables.read(spark, "quarantine", QUARANTINE)
    cells = repair.targets(record, quarantine, variable, date, constant).select("child_id")
    buckets = sorted(r[0] for r in repair.targets(record, quarantine, variable, date, constant).select(storage.bucket_of()).distinct().collect())
    mine = record.where(F.col("bucket").isin(buckets))
    near, wide = (x.join(cells, "child_id", "left_semi") for x in histories(mine, variable, date))
    found = None if variable == "precip" else repair.interpolate(near, date, list(excluded))
    values, how = found or repair.repair_field(wide, date, variable, list(excluded), seed)
    values = values.join(cells, "child_id", "left_semi")
    day = record.where(F.col("date") == F.lit(date))
    held = quarantine.where(F.col("date") == F.lit(date))
    before = day.select("bucket", *KEYS, F.col(variable).alias("original_value")).unionByName(held.select("bucket", *KEYS, F.col(variable).alias("original_value")))
    log = before.join(values, "child_id").select("bucket", *KEYS, F.lit(variable).alias("variable"), F.lit(how).alias("method"), "original_value", F.col("value").cast("float").alias("new_value"), F.lit(issue_id).cast("long").alias("issue_id"), F.current_timestamp().alias("applied_at"))
    if dry_run:
        return log, how
    stage = tables.path(f"_repair-{uuid.uuid4().hex}")
    log.write.parquet(stage)
    log = spark.read.schema(LOG).parquet(stage)
    storage.upsert_table(spark, tables.path("log"), log, LOG, [*KEYS, "variable"], "bucket", storage.upsert)
    new = log.select(*KEYS, F.col("new_value").alias("value"))

    def apply(old: DataFrame, _, keys: list[str]) -> DataFrame:
        """On the rows as they are when it is published, so that another repair of the day stays: held rows come back unless they have."""
        mine = old.where(F.col("date") == F.lit(date)).join(new.select(*KEYS), KEYS, "left_semi")
        changed = storage.update_column(mine, new, variable, KEYS)
        back = repair.reinstate(held, new, variable).withColumn("ingested_at", F.current_timestamp())
        back = back.join(new.select(*KEYS), KEYS, "left_semi").join(mine.select(*KEYS), KEYS, "left_anti")
        rows = changed.unionByName(back.select(*changed.columns))
        derived = rederive(rows, meta).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in STORED])
        return storage.upsert(old, derived, keys)

    storage.upsert_table(spark, tables.path("record"), log, STORED, KEYS, "bucket", apply)
    touched = new.select(*KEYS)
    gone = lambda old, _, keys: old.join(touched, list(keys), "left_anti")
    storage.upsert_table(spark, tables.path("quarantine"), held.join(touched, KEYS, "left_semi"), QUARANTINE, KEYS, "bucket", gone)
    return log, how


def add_geopotential(cells: DataFrame, geopotential: DataFrame) -> DataFrame:
    """Grid cells with elevation from geopotential by cell."""
    return cells.join(geopotential.select("child_id", physics.elevation("z").alias("elevation")), "child_id", "left")
