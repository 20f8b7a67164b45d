"""Keyed writes without a merge statement: guarded upserts, quarantine, issue registry and imputation log.

Each operation is a pure function of the old and the new rows; `upsert_table` applies one to a partitioned table of
snapshots and rewrites only the partitions that the new rows touch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridclim.functions.text import IMPUTED_BITS, VARIABLES
from gridclim.operators import snapshots

TERMINAL = ("imputed", "accepted_source_defect", "false_positive", "resolved")


def _both(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join of old and new rows as structs o and n; a missing side is a null struct, null values are not."""
    o = old.select(*keys, F.struct(*[F.col(c) for c in old.columns if c not in keys], F.lit(True).alias("_here")).alias("o"))
    n = new.select(*keys, F.struct(*[F.col(c) for c in new.columns if c not in keys], F.lit(True).alias("_here")).alias("n"))
    return o.join(n, keys, "full")


def _new(c: str) -> Column:
    return F.col("n._here").isNotNull() & F.lit(True) if c == "_here" else F.col(f"n.{c}")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], keep: list[str] = ()) -> DataFrame:
    """New rows replace old ones of the same key, but for the columns in keep, which stay as they were if the row existed."""
    has_new, has_old = F.col("n._here").isNotNull(), F.col("o._here").isNotNull()
    out = []
    for c in old.columns:
        if c in keys:
            out.append(F.col(c))
        elif c in keep:
            out.append(F.when(has_old, F.col(f"o.{c}")).otherwise(F.col(f"n.{c}")).alias(c))
        else:
            out.append(F.when(has_new, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c))
    return _both(old, new, keys).select(*out)


def upsert_guarded(old: DataFrame, new: DataFrame, keys: list[str], variables: list[str] = VARIABLES) -> DataFrame:
    """upsert in which a repaired value (its bit in `imputed`) survives; masks are joined, a new null replaces an old value."""
    has_new = F.col("n._here").isNotNull()
    mask = F.coalesce(F.col("o.imputed").cast("int"), F.lit(0))
    out = [F.col(k) for k in keys]
    for c in [c for c in old.columns if c not in keys]:
        if c == "imputed":
            value = mask.bitwiseOR(F.coalesce(F.col("n.imputed").cast("int"), F.lit(0))).cast(old.schema[c].dataType)
        elif c in variables:
            value = F.when(~has_new | (mask.bitwiseAND(IMPUTED_BITS[c]) > 0), F.col(f"o.{c}")).otherwise(F.col(f"n.{c}"))
        else:
            value = F.when(has_new, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))
        out.append(value.alias(c))
    return _both(old, new, keys).select(*out)


def update_column(old: DataFrame, values: DataFrame, variable: str, keys: list[str]) -> DataFrame:
    """Sets one variable and its bit for the keys in values (keys, value); other rows of values are ignored."""
    if variable not in IMPUTED_BITS:
        raise ValueError(f"{variable} is not a stored variable")
    found = old.join(values.select(*keys, F.col("value").alias("_v"), F.lit(True).alias("_hit")), keys, "left")
    hit = F.coalesce("_hit", F.lit(False))
    bit = F.coalesce(F.col("imputed").cast("int"), F.lit(0)).bitwiseOR(IMPUTED_BITS[variable]).cast(old.schema["imputed"].dataType)
    changed = {variable: F.when(hit, F.col("_v")).otherwise(F.col(variable)), "imputed": F.when(hit, bit).otherwise(F.col("imputed"))}
    return found.withColumns(changed).select(*old.columns)


def clear_imputed(old: DataFrame, log: DataFrame, scope: DataFrame, variable: str, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Takes a variable's bit from the rows in scope (keys) and their entries of that variable from the log."""
    mark = scope.select(*keys).distinct().withColumn("_hit", F.lit(True))
    cleared = F.col("imputed").cast("int").bitwiseAND(0xFF ^ IMPUTED_BITS[variable]).cast(old.schema["imputed"].dataType)
    rows = old.join(mark, keys, "left").withColumn("imputed", F.when(F.col("_hit"), cleared).otherwise(F.col("imputed"))).select(*old.columns)
    kept = log.join(mark, keys, "left").where(F.col("_hit").isNull() | (F.col("variable") != variable)).select(*log.columns)
    return rows, kept


def replace_window(old: DataFrame, new: DataFrame, inside: Column, repaired: DataFrame | None = None, keys: list[str] = ()) -> DataFrame:
    """Quarantine of a window: old rows inside go, new ones come, but for keys that are repaired already."""
    fresh = new if repaired is None else new.join(repaired.select(*keys).distinct(), list(keys), "left_anti")
    return old.where(~F.coalesce(inside, F.lit(False))).unionByName(fresh)


def numbered(rows: DataFrame, name: str, first: str, second: str, rest: list[str]) -> DataFrame:
    """The rows with their number from 1 on in order of the columns: by prefix sums over the counts of `first`, which has few values, and of
    `second` within it, so that no task holds more than the rows of one pair."""
    counts = rows.groupBy(first, second).agg(F.count("*").alias("_n"))
    inner = counts.withColumn("_base", F.sum("_n").over(Window.partitionBy(first).orderBy(second)) - F.col("_n")).drop("_n")
    sizes = counts.groupBy(first).agg(F.sum("_n").alias("_n")).agg(F.array_sort(F.collect_list(F.struct(F.col(first).alias("k"), F.col("_n").alias("n")))).alias("all"))
    upto = lambda k: F.aggregate(F.slice("all", 1, k), F.lit(0).cast("long"), lambda a, x: a + x["n"])
    outer = sizes.select(F.explode(F.transform("all", lambda x, k: F.struct(x["k"].alias(first), upto(k).alias("_before")))).alias("o")).select("o.*")
    place = F.row_number().over(Window.partitionBy(first, second).orderBy(*rest)).cast("long")
    placed = rows.withColumn("_place", place).join(inner, [first, second]).join(outer, first)
    return placed.withColumn(name, F.col("_before") + F.col("_base") + F.col("_place")).drop("_before", "_base", "_place")


def record_findings(issues: DataFrame, findings: DataFrame) -> DataFrame:
    """Registry with refreshed evidence: cells and detail from the findings; number, status, resolution and detection time stay.

    New issues are numbered after the largest number so far, in order of variable, date and detector.
    """
    keys = ["variable", "date", "detector"]
    known = findings.join(issues.select(*keys, "issue_id", "status", "resolution", "detected_at", "resolved_at"), keys, "left")
    fresh = numbered(known.where("issue_id is null").drop("issue_id"), "issue_id", *keys[:2], keys[2:])
    most = issues.agg(F.coalesce(F.max("issue_id"), F.lit(0)).alias("_most"))
    fresh = fresh.crossJoin(F.broadcast(most)).withColumn("issue_id", F.col("issue_id") + F.col("_most")).drop("_most")
    rows = known.where("issue_id is not null").unionByName(fresh).withColumn("status", F.coalesce("status", F.lit("detected")))
    untouched = issues.join(findings.select(*keys), keys, "left_anti")
    return untouched.unionByName(rows.select(*issues.columns))


def set_status(issues: DataFrame, ids: list[int], status: str, resolution: str | None = None) -> DataFrame:
    """Moves issues to a status; only a terminal one has a resolution time."""
    hit = F.col("issue_id").isin(ids)
    end = F.current_timestamp() if status in TERMINAL else F.lit(None).cast("timestamp")
    return issues.withColumns({"status": F.when(hit, status).otherwise(F.col("status")), "resolution": F.when(hit, F.lit(resolution)).otherwise(F.col("resolution")), "resolved_at": F.when(hit, end).otherwise(F.col("resolved_at"))})


def open_issues(issues: DataFrame) -> DataFrame:
    return issues.where(~F.col("status").isin(*TERMINAL)).orderBy(F.col("detected_at").desc())


def issue(issues: DataFrame, issue_id: int) -> DataFrame:
    return issues.where(F.col("issue_id") == issue_id)


def issues_for(issues: DataFrame, variable: str, date) -> DataFrame:
    return issues.where((F.col("variable") == variable) & (F.col("date") == F.lit(date).cast("date")))


def register_sources(known: DataFrame, names: list[str], notes: dict[str, str] | None = None) -> DataFrame:
    """The table of rain sources (source, code, note) with the named ones put in or brought up to date; an error for an unknown name."""
    from gridclim.functions.text import rain_source

    rows = [(rain_source(n), n.lower(), (notes or {}).get(n)) for n in sorted(set(names))]
    if unknown := [n for c, n, _ in rows if c is None]:
        raise ValueError(f"not products: {unknown}")
    return upsert(known, known.sparkSession.createDataFrame(rows, "source int, code string, note string"), ["source"])


def replace_failures(old: DataFrame, new: DataFrame, source: int, first, last, keys: list[str] = ("fparent_id", "fine_id", "date", "source")) -> DataFrame:
    """Quarantine of a fine product: its old rows from first to last go, the new ones come; other sources stay."""
    inside = (F.col("source") == source) & F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return replace_window(old, new, inside, None, list(keys))


def replace_table(spark: SparkSession, rows: DataFrame, path: str) -> DataFrame:
    """Puts rows in place of a whole table, as one snapshot: readers find the old or the new one."""
    snapshots.replace_all(spark, path, rows)
    return read_stored(spark, path, rows.schema)


def accumulate_table(spark: SparkSession, rows: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """Adds rows to a table of a few extents: new ones replace those of the same key."""
    return replace_table(spark, upsert(read_stored(spark, path, rows.schema), rows, keys), path)


def bulk_load(rows: DataFrame, path: str) -> None:
    """Appends rows as they come, NaN as null."""
    doubles = [f.name for f in rows.schema if f.dataType in (T.DoubleType(), T.FloatType())]
    rows.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in doubles}).write.mode("append").parquet(path)


def write_result(rows: DataFrame, path: str, form: str = "csv") -> None:
    """A result as csv (with a header), tsv, json lines or parquet."""
    out = rows.write.mode("overwrite")
    if form in ("csv", "tsv"):
        out.option("header", True).option("sep", "\t" if form == "tsv" else ",").csv(path)
    elif form in ("json", "parquet"):
        getattr(out, form)(path)
    else:
        raise ValueError(f"unknown form {form!r}; known: csv, tsv, json, parquet")


def select_repairable(issues: DataFrame, findings: DataFrame) -> DataFrame:
    """Detected issues that the findings confirm, once each."""
    return issues.where("status = 'detected'").join(findings.select("variable", "date").distinct(), ["variable", "date"]).dropDuplicates(["issue_id"]).orderBy("variable", "date")


def mark_valid(grid: DataFrame, facts: DataFrame, key: str = "fine_id") -> DataFrame:
    """is_valid: whether the cell has any fact."""
    seen = facts.select(key).distinct().withColumn("_seen", F.lit(True))
    return grid.drop("is_valid").join(seen, key, "left").withColumn("is_valid", F.col("_seen").isNotNull()).drop("_seen")


def bucket_of(parent: str = "parent_id") -> Column:
    """Partition directory of a parent: 36 consecutive parents share one, so files stay large."""
    return F.substring(parent, 1, 3)


def read_stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table by its explicit schema (codes that look like numbers stay text), its newest snapshot if it has any; empty where there is
    none yet."""
    from pyspark.errors import AnalysisException

    table = snapshots.Table(spark, path)
    if table.numbers():
        return table.read(schema)
    try:
        return spark.read.schema(schema).parquet(path).select(*schema.names)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], schema)
        raise


def arranged(rows: DataFrame, partition: str, order: list[str]) -> DataFrame:
    """Rows as a table's files hold them: a partition in one task, sorted."""
    return rows.repartition(partition).sortWithinPartitions(partition, *order)


def write_table(rows: DataFrame, path: str, partition: str, order: list[str]) -> None:
    """Puts rows in place of the partitions they fall in, as one snapshot."""
    snapshots.replace_partitions(rows.sparkSession, path, arranged(rows, partition, order), partition)


def upsert_table(spark: SparkSession, path: str, new: DataFrame, schema: T.StructType, keys: list[str], partition: str, how: Callable[[DataFrame, DataFrame, list[str]], DataFrame] = upsert_guarded, window: Column | None = None, tries: int = 5) -> None:
    """Applies how(old, new, keys) to a partitioned table. Only touched partitions are read and rewritten: those of the new
    rows, and those with old rows in `window`, which `how` may take away.

    The result is one snapshot: it is published at once for all partitions, and a run lost before leaves the table as it was.
    Where another run has meanwhile published a partition that this one read, it is made anew from what is there then. A
    table without snapshots is read as it is, and written whole as the first.
    """
    for left in reversed(range(tries)):
        table = snapshots.Table(spark, path)
        base = table.version()
        stored = table.read(schema, base.number) if base.number else read_stored(spark, path, schema)
        touched = {r[0] for r in new.select(partition).distinct().collect()}
        if window is not None or not base.number:
            touched |= {r[0] for r in (stored.where(window) if base.number else stored).select(partition).distinct().collect()}
        found = F.col(partition).isin(sorted(x for x in touched if x is not None))
        old = stored.where(found | F.col(partition).isNull() if None in touched else found)
        try:
            snapshots.replace_partitions(spark, path, arranged(how(old, new, keys).select(*schema.names), partition, keys), partition, touched, base)
            return
        except snapshots.Conflict:
            if not left:
                raise
