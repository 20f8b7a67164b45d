"""Bronze long tables: Parquet files <variable>/<variable>_<year>[__<chunk>].parquet in native units."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LONG = T.StructType([T.StructField("child_id", T.StringType()), T.StructField("parent_id", T.StringType()), T.StructField("date", T.DateType()), T.StructField("value", T.DoubleType())])
FINE = T.StructType([T.StructField("fine_id", T.StringType()), T.StructField("fparent_id", T.StringType()), T.StructField("date", T.DateType()), T.StructField("value", T.DoubleType())])


def _paths(spark: SparkSession, pattern: str) -> list[str]:
    """Files that match, through Spark's own file systems."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(str(x.getPath()) for x in found or [])


def year_paths(spark: SparkSession, root: str, variable: str, year: int) -> list[str]:
    """All files of a variable and year; 1987x is not 1987."""
    form = re.compile(rf"^{re.escape(variable)}_{year}(__[^/]+)?\.parquet$")
    return [p for p in _paths(spark, f"{root}/{variable}/{variable}_{year}*.parquet") if form.match(p.rsplit("/", 1)[-1])]


def available(spark: SparkSession, root: str, variables: list[str], year: int) -> list[str]:
    return [v for v in variables if year_paths(spark, root, v, year)]


def available_any(spark: SparkSession, root: str, variables: list[str], year: int) -> bool:
    return bool(available(spark, root, variables, year))


def in_window(rows: DataFrame, first, last, column: str = "ts") -> DataFrame:
    """Rows of a collection from first to before last."""
    return rows.where((F.col(column) >= F.lit(first).cast("timestamp")) & (F.col(column) < F.lit(last).cast("timestamp")))


def sample(rows: DataFrame, keys: list[str], share: float) -> DataFrame:
    """About a share of the rows, always the same: those whose keys' MD5 is low."""
    digits = F.conv(F.substring(F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys])), 1, 8), 16, 10).cast("long")
    return rows.where(digits < int(share * 16**8))


def load(spark: SparkSession, root: str, variables: list[str], years: list[int], parents: list[str] | None = None, schema: T.StructType = LONG) -> DataFrame:
    """Rows of all files with variable, year and chunk from the file's name; empty where there are none.

    The parent filter and the columns reach the Parquet scan.
    """
    paths = [p for v in variables for y in years for p in year_paths(spark, root, v, y)]
    rows = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
    if paths:
        # a file, or a folder of files that Spark wrote under the name
        form = r"/([^/]+?)_(\d{4})(?:__([^/]+?))?\.parquet(?:/|$)"
        part = lambda k: F.regexp_extract("_metadata.file_path", form, k)
        rows = rows.select("*", part(1).alias("variable"), part(2).try_cast("int").alias("year"), part(3).alias("chunk"), F.regexp_extract("_metadata.file_path", r"/([^/]+?\.parquet)(?:/|$)", 1).alias("file"))
    else:
        rows = rows.select("*", *[F.lit(None).cast(t).alias(c) for c, t in (("variable", "string"), ("year", "int"), ("chunk", "string"), ("file", "string"))])
    return rows.where(F.col(schema[1].name).isin(parents)) if parents else rows


def load_source_year(spark: SparkSession, root: str, source: str, code: int, year: int, parents: list[str] | None = None) -> DataFrame:
    """Fine rainfall of a product and year in stored columns."""
    found = load(spark, root, [source], [year], parents, FINE)
    return found.select("fparent_id", "fine_id", "date", F.lit(code).cast("short").alias("source"), F.col("value").cast("float").alias("precip"))


def write(rows: DataFrame, path: str) -> None:
    """Masked values (null or NaN) are not stored; rows are sorted so that row groups prune."""
    key = rows.columns[1]
    rows.where(F.col("value").isNotNull() & ~F.isnan("value")).sortWithinPartitions(key, rows.columns[0], "date").write.mode("overwrite").parquet(path)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines without the torn ones."""
    torn = "_corrupt_record"
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField(torn, T.StringType())])).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", torn).json(path)
    return rows.where(F.col(torn).isNull()).drop(torn)
