"""Late and revised data as streams.

Revisions reach back months, so a watermark that drops late rows would lose them: files of the stored form go through
foreachBatch into the guarded upsert. Hourly observations reduce to local days with a watermark as an append stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from gridclim.functions import text
from gridclim.operators import daily, storage


def upsert_stream(spark: SparkSession, source: str, table: str, schema: T.StructType, checkpoint: str, keys: list[str], partition: str = "bucket", preliminary_months: int = 3) -> DataStreamWriter:
    """Files of stored rows in `source` go into `table`; rows newer than the cutoff are preliminary. A batch that runs twice changes nothing."""

    def batch(rows: DataFrame, number: int) -> None:
        # of several rows of a key the newest file's counts; within a file the greatest by its other columns
        rest = [c for c in rows.columns if c not in keys and c != "_read"]
        latest = daily.latest(rows, keys, ["_read", *rest]).drop("_read")
        cutoff = text.preliminary_cutoff(F.current_date(), preliminary_months)
        storage.upsert_table(rows.sparkSession, table, latest.withColumn("is_preliminary", text.is_preliminary("date", cutoff)), schema, keys, partition)

    stream = spark.readStream.schema(schema).parquet(source).withColumn("_read", F.col("_metadata.file_modification_time"))
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)


def local_days(hourly: DataFrame, keys: list[str], minutes: str = "t_zone", late: str = "3 days") -> DataFrame:
    """The streaming form of daily.local_day_reduce: a day is emitted once the watermark has passed its end everywhere.

    Equals the batch result for rows that are no later than `late`.
    """
    local = hourly.withColumn("_local", (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.col(minutes))).cast("timestamp")).withWatermark("_local", late)
    by = local.groupBy(*keys, F.window("_local", "1 day").alias("_day"), "variable").agg(F.max("value").alias("_max"), F.min("value").alias("_min"), F.sum("value").alias("_sum"), F.avg("value").alias("_mean"))
    pick = F.lit(None).cast("double")
    for name, how in daily.REDUCERS.items():
        pick = F.when(F.col("variable") == name, F.col(f"_{how}")).otherwise(pick)
    return by.select(*keys, F.to_date("_day.start").alias("date"), "variable", pick.alias("value"))
