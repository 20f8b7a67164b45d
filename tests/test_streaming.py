import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridclim.operators import daily, storage
from gridclim.streaming import update

KEYS = ["parent_id", "child_id", "date"]
STORED = T.StructType([T.StructField(c, T.StringType()) for c in ("bucket", "parent_id", "child_id")] + [T.StructField("date", T.DateType()), T.StructField("tmax", T.DoubleType()), T.StructField("is_preliminary", T.BooleanType()), T.StructField("imputed", T.ShortType())])


def test_late_revision_updates(spark, tmp_path):
    source, table, mark = (f"{tmp_path}/{x}" for x in ("in", "table", "mark"))

    def land(t, imputed=0):
        spark.createDataFrame([("012", "0123", "1E10", dt.date(2020, 1, 1), t, None, imputed)], STORED).write.mode("append").parquet(source)
        q = update.upsert_stream(spark, source, table, STORED, mark, KEYS).trigger(availableNow=True).start()
        q.awaitTermination()
        return [(r.child_id, r.tmax, r.is_preliminary) for r in storage.read_stored(spark, table, STORED).collect()]

    assert land(1.0) == [("1E10", 1.0, False)]
    assert land(2.0) == [("1E10", 2.0, False)]


def test_stream_equals_batch(spark, tmp_path):
    rows = [(u, dt.datetime(2024, 1, d, h), 60 * (u - 1), v, float(10 * d + h + u)) for u in range(3) for d in range(1, 9) for h in (1, 23) for v in ("tmax", "precip", "tdew")]
    hourly = spark.createDataFrame(rows, "u long, ts timestamp_ntz, t_zone int, variable string, value double")
    hourly.write.parquet(f"{tmp_path}/in")
    stream = update.local_days(spark.readStream.schema(hourly.schema).parquet(f"{tmp_path}/in"), ["u"], late="1 day")
    q = stream.writeStream.format("memory").queryName("days").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    got = {tuple(r) for r in spark.table("days").collect()}
    want = {tuple(r) for r in daily.local_day_reduce(hourly, ["u"]).where(F.col("date") < "2024-01-07").collect()}
    assert want and want <= got
