"""Session settings the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Sets what can be set at run time: codes that look like numbers stay strings, days are UTC days."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
