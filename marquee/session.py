"""Session settings that these operators run well with."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Re-plan joins by real sizes and split hot keys of shuffled joins.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The wide cleaning projections compile to methods above 8,000 bytes of
    # bytecode, which the JVM would only interpret. Spark then plans such a
    # stage with smaller generated methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session; all of them may be set at run time."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
