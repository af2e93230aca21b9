"""Session settings that pay for this kind of work."""

from __future__ import annotations

from pyspark.sql import SparkSession

# The JVM does not compile methods above 8000 bytes of bytecode. Wide cleaning
# projections exceed that in one generated method; with this limit Spark falls
# back to smaller generated pieces, about three times faster here.
RUNTIME_SETTINGS = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session; cluster sizing stays with the cluster."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark
