"""Session settings the jobs are designed for; any session with these values works."""

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # splits hot partitions of inner joins and of the preserved side of left joins
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.ui.enabled": "false",
    # call-site capture doubles the time to build a plan
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "marginloom", master: str | None = None, **extra: str) -> SparkSession:
    """Session with SETTINGS; the cluster's own values in ``extra`` win."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
