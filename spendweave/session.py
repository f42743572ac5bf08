"""Session settings for local runs; COMMON_CONF holds on a cluster too."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that hold at every size. Shuffle partitions are left to the caller:
# few for a local run, many (with AQE coalescing them) on a cluster.
COMMON_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    # call sites of every Column operation cost more than planning the query
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

def local_session(cores: int | str = "*", app_name: str = "spendweave", **conf: str) -> SparkSession:
    """A single-JVM session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**COMMON_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
