"""How texts reach Python tasks."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession

#: Rows of an Arrow batch; Spark also closes it at spark.sql.execution.arrow.maxBytesPerBatch bytes (64 MB).
TEXT_ROWS = 4096


def small_batches(spark: SparkSession) -> None:
    """Keep this session's Arrow batches at TEXT_ROWS rows or below.

    Python workers of a local session start in the folder of their JVM; they are told where this
    package is. On a cluster it has to be installed, or sent along, like any other.
    """
    if spark.sparkContext.master.startswith("local["):
        spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= TEXT_ROWS:
        spark.conf.set(key, str(TEXT_ROWS))
