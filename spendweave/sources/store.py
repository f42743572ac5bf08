"""Reading raw CSV feeds, loading and publishing tables, views, and scratch tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from spendweave.sources.badrows import BadRow, first_bad_cell
from spendweave.sources.specs import NULL_TOKENS, Field, SourceSpec


def _typed(f: Field) -> Column:
    """One trimmed CSV cell in its declared type; a bad value raises (ANSI cast)."""
    cell = F.trim(F.col(f.name))
    cell = F.when(~cell.isin(*NULL_TOKENS), cell)
    if f.type == "bigint":
        # text such as 12.0 is a valid whole number, as on a NUMBER column
        value = cell.cast("decimal(38,0)").cast("bigint")
    elif f.type == "string":
        value = cell
        if f.max_length:
            too_long = F.raise_error(F.concat(F.lit(f"{f.name} is longer than {f.max_length}: "), cell))
            value = F.when(F.length(cell) > f.max_length, too_long.cast("string")).otherwise(cell)
    else:
        value = cell.cast(f.type)
    return value.alias(f.name)


def read_raw(spark: SparkSession, path: str, spec: SourceSpec, multi_line: bool = False) -> DataFrame:
    """Scan CSV files with the layout of ``spec``.

    One header line that has to match the layout, optional double quotes, blanks
    trimmed, three NULL tokens. A row with a missing or extra cell, a value that
    does not fit its type or a text over its limit fails the query that reads it.
    ``multi_line`` allows line breaks inside quotes, but then a file cannot be split.
    """
    if spark.conf.get("spark.sql.ansi.enabled") != "true":
        raise ValueError("bad values would turn into NULL: set spark.sql.ansi.enabled")
    cells = (
        spark.read.schema(spec.string_schema())
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        # all cells are parsed even if few are selected, so that a short row is seen
        .option("columnPruning", False)
        .option("multiLine", multi_line)
        .csv(path)
    )
    return cells.select(*[_typed(f) for f in spec.fields])


def load_raw(
    spark: SparkSession, source: str, target: str, spec: SourceSpec, multi_line: bool = False
) -> DataFrame:
    """Replace the raw table at ``target`` by the CSV files at ``source``.

    Every cell is checked, because every column is written. Loading twice gives the
    same table. ``multi_line`` is as for ``read_raw``. A load that stops at a bad row raises ``BadRow``, which
    tells its file, line and cell; it is looked for only then, and not where lines are not rows.
    """
    try:
        return publish(read_raw(spark, source, spec, multi_line), target)
    except PySparkException as error:
        place = None if multi_line else first_bad_cell(spark, source, spec)
        if place is None:
            raise
        raise BadRow(place) from error


def publish(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write a table over whatever is at ``path`` and return it as read back.

    Tasks write their own files without a shuffle before it, so a large platform
    does not end up in one task.
    """
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    return stored.select(*df.columns)


def scratch_folder(spark: SparkSession) -> str:
    """This application's part of the shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder. On a cluster
    it has to be set, since executors cannot share a machine-local path.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        folder = tempfile.mkdtemp(prefix="spendweave-")
        context.setCheckpointDir(folder)
    return f"{folder}/spendweave/{context.applicationId}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application.

    Frames that were built on them, such as ranked campaigns, cannot be read any more;
    publish what is to be kept first.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """Write an intermediate result to the scratch folder; return it and its row count.

    It cuts lineage and survives lost executors, and unlike a cached frame its later
    readers still prune columns and see its real size. The count is observed during
    the write. A retried task can only raise it, so it is safe as an upper bound.
    """
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/{label}-{uuid.uuid4().hex}"
    seen = Observation(f"{label}-{uuid.uuid4().hex}")
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), seen.get["rows"]


def get_view(spark: SparkSession, name: str) -> DataFrame:
    """A registered view with lower-case column names, and ``date`` and ``week_start`` as DATE."""
    df = spark.table(name)
    df = df.toDF(*[c.lower() for c in df.columns])
    return df.withColumns({c: F.to_date(c) for c in ("date", "week_start") if c in df.columns})
