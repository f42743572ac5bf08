"""Where a raw feed is wrong: file, line and cell of what a load stops at.

Lines are read as texts, so that they can be numbered: Spark tells the file and the byte at which each
block of it starts, and a block's lines come in their order. All is built-in SQL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from spendweave.sources.specs import NULL_TOKENS, Field, SourceSpec

CSV = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true", "mode": "PERMISSIVE"}


class BadRow(PySparkException):
    """The first bad cell of a feed. ``file``, ``line`` (from 1, the header is line 1), ``column``, ``cell``, ``problem``."""

    def __init__(self, place: Row):
        self.file, self.line, self.column, self.cell, self.problem = place
        super().__init__(message=f"{self.file}, line {self.line}, {self.column}: {self.cell!r} is {self.problem}")


def _wrong(f: Field) -> Column:
    """Whether a cell is wrong; NULL or false if not. A good cell is trimmed and cast once."""
    cell = F.trim(F.col(f"cells.{f.name}"))
    if f.type == "string":
        wrong = F.length(cell) > f.max_length if f.max_length else F.lit(False)
    else:
        value = cell.try_cast("decimal(38,0)").try_cast("bigint") if f.type == "bigint" else cell.try_cast(f.type)
        wrong = value.isNull()
    return wrong & ~cell.isin(*NULL_TOKENS)


def _place(f: Field) -> Column:
    """What is wrong with a wrong cell."""
    problem = f"longer than {f.max_length}" if f.type == "string" else f"not a {f.type}"
    return F.struct(F.lit(f.name).alias("column"), F.col(f"cells.{f.name}").alias("cell"), F.lit(problem).alias("problem"))


def _text(spark: SparkSession, path: str) -> DataFrame:
    """(value, file, block): each line."""
    return spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    )


def _lines(spark: SparkSession, path: str, spec: SourceSpec) -> DataFrame:
    """(file, block, id, bad): each line with its bad cells, NULL if it has none; ids rise along a block."""
    layout = ", ".join(f"{c} string" for c in spec.columns)
    cells = F.from_csv("value", f"{layout}, _whole_line string", {**CSV, "columnNameOfCorruptRecord": "_whole_line"})
    misshapen = F.struct(F.lit("").alias("column"), F.col("value").alias("cell"), F.lit(f"not {len(spec.columns)} cells").alias("problem"))
    # the array, which Spark does not compile, is made only for lines that have a wrong cell
    bad = F.when(F.col("cells._whole_line").isNotNull(), F.array(misshapen)).when(
        reduce(Column.__or__, map(_wrong, spec.fields)), F.array_compact(F.array(*[F.when(_wrong(f), _place(f)) for f in spec.fields]))
    )
    header = F.lit(True)
    for c in spec.columns:
        header &= F.trim(F.col(f"cells.{c}")).eqNullSafe(F.lit(c))
    # blank lines are no rows
    bad = F.when((F.trim("value") != "") & ~header, bad)
    # In one struct with the id, since a number of rows is never computed twice: a filter on the bad cells would
    # otherwise be moved below the parsing, and parse each line again for every use of a cell.
    line = F.struct(F.monotonically_increasing_id().alias("id"), bad.alias("bad")).alias("line")
    parsed = _text(spark, path).withColumn("cells", cells)
    return parsed.select("file", "block", line).select("file", "block", "line.id", "line.bad")


def _numbered(blocks: DataFrame) -> DataFrame:
    """Blocks with ``before``: the number of lines of their file before them. One row per block, one window per file."""
    ahead = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.withColumn("before", F.coalesce(F.sum("n").over(ahead), F.lit(0)))


def bad_cells(spark: SparkSession, path: str, spec: SourceSpec) -> DataFrame:
    """(file, line, column, cell, problem) of every cell of CSV files that a load would stop at.

    A line with too few or too many cells, such as a header that does not fit, is one bad cell without a
    column. Line breaks inside quotes are taken as ends of lines.
    """
    # ids of the same lines: they do not depend on the columns that are read
    ids = _text(spark, path).withColumn("id", F.monotonically_increasing_id())
    blocks = _numbered(ids.groupBy("file", "block").agg(F.min("id").alias("first"), F.count("*").alias("n")))
    wrong = _lines(spark, path, spec).where(F.size("bad") > 0).join(blocks, ["file", "block"])
    placed = wrong.withColumn("line", F.col("before") + F.col("id") - F.col("first") + 1)
    return placed.select("file", "line", F.inline("bad"))


def first_bad_cell(spark: SparkSession, path: str, spec: SourceSpec) -> Row | None:
    """The first of ``bad_cells`` by file and line, in one pass that brings one row per block together."""
    worst = F.when(F.size("bad") > 0, F.struct("id", F.col("bad")[0].alias("place")))
    blocks = _lines(spark, path, spec).groupBy("file", "block").agg(
        F.min("id").alias("first"), F.count("*").alias("n"), F.min_by(worst, F.when(worst.isNotNull(), F.col("id"))).alias("hit")
    )
    placed = _numbered(blocks).where("hit IS NOT NULL")
    found = placed.select("file", (F.col("before") + F.col("hit.id") - F.col("first") + 1).alias("line"), "hit.place.*")
    return found.orderBy("file", "line").first()
