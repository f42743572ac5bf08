"""Best and worst rows, distinct values, output order, and small reshapes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendweave.sources.store import materialise

# Output order of each mart, with a unique tie-break (column, descending).
MART_ORDER = {
    "daily_platform_summary": [("date", False), ("platform", False)],
    "campaign_performance": [
        ("total_spend", True), ("platform", False), ("campaign_id", False), ("campaign_name", False),
    ],
    "platform_summary": [("total_spend", True), ("platform", False)],
    "weekly_trends": [("week_start", False), ("platform", False)],
    "video_funnel": [("total_views", True), ("campaign_name", False)],
    "quality_analysis": [
        ("avg_quality_score", True), ("campaign_name", False), ("ad_group_name", False),
    ],
}


def ordered(df: DataFrame, mart: str) -> DataFrame:
    """Sort for output. Marts themselves stay unsorted, a sort is a shuffle of its own."""
    keys = [F.col(c).desc_nulls_last() if down else F.col(c).asc() for c, down in MART_ORDER[mart]]
    return df.orderBy(*keys)


def numbered(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns of a sorted frame, with each row's ``position`` in it, from 1.

    Runs the frame once and keeps it as a scratch table, with row numbers within each of its sorted
    partitions. A partition's first position is what those before it hold, so only one row per
    partition, not per row, is ever in one task.
    """
    placed = df.select(*columns, F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_id"))
    stored, _ = materialise(placed, "sorted")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = stored.groupBy("_part").agg(F.count("*").alias("_rows"), F.min("_id").alias("_first"))
    shifted = parts.select("_part", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    return stored.join(shifted, "_part").select(*columns, (F.col("_id") + F.col("_shift")).alias("position"))


def best(df: DataFrame, metric: str, tie_breaks: Sequence[Column]) -> DataFrame:
    """The row with the smallest non-NULL ``metric`` (a top-1, not a full sort)."""
    return df.filter(F.col(metric).isNotNull()).orderBy(F.col(metric).asc(), *tie_breaks).limit(1)


def worst(df: DataFrame, metric: str, tie_breaks: Sequence[Column]) -> DataFrame:
    """The row with the largest non-NULL ``metric``."""
    return df.filter(F.col(metric).isNotNull()).orderBy(F.col(metric).desc(), *tie_breaks).limit(1)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def select_columns(df: DataFrame, names: Sequence[str] | dict[str, str]) -> DataFrame:
    """Keep the named columns, in order; a dict also renames them for display."""
    if isinstance(names, dict):
        return df.select(*[F.col(c).alias(shown) for c, shown in names.items()])
    return df.select(*names)
