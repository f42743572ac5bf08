"""Shares, changes and normalisation over rows that are already aggregated.

A window without a partition puts its rows in one task. Here that is only done on
frames whose size does not grow with the facts: one row per platform, per funnel
stage, or per platform and week. Ranking campaigns, of which there may be any number, is in
``ranking``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendweave.functions.kpis import ratio


def _all_rows():
    return Window.partitionBy()


def with_share(df: DataFrame, measure: str, out: str) -> DataFrame:
    """Share of the column total, 4 places. One row per platform."""
    return df.withColumn(out, ratio(measure, f"SUM({measure}) OVER ()", 4))


def with_wow(weekly: DataFrame, measure: str) -> DataFrame:
    """Change against the platform's previous week that has data, 4 places.

    The lag is a column of its own: written twice it would be computed twice.
    """
    weeks = Window.partitionBy("platform").orderBy("week_start")
    return (
        weekly.withColumn("_previous", F.lag(measure).over(weeks))
        .withColumn(f"{measure}_wow_change", ratio(f"({measure} - _previous)", "_previous", 4))
        .drop("_previous")
    )


def normalise_to_max(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Divide each column by its maximum where that is positive. One row per platform."""
    scaled = {}
    for name in columns:
        top = F.max(name).over(_all_rows())
        scaled[name] = F.when(top > 0, F.col(name) / top).otherwise(F.col(name))
    return df.withColumns(scaled)


def percent_of_first(stages: DataFrame) -> DataFrame:
    """``pct``: count of a stage as percent of stage 1. One row per stage."""
    from_start = Window.orderBy("stage_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = F.first("count").over(from_start).cast("double")
    return stages.withColumn("pct", F.col("count").cast("double") / F.nullif(first, F.lit(0.0)) * 100)


def latest_week(weekly: DataFrame) -> DataFrame:
    """All rows of the last week present. One row per platform and week."""
    return (
        weekly.withColumn("_last", F.max("week_start").over(_all_rows()))
        .filter(F.col("week_start") == F.col("_last"))
        .drop("_last")
    )
