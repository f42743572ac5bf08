"""The dashboard's filters as predicates on lazy frames.

They differ by frame on purpose: ranks and shares are computed before any filter,
the daily mart ignores campaigns, and the campaign mart ignores dates.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Partition column of stored facts: first day of the month of ``date``.
MONTH = "month"


@dataclass(frozen=True)
class Selection:
    """What the user picked. ``None`` is everything; an empty list matches nothing."""

    dates: Sequence[date] | None = None
    platforms: Sequence[str] | None = None
    campaigns: Sequence[str] | None = None

    def on_dates(self) -> Column:
        # a range that is not exactly two dates is no date filter
        if self.dates is None or len(self.dates) != 2:
            return F.lit(True)
        first, last = self.dates
        return F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))

    def on_months(self) -> Column:
        """What ``on_dates`` implies for the month, so that partitions are pruned."""
        if self.dates is None or len(self.dates) != 2:
            return F.lit(True)
        first, last = self.dates
        return F.col(MONTH).between(F.lit(first.replace(day=1)).cast("date"), F.lit(last.replace(day=1)).cast("date"))

    def restricted(self) -> set[str]:
        """Columns that the selection restricts."""
        dated = self.dates is not None and len(self.dates) == 2
        chosen = {"date": dated, "platform": self.platforms is not None, "campaign_name": self.campaigns is not None}
        return {column for column, is_chosen in chosen.items() if is_chosen}

    def on_platforms(self) -> Column:
        return _member("platform", self.platforms)

    def on_campaigns(self) -> Column:
        return _member("campaign_name", self.campaigns)

    def shows(self, platform: str) -> bool:
        return self.platforms is None or platform in self.platforms


def _member(column: str, chosen: Sequence[str] | None) -> Column:
    if chosen is None:
        return F.lit(True)
    return F.col(column).isin(list(chosen)) if chosen else F.lit(False)


def filter_facts(unified: DataFrame, sel: Selection) -> DataFrame:
    """Selected rows; where facts are stored by month, only the months of the chosen dates are read."""
    if MONTH in unified.columns:
        unified = unified.filter(sel.on_months())
    return unified.filter(sel.on_dates() & sel.on_platforms() & sel.on_campaigns())


def filter_daily(daily: DataFrame, sel: Selection) -> DataFrame:
    return daily.filter(sel.on_platforms() & sel.on_dates())


def filter_campaigns(campaigns: DataFrame, sel: Selection) -> DataFrame:
    return campaigns.filter(sel.on_platforms() & sel.on_campaigns())


def filter_platform(df: DataFrame, sel: Selection) -> DataFrame:
    return df.filter(sel.on_platforms())


def is_empty(filtered: DataFrame) -> bool:
    """Whether nothing is selected; the dashboard then shows no panel."""
    return filtered.isEmpty()


def date_bounds(unified: DataFrame) -> DataFrame:
    return unified.agg(F.min("date").alias("min_date"), F.max("date").alias("max_date"))


def filter_options(unified: DataFrame, platforms: Sequence[str] | None = None) -> DataFrame:
    """What can be chosen: rows (option, value) of one pass over the facts.

    Options are ``date_min``, ``date_max``, each ``platform``, and each ``campaign``
    of the chosen platforms.
    """
    pairs = unified.groupBy("platform", "campaign_name").agg(
        F.min("date").alias("first"), F.max("date").alias("last")
    )

    def entry(option: str, value: Column) -> Column:
        return F.struct(F.lit(option).alias("option"), value.alias("value"), F.col("first"), F.col("last"))

    offered = Selection(platforms=platforms).on_platforms()
    entries = F.array(
        entry("date", F.lit(None).cast("string")),
        entry("platform", F.col("platform")),
        F.when(offered, entry("campaign", F.col("campaign_name"))),
    )
    merged = (
        pairs.select(F.explode(entries).alias("e"))
        .filter(F.col("e").isNotNull())
        .select("e.*")
        .groupBy("option", "value")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"))
    )

    def bound(option: str, day: Column) -> Column:
        return F.struct(F.lit(option).alias("option"), day.cast("string").alias("value"))

    rows = F.when(
        F.col("option") == "date",
        F.array(bound("date_min", F.col("first")), bound("date_max", F.col("last"))),
    ).otherwise(F.array(F.struct("option", "value")))
    return merged.select(F.inline(rows)).orderBy("option", "value")
