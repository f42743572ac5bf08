"""The batch job: raw feeds -> facts -> roll-ups -> marts, published as one version.

Facts are partitioned by month and sorted by date within platform, so that a date range prunes folders
and, like a platform, row groups within them. What the marts need of the facts is kept as three roll-ups
with a row per month and more; being small, they are partitioned by year. A refresh of some days rewrites
the months that they touch, merges their roll-up rows with those of all other months, and takes the marts from that.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendweave.operators.selection import MONTH, Selection, filter_facts
from spendweave.operators.unify import unified_ads
from spendweave.plans.marts import (
    campaign_performance,
    campaign_rollup,
    campaign_totals_from_rollup,
    daily_platform_summary,
    day_rows,
    funnel_from_rollup,
    funnel_rollup,
    platform_summary,
    quality_analysis,
    quality_from_rollup,
    quality_rollup,
    video_funnel,
    weekly_trends,
    with_month,
    with_ranks,
)
from spendweave.plans.navigation import PublishedTables
from spendweave.sources import versions
from spendweave.sources.specs import UNIFIED_COLUMNS
from spendweave.sources.store import materialise

# The tables of a published version besides the roll-ups.
MARTS = (
    "daily_platform_summary", "campaign_performance", "platform_summary", "weekly_trends", "tiktok_video_funnel",
    "google_quality_analysis",
)
YEAR = "year"
ROLLUPS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "campaign_rollup": lambda facts: campaign_rollup(facts, by_month=True),
    "funnel_rollup": funnel_rollup,
    "quality_rollup": quality_rollup,
}


def marts_from_rollup(rollup: DataFrame) -> dict[str, DataFrame]:
    """The four unified marts from one stored campaign roll-up, without a further scan of facts."""
    days = day_rows(rollup)
    return {
        "daily_platform_summary": daily_platform_summary(days),
        "campaign_totals": campaign_totals_from_rollup(rollup),
        "platform_summary": platform_summary(rollup),
        "weekly_trends": weekly_trends(days),
    }


def stored_rollup(unified: DataFrame) -> DataFrame:
    """Keep the campaign roll-up of the facts as a scratch table."""
    rollup, _ = materialise(campaign_rollup(unified), "campaign-rollup")
    return rollup


def clustered(unified: DataFrame) -> DataFrame:
    """Facts with their month, dealt out so that a month's rows lie together, sorted by date within platform.

    Adaptive execution splits a month that is large and puts small ones together, so files are of one
    size whatever the months are; each file is sorted, so its row groups hold one platform and few days.
    """
    return with_month(unified).hint("rebalance", MONTH).sortWithinPartitions(MONTH, "platform", "date")


def _at_once(jobs: dict[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
    """Small jobs that do not depend on each other, submitted together."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        return dict(zip(jobs, pool.map(lambda job: job(), jobs.values())))


def _other(column: str, values: Sequence[object]) -> Callable[[str], bool]:
    """Whether a part is of none of these values of its partition column."""
    touched = {f"{column}={value}" for value in values}
    return lambda part: not touched & set(part.split("/"))


def _publish(draft: versions.Draft, facts: DataFrame, months: Sequence[date] | None) -> versions.Version:
    """Publish the facts, all of them or those of some ``months`` that replace what the base has of these."""
    stored = draft.write("unified_ads", clustered(facts), [MONTH], _other(MONTH, months) if months else None)
    years = sorted({month.year for month in months or ()})

    def roll_up(name: str) -> DataFrame:
        rows = ROLLUPS[name](stored).withColumn(YEAR, F.year(MONTH))
        if months:
            before = draft.base.read(name).where(F.col(YEAR).isin(years) & ~F.col(MONTH).isin(list(months)))
            rows = rows.unionByName(before)
        # dealt by year and month, so that a year is few files
        return draft.write(name, rows.hint("rebalance", YEAR, MONTH), [YEAR], _other(YEAR, years) if months else None)

    _at_once({name: lambda name=name: roll_up(name) for name in ROLLUPS})
    marts = marts_from_rollup(draft.read("campaign_rollup"))
    marts["campaign_performance"] = with_ranks(marts.pop("campaign_totals"))
    marts["tiktok_video_funnel"] = funnel_from_rollup(draft.read("funnel_rollup"))
    marts["google_quality_analysis"] = quality_from_rollup(draft.read("quality_rollup"))
    _at_once({name: lambda name=name, df=df: draft.write(name, df) for name, df in marts.items()})
    return draft.commit()


def _tables(version: versions.Version) -> PublishedTables:
    facts = version.read("unified_ads").select(*UNIFIED_COLUMNS)
    marts = {name: version.read(name) for name in MARTS}
    return PublishedTables({"unified_ads": facts, **marts}, {name: version.read(name) for name in ROLLUPS})


def publish_marts(facebook: DataFrame, google: DataFrame, tiktok: DataFrame, folder: str) -> PublishedTables:
    """Publish facts, roll-ups and marts below ``folder`` as a new version; return it as read back.

    Until the last step readers have the version before, also if this run fails on its way.
    """
    draft = versions.draft(facebook.sparkSession, folder)
    return _tables(_publish(draft, unified_ads(facebook, google, tiktok), None))


def refresh_marts(
    facebook: DataFrame, google: DataFrame, tiktok: DataFrame, folder: str, days: Sequence[date]
) -> PublishedTables:
    """Publish a version in which the rows of ``days`` are those of the feeds, and all others are as before.

    Of the feeds only those days are read; of the stored facts, the months that they lie in. All other
    months keep their files. A day without rows in the feeds ends up without rows.
    """
    spark = facebook.sparkSession
    draft = versions.draft(spark, folder)
    if draft.base is None:
        raise FileNotFoundError(f"nothing is published in {folder} yet")
    if not days:
        return _tables(draft.base)
    months = sorted({day.replace(day=1) for day in days})
    changed = F.col("date").isin(list(days))
    before = draft.base.read("unified_ads").where(F.col(MONTH).isin(months) & ~changed)
    after = unified_ads(facebook, google, tiktok).where(changed)
    facts = before.select(*UNIFIED_COLUMNS).unionByName(after)
    return _tables(_publish(draft, facts, months))


def read_marts(spark: SparkSession, folder: str, number: int | None = None) -> PublishedTables:
    """All tables of one published version, by default the current one, resolved once."""
    return _tables(versions.version(spark, folder, number))


def read_facts(spark: SparkSession, folder: str, sel: Selection, number: int | None = None) -> DataFrame:
    """The selected facts of a published version. Dates prune months; dates and platforms prune row groups."""
    return filter_facts(versions.version(spark, folder, number).read("unified_ads"), sel).select(*UNIFIED_COLUMNS)


def register_views(facebook: DataFrame, google: DataFrame, tiktok: DataFrame) -> dict[str, DataFrame]:
    """The seven views over raw frames, also as temporary views of the session.

    All stay lazy but ``campaign_performance``, which runs its totals to rank them.
    """
    unified = unified_ads(facebook, google, tiktok)
    views = {
        "unified_ads": unified,
        "daily_platform_summary": daily_platform_summary(unified),
        "campaign_performance": campaign_performance(unified),
        "platform_summary": platform_summary(unified),
        "weekly_trends": weekly_trends(unified),
        "tiktok_video_funnel": video_funnel(tiktok),
        "google_quality_analysis": quality_analysis(google),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return views
