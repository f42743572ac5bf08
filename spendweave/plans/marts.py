"""The marts: facts rolled up by day, week, campaign, platform, funnel and quality.

All take the unified facts (or the raw feed of one platform) and stay lazy, except
that ranking campaigns runs the campaign totals once. Row indicators of the facts
are never read here, so they are pruned before the scan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendweave.functions.kpis import mart_kpis, mean, quotient, ratio, ratio_or_zero, roas
from spendweave.operators.ranking import Ranking, with_global_ranks
from spendweave.operators.selection import MONTH
from spendweave.operators.windows import with_share, with_wow
from spendweave.sources.specs import GOOGLE, TIKTOK
from spendweave.sources.store import materialise

CAMPAIGN_KEYS = ("platform", "campaign_id", "campaign_name")
BASE_MEASURES = ("impressions", "clicks", "spend", "conversions")
ROLLUP_MEASURES = BASE_MEASURES + ("video_views", "conversion_value", "likes", "shares", "comments")


# Watched parts of a video, and the means of the quality analysis with their places.
FUNNEL_STEPS = ("25", "50", "75", "100")
QUALITY_MEANS = {"quality_score": 1, "search_impression_share": 2}

_AMOUNTS = ("spend", "cost", "conversion_value")


def _sum(measure: str) -> Column:
    """Sum with the same type whether facts or a roll-up of them are added up."""
    total = F.sum(measure)
    return total.cast("decimal(22,2)") if measure in _AMOUNTS else total


def _fine_sum(measure: str) -> Column:
    """Sum of fact rows within a small group, such as one day of a campaign.

    Amounts are added up as whole cents in a BIGINT, much cheaper per row than adding
    DECIMALs and as exact; it holds 92 quadrillion per group, and ANSI mode raises
    beyond that. What is above these groups adds up DECIMALs.
    """
    if measure not in _AMOUNTS:
        return F.sum(measure)
    return F.expr(f"CAST(CAST(SUM(CAST({measure} * 100 AS BIGINT)) AS DECIMAL(20,0)) * 0.01 AS DECIMAL(22,2))")


def _totals(*measures: str) -> list[Column]:
    return [_sum(m).alias(f"total_{m}") for m in measures]


def _total_kpis() -> dict[str, Column]:
    return mart_kpis(*[f"total_{m}" for m in BASE_MEASURES])


def _row_count(df: DataFrame) -> Column:
    """Number of fact rows, also where ``df`` is a roll-up of them."""
    return F.sum("row_count") if "row_count" in df.columns else F.count(F.lit(1))


def with_month(df: DataFrame) -> DataFrame:
    """Add the first day of the month of ``date``."""
    return df.withColumn(MONTH, F.trunc("date", "month"))


def campaign_rollup(unified: DataFrame, by_month: bool = False) -> DataFrame:
    """Facts per campaign and day (``is_day``), and beside them a row per campaign and ad group.

    So distinct days and distinct ad groups are plain counts of rows, and no fact row is copied for a
    distinct count: each kind is an aggregate of its own, and the two read different columns.
    ``by_month`` adds the month to both kinds, so that the roll-up can be kept and replaced by month;
    an ad group then has a row per month. Rows of one campaign are combined before the shuffle.
    """
    keys = [F.col(k) for k in CAMPAIGN_KEYS]
    facts = with_month(unified) if by_month else unified
    month = [F.col(MONTH)] if by_month else []
    days = facts.groupBy(*month, *keys, "date").agg(
        F.lit(True).alias("is_day"), F.count(F.lit(1)).alias("row_count"), *[_fine_sum(m).alias(m) for m in ROLLUP_MEASURES]
    )
    groups = facts.select(*month, *keys, "ad_group_id").distinct().withColumn("is_day", F.lit(False))
    return days.unionByName(groups, allowMissingColumns=True)


def day_rows(rollup: DataFrame) -> DataFrame:
    """The part of a campaign roll-up that stands for the facts."""
    return rollup.filter("is_day")


def daily_platform_summary(facts: DataFrame) -> DataFrame:
    """Per day and platform. ``ad_groups_active`` counts rows, not distinct ad groups."""
    grouped = facts.groupBy("date", "platform").agg(
        _row_count(facts).alias("ad_groups_active"), *_totals(*BASE_MEASURES, "video_views")
    )
    kpis = _total_kpis()
    return grouped.withColumns(kpis).select(
        "date", "platform", "ad_groups_active", *[f"total_{m}" for m in BASE_MEASURES], *kpis, "total_video_views"
    )


def campaign_totals(unified: DataFrame) -> DataFrame:
    """Campaign performance without ranks, lazy.

    Plainly declared, so that filters on the result reach the scan and a reader of a
    few columns does not pay for the distinct counts.
    """
    grouped = unified.groupBy(*CAMPAIGN_KEYS).agg(
        F.min("date").alias("first_active_date"),
        F.max("date").alias("last_active_date"),
        F.count_distinct("date").alias("active_days"),
        F.count_distinct("ad_group_id").alias("ad_groups"),
        *_totals(*ROLLUP_MEASURES),
    )
    return _campaign_columns(grouped)


def campaign_totals_from_rollup(rollup: DataFrame) -> DataFrame:
    """The same from a campaign roll-up, where every day is one row, and every ad group at most one per month."""
    if MONTH in rollup.columns:
        groups = rollup.filter("NOT is_day").select(*CAMPAIGN_KEYS, "ad_group_id").distinct()
        rollup = day_rows(rollup).unionByName(groups, allowMissingColumns=True)
    grouped = rollup.groupBy(*CAMPAIGN_KEYS).agg(
        F.min("date").alias("first_active_date"),
        F.max("date").alias("last_active_date"),
        F.count("date").alias("active_days"),
        F.count("ad_group_id").alias("ad_groups"),
        *_totals(*ROLLUP_MEASURES),
    )
    return _campaign_columns(grouped)


def _campaign_columns(grouped: DataFrame) -> DataFrame:
    kpis = _total_kpis()
    returns = {"roas": roas("total_conversion_value", "total_spend")}
    return grouped.withColumns({**kpis, **returns}).select(
        *CAMPAIGN_KEYS,
        "first_active_date",
        "last_active_date",
        "active_days",
        "ad_groups",
        *[f"total_{m}" for m in BASE_MEASURES],
        *kpis,
        "total_video_views",
        "total_conversion_value",
        "roas",
        "total_likes",
        "total_shares",
        "total_comments",
    )


def with_ranks(campaigns: DataFrame) -> DataFrame:
    """Ranks by spend, conversions and unrounded CPA over all campaigns.

    A campaign without conversions has no CPA and ranks last.
    """
    return with_global_ranks(
        campaigns,
        [
            Ranking("spend_rank", F.col("total_spend"), descending=True),
            Ranking("conversions_rank", F.col("total_conversions"), descending=True),
            Ranking("cpa_rank", quotient("total_spend", "total_conversions")),
        ],
    )


def campaign_performance(unified: DataFrame) -> DataFrame:
    """Campaign totals with their three ranks. Runs the totals when called.

    Ranks need every campaign and all columns are wanted, so there is nothing to push
    down or prune: the roll-up gets to the totals with fewer copies of each row.
    """
    return with_ranks(campaign_totals_from_rollup(campaign_rollup(unified)))


def platform_summary(facts: DataFrame, counts: bool = True) -> DataFrame:
    """Per platform, with its share of all spend and of all conversions.

    Facts (or their campaign roll-up) are first reduced to days and to pairs of campaign and ad group,
    so that only these are copied for the distinct counts. Without ``counts`` those columns, and the
    second aggregate, are left out.
    """
    if not counts:
        return _platform_columns(facts.groupBy("platform").agg(*_totals(*BASE_MEASURES)))
    days = facts.groupBy("platform", "date").agg(*[_sum(m).alias(m) for m in BASE_MEASURES])
    pairs = facts.select("platform", "campaign_id", "ad_group_id").distinct()
    grouped = days.unionByName(pairs, allowMissingColumns=True).groupBy("platform").agg(
        F.count_distinct("campaign_id").alias("campaigns"),
        F.count_distinct("ad_group_id").alias("ad_groups"),
        F.count("date").alias("active_days"),
        *_totals(*BASE_MEASURES),
    )
    return _platform_columns(grouped)


def _platform_columns(grouped: DataFrame) -> DataFrame:
    shared = with_share(grouped.withColumns(_total_kpis()), "total_spend", "spend_share")
    return with_share(shared, "total_conversions", "conversion_share")


def weekly_rollup(facts: DataFrame) -> DataFrame:
    """Per week (starting on Monday) and platform."""
    return facts.groupBy(F.trunc("date", "week").alias("week_start"), "platform").agg(
        *[_sum(m).alias(m) for m in BASE_MEASURES]
    )


def weekly_trends(facts: DataFrame) -> DataFrame:
    """Weekly roll-up with indicators and the change against the previous week."""
    kpis = mart_kpis(*BASE_MEASURES, prefix="")
    weekly = weekly_rollup(facts).withColumns({k: kpis[k] for k in ("ctr", "cpc", "cpa")})
    return with_wow(with_wow(weekly, "spend"), "conversions")


def insight_marts(unified: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Platform, campaign and weekly marts with the columns that the rules read.

    The facts are scanned once, into a scratch table of campaigns by week; all three
    marts come from that.
    """
    weeks = unified.groupBy(F.trunc("date", "week").alias("date"), *CAMPAIGN_KEYS).agg(
        *[_fine_sum(m).alias(m) for m in BASE_MEASURES]
    )
    stored, _ = materialise(weeks, "campaign-weeks")
    platforms = _platform_columns(stored.groupBy("platform").agg(*_totals(*BASE_MEASURES)))
    campaigns = stored.groupBy(*CAMPAIGN_KEYS).agg(*_totals(*BASE_MEASURES)).withColumns(_total_kpis())
    return platforms, campaigns, weekly_trends(stored)


def video_funnel(tiktok: DataFrame) -> DataFrame:
    """Video completion by campaign name, on the raw feed; rates are over all views."""
    grouped = tiktok.groupBy("campaign_name").agg(
        F.sum("video_views").alias("total_views"),
        *[F.sum(f"video_watch_{s}").alias(f"watched_{s}pct") for s in FUNNEL_STEPS],
    )
    return grouped.withColumns({f"rate_{s}pct": ratio(f"watched_{s}pct", "total_views", 4) for s in FUNNEL_STEPS})


def funnel_rollup(facts: DataFrame) -> DataFrame:
    """What the video funnel needs of the facts, per month and campaign name."""
    measures = ["video_views", *[f"video_watch_{s}" for s in FUNNEL_STEPS]]
    own = with_month(facts.filter(F.col("platform") == TIKTOK.platform))
    return own.groupBy(MONTH, "campaign_name").agg(*[F.sum(m).alias(m) for m in measures])


def funnel_from_rollup(rollup: DataFrame) -> DataFrame:
    return video_funnel(rollup)


QUALITY_SUMS = ("impressions", "clicks", "spend", "conversions", "conversion_value")


def quality_rollup(facts: DataFrame) -> DataFrame:
    """What the quality analysis needs of the facts, per month, campaign name and ad-group name."""
    own = with_month(facts.filter(F.col("platform") == GOOGLE.platform))
    means = [F.struct(F.sum(m).alias("total"), F.count(m).alias("n")).alias(m) for m in QUALITY_MEANS]
    return own.groupBy(MONTH, "campaign_name", "ad_group_name").agg(*[_sum(m).alias(m) for m in QUALITY_SUMS], *means)


def quality_from_rollup(rollup: DataFrame) -> DataFrame:
    return _quality(rollup, "spend", lambda m, places: ratio(f"SUM({m}.total)", f"SUM({m}.n)", places))


def quality_analysis(google: DataFrame) -> DataFrame:
    """Quality score against performance by campaign and ad-group name, on the raw feed."""
    return _quality(google, "cost", mean)


def _quality(rows: DataFrame, cost: str, averaged: Callable[[str, int], Column]) -> DataFrame:
    grouped = rows.groupBy("campaign_name", "ad_group_name").agg(
        *[averaged(m, places).alias(f"avg_{m}") for m, places in QUALITY_MEANS.items()],
        *_totals("impressions", "clicks", "conversions", "conversion_value"),
        _sum(cost).alias("total_cost"),
    )
    kpis = mart_kpis("total_impressions", "total_clicks", "total_cost", "total_conversions")
    chosen = {k: kpis[k] for k in ("avg_ctr", "avg_cpc", "avg_cpa")}
    chosen["roas"] = roas("total_conversion_value", "total_cost")
    return grouped.withColumns(chosen).select(
        "campaign_name",
        "ad_group_name",
        "avg_quality_score",
        "total_impressions",
        "total_clicks",
        "total_cost",
        "total_conversions",
        "total_conversion_value",
        *chosen,
        "avg_search_impression_share",
    )


def kpi_totals(filtered: DataFrame) -> DataFrame:
    """One row of totals and unrounded indicators; 0 where nothing can be divided."""
    totals = filtered.agg(*[F.coalesce(_sum(m), F.lit(0)).alias(f"total_{m}") for m in BASE_MEASURES])
    return totals.withColumns(
        {
            "avg_cpa": ratio_or_zero("total_spend", "total_conversions"),
            "avg_ctr": ratio_or_zero("total_clicks", "total_impressions"),
            "avg_cpc": ratio_or_zero("total_spend", "total_clicks"),
            "avg_conversion_rate": ratio_or_zero("total_conversions", "total_clicks"),
        }
    )


def platform_totals(filtered: DataFrame) -> DataFrame:
    """Spend and conversions per platform of the filtered facts."""
    return filtered.groupBy("platform").agg(*_totals("spend", "conversions"))


def funnel_totals(funnel: DataFrame) -> DataFrame:
    """The five funnel counts over all campaigns."""
    counts = ("total_views", "watched_25pct", "watched_50pct", "watched_75pct", "watched_100pct")
    return funnel.agg(*[F.sum(c).alias(c) for c in counts])
