"""The data of each dashboard panel, from filtered facts and marts.

Rows come back unsorted unless the panel defines an order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendweave.functions.kpis import inverse
from spendweave.functions.text import money, percent, whole
from spendweave.operators.pick import ordered, select_columns
from spendweave.operators.reshape import funnel_stages, to_long
from spendweave.operators.selection import (
    Selection,
    filter_campaigns,
    filter_daily,
    filter_platform,
    is_empty,
)
from spendweave.operators.windows import normalise_to_max, percent_of_first, with_share
from spendweave.plans import insights
from spendweave.plans.marts import funnel_totals, kpi_totals, platform_totals
from spendweave.plans.navigation import delivery
from spendweave.sources.specs import GOOGLE, TIKTOK

Format = Callable[[str], str]


def _percent(places: int) -> Format:
    return lambda value: percent(value, places)


# Mart column -> (shown name, number format) of the two tables.
PLATFORM_TABLE: dict[str, tuple[str, Format | None]] = {
    "platform": ("Platform", None),
    "campaigns": ("Campaigns", None),
    "total_impressions": ("Impressions", whole),
    "total_clicks": ("Clicks", whole),
    "total_spend": ("Spend ($)", money),
    "total_conversions": ("Conversions", whole),
    "avg_ctr": ("CTR", _percent(2)),
    "avg_cpc": ("CPC ($)", money),
    "avg_cpa": ("CPA ($)", money),
    "avg_conversion_rate": ("Conv Rate", _percent(2)),
    "avg_cpm": ("CPM ($)", money),
    "spend_share": ("Spend Share", _percent(1)),
    "conversion_share": ("Conv Share", _percent(1)),
}
CAMPAIGN_TABLE: dict[str, tuple[str, Format | None]] = {
    "platform": ("Platform", None),
    "campaign_name": ("Campaign", None),
    "total_spend": ("Spend ($)", money),
    "total_impressions": ("Impressions", whole),
    "total_clicks": ("Clicks", whole),
    "total_conversions": ("Conversions", whole),
    "avg_ctr": ("CTR", _percent(2)),
    "avg_cpc": ("CPC ($)", money),
    "avg_cpa": ("CPA ($)", money),
    "avg_conversion_rate": ("Conv Rate", _percent(2)),
    "spend_rank": ("Spend Rank", whole),
    "cpa_rank": ("CPA Rank", whole),
}
# Mart column -> shown name of the radar's four axes (fixed values).
RADAR_AXES = {
    "avg_ctr": "CTR",
    "avg_conversion_rate": "Conv Rate",
    "avg_cpa": "Cost Eff (1/CPA)",
    "avg_cpc": "Click Eff (1/CPC)",
}


def _table(df: DataFrame, layout: dict[str, tuple[str, Format | None]], as_text: bool) -> DataFrame:
    if as_text:
        formats = {c: F.expr(fmt(c)) for c, (_, fmt) in layout.items() if fmt}
        df = df.withColumns(formats)
    return select_columns(df, {c: shown for c, (shown, _) in layout.items()})


# Executive overview


def kpi_cards(filtered: DataFrame, as_text: bool = False) -> DataFrame:
    """The eight cards, one row; as numbers or as shown."""
    totals = kpi_totals(filtered)
    if not as_text:
        return totals
    cards = {
        "total_spend": money,
        "total_conversions": whole,
        "avg_cpa": money,
        "avg_ctr": _percent(2),
        "total_impressions": whole,
        "total_clicks": whole,
        "avg_cpc": money,
        "avg_conversion_rate": _percent(2),
    }
    return totals.selectExpr(*[f"{fmt(c)} AS {c}" for c, fmt in cards.items()])


def panel_daily_spend(daily_f: DataFrame) -> DataFrame:
    return select_columns(daily_f, ["date", "platform", "total_spend"])


def panel_spend_share(filtered: DataFrame) -> DataFrame:
    """Spend per platform and its share of the shown spend."""
    totals = platform_totals(filtered).select("platform", "total_spend")
    return with_share(totals, "total_spend", "spend_share")


def panel_conversions(filtered: DataFrame) -> DataFrame:
    totals = platform_totals(filtered).select("platform", "total_conversions")
    return totals.orderBy("total_conversions", "platform")


def panel_daily_conversions(daily_f: DataFrame) -> DataFrame:
    return select_columns(daily_f, ["date", "platform", "total_conversions"])


# Platform deep dive


def panel_platform_table(plat_f: DataFrame, as_text: bool = False) -> DataFrame:
    return _table(ordered(plat_f, "platform_summary"), PLATFORM_TABLE, as_text)


def panel_radar(plat_f: DataFrame) -> DataFrame:
    """Four efficiency axes per shown platform, each as part of the best one, in long form."""
    zero = F.lit(0.0)
    axes = plat_f.select(
        "platform",
        *[F.coalesce(F.col(c).cast("double"), zero).alias(RADAR_AXES[c]) for c in ("avg_ctr", "avg_conversion_rate")],
        *[inverse(c).alias(RADAR_AXES[c]) for c in ("avg_cpa", "avg_cpc")],
    )
    names = list(RADAR_AXES.values())
    # names with brackets and slashes have to be quoted as columns
    plain = {shown: c for c, shown in RADAR_AXES.items()}
    scaled = normalise_to_max(axes.withColumnsRenamed(plain), list(plain.values()))
    return to_long(scaled.withColumnsRenamed(RADAR_AXES), ["platform"], names, "axis", "value")


def panel_daily_cpa(daily_f: DataFrame) -> DataFrame:
    return select_columns(daily_f, ["date", "platform", "avg_cpa"])


def panel_cpm(plat_f: DataFrame) -> DataFrame:
    shown = select_columns(plat_f, ["platform", "avg_cpm"])
    return shown.orderBy(F.col("avg_cpm").asc_nulls_last(), "platform")


def panel_weekly_spend(weekly_f: DataFrame) -> DataFrame:
    return select_columns(weekly_f, ["week_start", "platform", "spend"])


def panel_funnel_stages(funnel: DataFrame, sel: Selection) -> DataFrame:
    """Five stages over all dates and campaigns; no rows unless TikTok is shown."""
    stages = percent_of_first(funnel_stages(funnel_totals(funnel)))
    return stages.filter(F.lit(sel.shows(TIKTOK.platform)) & F.col("count").isNotNull())


def panel_quality_points(quality: DataFrame, sel: Selection) -> DataFrame:
    """Quality score against CPA; no rows unless Google is shown."""
    points = select_columns(
        quality, ["campaign_name", "ad_group_name", "avg_quality_score", "avg_cpa", "total_cost"]
    )
    return points.filter(F.lit(sel.shows(GOOGLE.platform)))


# Campaign analysis


def panel_campaign_table(camp_f: DataFrame, as_text: bool = False) -> DataFrame:
    """Ranks are those over all campaigns, whatever is shown."""
    return _table(ordered(camp_f, "campaign_performance"), CAMPAIGN_TABLE, as_text)


def panel_cpa_by_campaign(camp_f: DataFrame) -> DataFrame:
    shown = select_columns(camp_f, ["platform", "campaign_id", "campaign_name", "avg_cpa"])
    order = [F.col("avg_cpa").asc_nulls_last(), "platform", "campaign_id", "campaign_name"]
    return shown.orderBy(*order).drop("campaign_id")


def panel_ctr_cvr_points(camp_f: DataFrame) -> DataFrame:
    return select_columns(
        camp_f, ["platform", "campaign_name", "avg_ctr", "avg_conversion_rate", "total_spend"]
    )


def panel_spend_conv_points(camp_f: DataFrame) -> DataFrame:
    return select_columns(
        camp_f, ["platform", "campaign_name", "total_spend", "total_conversions", "total_clicks"]
    )


def dashboard(unified: DataFrame, marts: dict[str, DataFrame], sel: Selection) -> dict[str, DataFrame]:
    """All panels of a selection by name; none where the selection is empty.

    ``marts`` are the published ones (see ``publish_marts``): then no panel reads facts, and
    cards and platform totals come from the smallest table that the selection allows; or
    the views of the session (see ``register_views``), where those read ``unified`` behind pushed
    filters. Findings and recommendations are those of the selected platforms and campaigns.
    """
    filtered = delivery(unified, marts, sel)
    if is_empty(filtered):
        return {}
    daily_f = filter_daily(marts["daily_platform_summary"], sel)
    plat_f = filter_platform(marts["platform_summary"], sel)
    weekly_f = filter_platform(marts["weekly_trends"], sel)
    camp_f = filter_campaigns(marts["campaign_performance"], sel)
    findings = insights.executive_insights(plat_f, camp_f, weekly_f)
    return {
        "kpi_cards": kpi_cards(filtered),
        "daily_spend": panel_daily_spend(daily_f),
        "spend_share": panel_spend_share(filtered),
        "conversions": panel_conversions(filtered),
        "daily_conversions": panel_daily_conversions(daily_f),
        "platform_table": panel_platform_table(plat_f),
        "radar": panel_radar(plat_f),
        "daily_cpa": panel_daily_cpa(daily_f),
        "cpm": panel_cpm(plat_f),
        "weekly_spend": panel_weekly_spend(weekly_f),
        "funnel_stages": panel_funnel_stages(marts["tiktok_video_funnel"], sel),
        "quality_points": panel_quality_points(marts["google_quality_analysis"], sel),
        "campaign_table": panel_campaign_table(camp_f),
        "cpa_by_campaign": panel_cpa_by_campaign(camp_f),
        "ctr_cvr_points": panel_ctr_cvr_points(camp_f),
        "spend_conv_points": panel_spend_conv_points(camp_f),
        "findings": insights.ordered_insights(findings),
        "recommendations": insights.budget_recommendations(plat_f, camp_f).orderBy("rec_order"),
    }
