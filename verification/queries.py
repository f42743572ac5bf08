"""Runnable queries: every operator on the tables of a data folder.

Results are cast to plain types (BIGINT, DOUBLE, DATE, STRING), so that they can be
compared with the SQL of ``oracles``. Each query runs over the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce
from uuid import uuid4

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendweave.operators import pick
from spendweave.operators import selection as sel
from spendweave.operators.unify import conform, unified_ads
from spendweave.operators.windows import latest_week
from spendweave.plans import audit, insights, marts, panels, pipeline
from spendweave.sources import badrows
from spendweave.sources.landing import landing_facts, raw_feeds
from spendweave.sources.specs import FACEBOOK, GOOGLE, SPECS, TIKTOK
from spendweave.sources.store import get_view, load_raw, scratch_folder

Query = Callable[[SparkSession, str], DataFrame]

EVERYTHING = sel.Selection()
# what the filter queries pick
CHOSEN = sel.Selection(
    dates=(date(1996, 3, 1), date(2000, 2, 29)),
    platforms=["Facebook", "Google"],
    campaigns=["C_Brand#2", "C_Brand#7", "C_Brand#11", "C_Brand#17", "C_Brand#23"],
)
EVIDENCE = ["rule_no", "category", "subject", "title", "detail", "severity", "value", "benchmark", "change"]


def plain(df: DataFrame) -> DataFrame:
    """Decimals as DOUBLE and integers as BIGINT."""

    def column(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        return c.alias(f.name)

    return df.select(*[column(f) for f in df.schema.fields])


def _on_facts(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: plain(build(landing_facts(spark, folder)))


def _on_delivery(build: Callable[[DataFrame], DataFrame]) -> Query:
    """On facts whose campaign columns are not looked up, since nothing reads them."""
    return lambda spark, folder: plain(build(landing_facts(spark, folder, campaigns=False)))


def _on_feed(index: int, build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: plain(build(raw_feeds(spark, folder)[index]))


def _on_feeds(build: Callable[..., DataFrame]) -> Query:
    return lambda spark, folder: plain(build(*raw_feeds(spark, folder)))


def _daily(u: DataFrame) -> DataFrame:
    return marts.daily_platform_summary(u)


def _findings(rules: list[int], build: Callable[[DataFrame], DataFrame], on=_on_delivery) -> Query:
    return on(lambda u: build(u).filter(F.col("rule_no").isin(rules)).select(*EVIDENCE))


def _platform_findings(u: DataFrame) -> DataFrame:
    return insights.platform_findings(marts.platform_summary(u, counts=False))


def _all_findings(u: DataFrame) -> DataFrame:
    findings = insights.executive_insights(*marts.insight_marts(u))
    return pick.numbered(insights.ordered_insights(findings), *EVIDENCE)


def _recommendations(u: DataFrame) -> DataFrame:
    platforms, campaigns, _ = marts.insight_marts(u)
    recs = insights.budget_recommendations(platforms, campaigns).orderBy("rec_order")
    return pick.numbered(recs, "rec_order", "kind", "subject", "text", "value")


def _selected(u: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The marts that the dashboard's findings rest on, as a selection filters them."""
    platforms, campaigns, weekly = marts.insight_marts(u)
    return (
        sel.filter_platform(platforms, CHOSEN),
        sel.filter_campaigns(campaigns, CHOSEN),
        sel.filter_platform(weekly, CHOSEN),
    )


def _view_read(spark: SparkSession, folder: str) -> DataFrame:
    """The weekly view as a warehouse shows it: upper-case names, dates as texts and timestamps."""
    weekly = marts.weekly_trends(landing_facts(spark, folder, campaigns=False))
    stored = weekly.withColumn("week_start", F.col("week_start").cast("timestamp"))
    stored.toDF(*[c.upper() for c in stored.columns]).createOrReplaceTempView("weekly_as_stored")
    return plain(get_view(spark, "weekly_as_stored"))


def _view_read_daily(spark: SparkSession, folder: str) -> DataFrame:
    daily = marts.daily_platform_summary(landing_facts(spark, folder, campaigns=False))
    stored = daily.withColumn("date", F.col("date").cast("string"))
    stored.toDF(*[c.upper() for c in stored.columns]).createOrReplaceTempView("daily_as_stored")
    return plain(get_view(spark, "daily_as_stored"))


def _empty_selection(u: DataFrame) -> DataFrame:
    """Whether selections leave nothing, and how much the last one leaves."""
    nobody = sel.Selection(campaigns=[])
    shown = [("chosen", CHOSEN), ("nobody", nobody), ("everything", EVERYTHING)]
    rows = [
        (name, int(sel.is_empty(sel.filter_facts(u, choice))), sel.filter_facts(u, choice).count()) for name, choice in shown
    ]
    return u.sparkSession.createDataFrame(rows, "selection string, is_empty bigint, row_count bigint")


def _ordered(mart: str, build: Callable[[DataFrame], DataFrame], on) -> Query:
    """The mart's keys with their place in its output order."""
    keys = [c for c, _ in pick.MART_ORDER[mart]]
    return on(lambda df: pick.numbered(pick.ordered(build(df), mart), *keys))


def _view_counts(u: DataFrame) -> DataFrame:
    return audit.view_row_counts(marts.campaign_rollup(u))


def _raw_counts(*feeds: DataFrame) -> DataFrame:
    return audit.row_counts({spec.table: raw for spec, raw in zip(SPECS, feeds)})


def _best_and_worst(u: DataFrame) -> DataFrame:
    totals = marts.campaign_totals(u).select("platform", "campaign_name", "avg_cpa", "total_spend")
    ties = [F.col("total_spend").desc(), F.col("platform"), F.col("campaign_name")]
    best = pick.best(totals, "avg_cpa", ties).withColumn("pick", F.lit("best"))
    return best.unionByName(pick.worst(totals, "avg_cpa", ties).withColumn("pick", F.lit("worst")))


def _reload_twice(spark: SparkSession, folder: str) -> DataFrame:
    """A feed loaded over itself."""
    base = f"{scratch_folder(spark)}/reload-{uuid4().hex}"
    raw_feeds(spark, folder)[0].write.option("header", True).csv(f"{base}/csv")
    load_raw(spark, f"{base}/csv", f"{base}/table", SPECS[0])
    return plain(load_raw(spark, f"{base}/csv", f"{base}/table", SPECS[0]))


def _load_dialect(spark: SparkSession, folder: str) -> DataFrame:
    """A feed with every cell quoted and padded, NULL tokens, and line breaks inside names."""
    base = f"{scratch_folder(spark)}/dialect-{uuid4().hex}"
    raw = raw_feeds(spark, folder)[0]
    cells = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns]).withColumns(
        {
            "campaign_name": F.concat("campaign_name", F.lit('\n"second", line')),
            "video_views": F.expr("CASE pmod(clicks, 4) WHEN 0 THEN 'NULL' WHEN 1 THEN 'null' WHEN 2 THEN '' ELSE concat('  ', video_views, ' ') END"),
        }
    )
    cells.write.options(header=True, quoteAll=True, escape='"').csv(f"{base}/csv")
    return plain(load_raw(spark, f"{base}/csv", f"{base}/table", SPECS[0], multi_line=True))


def _bad_row_report(spark: SparkSession, folder: str) -> DataFrame:
    """Per feed, whether its load stopped; the last row of the Google feed has a word for its clicks."""
    base, out = f"{scratch_folder(spark)}/bad-{uuid4().hex}", []
    for spec, raw in zip(SPECS, raw_feeds(spark, folder)):
        cells = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
        if spec is GOOGLE:
            cells = cells.withColumn("clicks", F.when(F.col("clicks") == "0", "none").otherwise(F.col("clicks")))
        cells.write.option("header", True).csv(f"{base}/{spec.table}")
        try:
            load_raw(spark, f"{base}/{spec.table}", f"{base}/{spec.table}-table", spec)
            out.append((spec.table, 0))
        except PySparkException:
            out.append((spec.table, 1))
    return spark.createDataFrame(out, "table_name string, stopped bigint")


def _bad_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Bad cells of the three feeds by column and kind; words for some clicks and a far date for some rows of Google's."""
    base, found = f"{scratch_folder(spark)}/bad-{uuid4().hex}", []
    for spec, raw in zip(SPECS, raw_feeds(spark, folder)):
        cells = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
        if spec is GOOGLE:
            cells = cells.withColumns({
                "clicks": F.when(F.col("clicks") == "0", "none").otherwise(F.col("clicks")),
                "date": F.when(F.col("conversions") == "5", "soon").otherwise(F.col("date")),
            })
        cells.write.option("header", True).csv(f"{base}/{spec.table}")
        bad = badrows.bad_cells(spark, f"{base}/{spec.table}", spec)
        found.append(bad.groupBy("column", "cell", "problem").agg(F.count("*").alias("n"), F.count("line").alias("n_lines")).withColumn("table_name", F.lit(spec.table)))
    return reduce(DataFrame.unionByName, found)


def _published(name: str) -> Query:
    """What a mart's table holds after publishing."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        target = f"{scratch_folder(spark)}/marts-{uuid4().hex}"
        return plain(pipeline.publish_marts(*raw_feeds(spark, folder), target)[name])

    return query


def _csv_load(index: int) -> Query:
    """Write a feed as CSV files, load them into a raw table, and read that."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        spec = SPECS[index]
        base = f"{scratch_folder(spark)}/load-{uuid4().hex}"
        raw_feeds(spark, folder)[index].write.option("header", True).csv(f"{base}/csv")
        return plain(load_raw(spark, f"{base}/csv", f"{base}/table", spec))

    return query


def _published_counts(*feeds: DataFrame) -> DataFrame:
    folder = f"{scratch_folder(feeds[0].sparkSession)}/marts-{uuid4().hex}"
    return audit.row_counts(pipeline.publish_marts(*feeds, folder))


def _published_then(build: Callable[[SparkSession, str, dict[str, DataFrame]], DataFrame]) -> Query:
    """A result that is read from a published version."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        target = f"{scratch_folder(spark)}/marts-{uuid4().hex}"
        return plain(build(spark, target, pipeline.publish_marts(*raw_feeds(spark, folder), target)))

    return query


# days that the refresh query replaces
REFRESHED = [date(1995, 5, 3), date(1995, 5, 4), date(1998, 11, 30)]


def _refreshed(name: str) -> Query:
    """A published table whose days in REFRESHED were wrong at first and were then replaced."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        target = f"{scratch_folder(spark)}/marts-{uuid4().hex}"
        feeds = raw_feeds(spark, folder)
        changed = F.col("date").isin(REFRESHED)
        wrong = [raw.where(~changed | (F.col("clicks") % 2 == 0)).withColumn("clicks", F.when(changed, F.lit(1)).otherwise(F.col("clicks")).cast("bigint")) for raw in feeds]
        pipeline.publish_marts(*wrong, target)
        return plain(pipeline.refresh_marts(*feeds, target, REFRESHED)[name])

    return query


QUERIES: dict[str, Query] = {
    # load and unify
    "load_raw_facebook": _csv_load(0),
    "load_raw_google": _csv_load(1),
    "load_raw_tiktok": _csv_load(2),
    "unify_conform_facebook": _on_feed(0, lambda raw: conform(raw, FACEBOOK)),
    "unify_conform_google": _on_feed(1, lambda raw: conform(raw, GOOGLE)),
    "unify_conform_tiktok": _on_feed(2, lambda raw: conform(raw, TIKTOK)),
    "unified_ads": _on_feeds(unified_ads),
    "unified_row_kpis": _on_facts(lambda u: u),
    "published_row_counts": _on_feeds(_published_counts),
    "raw_row_counts": lambda spark, folder: plain(_raw_counts(*raw_feeds(spark, folder, campaigns=False))),
    "view_row_counts": _on_facts(_view_counts),
    "published_daily": _published("daily_platform_summary"),
    "published_campaigns": _published("campaign_performance"),
    "published_platforms": _published("platform_summary"),
    "published_weekly": _published("weekly_trends"),
    "published_funnel": _published("tiktok_video_funnel"),
    "published_quality": _published("google_quality_analysis"),
    "refreshed_facts": _refreshed("unified_ads"),
    "refreshed_campaigns": _refreshed("campaign_performance"),
    "refreshed_quality": _refreshed("google_quality_analysis"),
    "stored_facts": _published_then(lambda spark, target, _: pipeline.read_facts(spark, target, CHOSEN)),
    "dashboard_cards": _published_then(lambda spark, target, marts: panels.dashboard(marts["unified_ads"], marts, CHOSEN)["kpi_cards"]),
    "dashboard_spend_share": _published_then(
        lambda spark, target, marts: panels.dashboard(marts["unified_ads"], marts, sel.Selection(platforms=CHOSEN.platforms))["spend_share"]
    ),
    "reload_twice": _reload_twice,
    "load_dialect": _load_dialect,
    "bad_row_report": _bad_row_report,
    "bad_cells": _bad_cells,
    "stored_row_counts": _published_then(lambda spark, target, _: audit.stored_row_counts(spark, target)),
    "stored_date_bounds": _published_then(lambda spark, target, _: audit.stored_date_bounds(spark, target)),
    "view_read": _view_read,
    "view_read_daily": _view_read_daily,
    "empty_selection": _on_facts(_empty_selection),
    # output order
    "ordered_daily": _ordered("daily_platform_summary", _daily, _on_delivery),
    "ordered_campaigns": _ordered("campaign_performance", marts.campaign_totals, _on_facts),
    "ordered_platforms": _ordered("platform_summary", marts.platform_summary, _on_facts),
    "ordered_weekly": _ordered("weekly_trends", marts.weekly_trends, _on_delivery),
    "ordered_funnel": _ordered("video_funnel", marts.video_funnel, lambda b: _on_feed(2, b)),
    "ordered_quality": _ordered("quality_analysis", marts.quality_analysis, lambda b: _on_feed(1, b)),
    "ordered_panel_conversions": _on_delivery(lambda u: pick.numbered(panels.panel_conversions(u), "platform", "total_conversions")),
    "ordered_panel_cpm": _on_delivery(
        lambda u: pick.numbered(panels.panel_cpm(marts.platform_summary(u, counts=False)), "platform", "avg_cpm")
    ),
    "ordered_panel_cpa": _on_facts(
        lambda u: pick.numbered(panels.panel_cpa_by_campaign(marts.campaign_totals(u)), "platform", "campaign_name", "avg_cpa")
    ),
    # marts
    "daily_platform_summary": _on_delivery(_daily),
    "campaign_totals": _on_facts(lambda u: marts.campaign_totals_from_rollup(marts.campaign_rollup(u))),
    "campaign_performance": _on_facts(marts.campaign_performance),
    "campaign_ranks_counted": _on_facts(
        lambda u: marts.with_ranks(marts.campaign_totals(u)).select(
            *marts.CAMPAIGN_KEYS, "spend_rank", "conversions_rank", "cpa_rank"
        )
    ),
    "platform_summary": _on_facts(marts.platform_summary),
    "weekly_rollup": _on_delivery(marts.weekly_rollup),
    "weekly_trends": _on_delivery(marts.weekly_trends),
    "video_funnel": _on_feed(2, marts.video_funnel),
    "quality_analysis": _on_feed(1, marts.quality_analysis),
    "kpi_totals": _on_delivery(marts.kpi_totals),
    "platform_totals": _on_delivery(marts.platform_totals),
    "funnel_totals": _on_feed(2, lambda raw: marts.funnel_totals(marts.video_funnel(raw))),
    "latest_week": _on_delivery(lambda u: latest_week(marts.weekly_trends(u))),
    "best_worst_campaign": _on_facts(_best_and_worst),
    # selection
    "date_bounds": _on_delivery(sel.date_bounds),
    "distinct_campaigns": _on_facts(lambda u: pick.distinct_values(u, "campaign_name")),
    "filter_options": _on_facts(lambda u: sel.filter_options(u, CHOSEN.platforms)),
    "filter_facts": _on_facts(lambda u: sel.filter_facts(u, CHOSEN)),
    "filter_daily": _on_delivery(lambda u: sel.filter_daily(_daily(u), CHOSEN)),
    "filter_campaigns": _on_facts(lambda u: sel.filter_campaigns(marts.campaign_performance(u), CHOSEN)),
    "filter_platform": _on_delivery(lambda u: sel.filter_platform(marts.weekly_trends(u), CHOSEN)),
    "filter_platform_summary": _on_facts(lambda u: sel.filter_platform(marts.platform_summary(u), CHOSEN)),
    "filter_platform_facts": _on_feeds(
        lambda *feeds: sel.filter_platform(unified_ads(*feeds), sel.Selection(platforms=["Google"]))
    ),
    # panels
    "kpi_cards": _on_facts(lambda u: panels.kpi_cards(sel.filter_facts(u, CHOSEN))),
    "kpi_cards_text": _on_facts(lambda u: panels.kpi_cards(sel.filter_facts(u, CHOSEN), as_text=True)),
    "panel_platform_table_text": _on_facts(
        lambda u: panels.panel_platform_table(marts.platform_summary(u), as_text=True)
    ),
    "panel_campaign_table_text": _on_facts(
        lambda u: panels.panel_campaign_table(marts.campaign_performance(u), as_text=True)
    ),
    "panel_daily_spend": _on_delivery(lambda u: panels.panel_daily_spend(_daily(u))),
    "panel_spend_share": _on_delivery(panels.panel_spend_share),
    "panel_conversions": _on_delivery(panels.panel_conversions),
    "panel_daily_conversions": _on_delivery(lambda u: panels.panel_daily_conversions(_daily(u))),
    "panel_platform_table": _on_facts(lambda u: panels.panel_platform_table(marts.platform_summary(u))),
    "panel_radar": _on_delivery(lambda u: panels.panel_radar(marts.platform_summary(u, counts=False))),
    "panel_daily_cpa": _on_delivery(lambda u: panels.panel_daily_cpa(_daily(u))),
    "panel_cpm": _on_delivery(lambda u: panels.panel_cpm(marts.platform_summary(u, counts=False))),
    "panel_weekly_spend": _on_delivery(lambda u: panels.panel_weekly_spend(marts.weekly_trends(u))),
    "panel_funnel_stages": _on_feed(
        2, lambda raw: panels.panel_funnel_stages(marts.video_funnel(raw), EVERYTHING)
    ),
    "panel_quality_points": _on_feed(
        1, lambda raw: panels.panel_quality_points(marts.quality_analysis(raw), EVERYTHING)
    ),
    "panel_campaign_table": _on_facts(lambda u: panels.panel_campaign_table(marts.campaign_performance(u))),
    "panel_cpa_by_campaign": _on_facts(lambda u: panels.panel_cpa_by_campaign(marts.campaign_totals(u))),
    "panel_ctr_cvr_points": _on_facts(lambda u: panels.panel_ctr_cvr_points(marts.campaign_totals(u))),
    "panel_spend_conv_points": _on_facts(lambda u: panels.panel_spend_conv_points(marts.campaign_totals(u))),
    # findings
    "insight_cpa_platform": _findings([1], _platform_findings),
    "insight_budget": _findings([2], _platform_findings),
    "insight_campaigns": _findings(
        [3, 4], lambda u: insights.campaign_findings(marts.campaign_totals(u)), on=_on_facts
    ),
    "insight_ctr_leader": _findings([5], _platform_findings),
    "insight_volume_leader": _findings([6], _platform_findings),
    "insight_trend": _findings([7], lambda u: insights.trend_findings(marts.weekly_trends(u))),
    "selected_insights": _on_facts(lambda u: insights.executive_insights(*_selected(u)).select(*EVIDENCE)),
    "selected_recommendations": _on_facts(
        lambda u: insights.budget_recommendations(*_selected(u)[:2]).select("rec_order", "kind", "subject", "text", "value")
    ),
    "executive_insights": _on_facts(_all_findings),
    "recommendations": _on_facts(_recommendations),
}
