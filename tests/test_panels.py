from decimal import Decimal

import pytest

from spendweave.operators.selection import Selection, filter_campaigns, filter_platform
from spendweave.operators.windows import latest_week, normalise_to_max, percent_of_first
from spendweave.plans import panels, pipeline
from tests import ads


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    raw = ads.frames(spark, *ads.random_feeds(seed=11, rows=60))
    return pipeline.publish_marts(*raw, str(tmp_path_factory.mktemp("marts")))


def test_dashboard_has_all_panels(published):
    frames = panels.dashboard(published["unified_ads"], published, Selection())
    assert len(frames) == 18
    assert all(df.count() > 0 for df in frames.values())


def test_funnel_and_quality_only_with_their_platform(published):
    sel = Selection(platforms=["Facebook"])
    frames = panels.dashboard(published["unified_ads"], published, sel)
    assert frames["funnel_stages"].count() == 0 and frames["quality_points"].count() == 0
    assert frames["radar"].count() == 4


def test_orders(published):
    def column(df, name):
        return [r[name] for r in df.collect()]

    marts = published
    cpm = column(panels.panel_cpm(marts["platform_summary"]), "avg_cpm")
    assert cpm == sorted(cpm)
    cpa = column(panels.panel_cpa_by_campaign(marts["campaign_performance"]), "avg_cpa")
    known = [v for v in cpa if v is not None]
    assert known == sorted(known) and cpa[: len(known)] == known
    spend = column(panels.panel_campaign_table(marts["campaign_performance"]), "Spend ($)")
    assert spend == sorted(spend, reverse=True)
    conversions = column(panels.panel_conversions(marts["unified_ads"]), "total_conversions")
    assert conversions == sorted(conversions)


def test_campaign_table_keeps_global_ranks(published):
    full = {(r.platform, r.campaign_id, r.campaign_name): r.spend_rank for r in published["campaign_performance"].collect()}
    shown = filter_campaigns(published["campaign_performance"], Selection(platforms=["TikTok"])).collect()
    assert shown and all(full[r.platform, r.campaign_id, r.campaign_name] == r.spend_rank for r in shown)


def test_radar_is_scaled_to_the_shown_platforms(spark):
    plat = spark.createDataFrame(
        [
            ("A", Decimal("0.0200"), Decimal("0.0100"), Decimal("4.00"), Decimal("0.00")),
            ("B", Decimal("0.0400"), None, Decimal("8.00"), None),
            ("C", Decimal("0.0800"), Decimal("0.0400"), Decimal("1.00"), Decimal("2.00")),
        ],
        "platform string, avg_ctr decimal(10,4), avg_conversion_rate decimal(10,4), avg_cpa decimal(10,2), avg_cpc decimal(10,2)",
    )
    sel = Selection(platforms=["A", "B"])
    got = {(r.platform, r.axis): r.value for r in panels.panel_radar(filter_platform(plat, sel)).collect()}
    assert got == {
        ("A", "CTR"): 0.5, ("B", "CTR"): 1.0, ("A", "Conv Rate"): 1.0, ("B", "Conv Rate"): 0.0,
        ("A", "Cost Eff (1/CPA)"): 1.0, ("B", "Cost Eff (1/CPA)"): 0.5,
        ("A", "Click Eff (1/CPC)"): 0.0, ("B", "Click Eff (1/CPC)"): 0.0,
    }


def test_stage_percent_without_views(spark):
    stages = spark.createDataFrame([(1, "Views", 0), (2, "25% Watched", 0)], "stage_no int, stage string, count bigint")
    assert [r.pct for r in percent_of_first(stages).collect()] == [None, None]


def test_normalise_leaves_a_column_without_positive_value(spark):
    df = spark.createDataFrame([(0.0, 2.0), (0.0, 4.0)], "a double, b double")
    assert [tuple(r) for r in normalise_to_max(df, ["a", "b"]).collect()] == [(0.0, 0.5), (0.0, 1.0)]


def test_latest_week_keeps_all_of_its_rows(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x"), (2, "y")], "week_start int, platform string")
    assert sorted(r.platform for r in latest_week(df).collect()) == ["x", "y"]


def test_tables_as_shown(spark):
    plat = spark.createDataFrame(
        [("Google", 4, 7223544, 137590, Decimal("37686.20"), 4218, Decimal("0.0190"), Decimal("0.27"), Decimal("8.93"),
          Decimal("0.0307"), Decimal("5.22"), Decimal("0.2893"), Decimal("0.3156"))],
        "platform string, campaigns bigint, total_impressions bigint, total_clicks bigint, total_spend decimal(22,2), "
        "total_conversions bigint, avg_ctr decimal(10,4), avg_cpc decimal(10,2), avg_cpa decimal(10,2), "
        "avg_conversion_rate decimal(10,4), avg_cpm decimal(10,2), spend_share decimal(10,4), conversion_share decimal(10,4)",
    )
    row = panels.panel_platform_table(plat, as_text=True).first()
    assert tuple(row) == (
        "Google", 4, "7,223,544", "137,590", "$37,686.20", "4,218", "1.90%", "$0.27", "$8.93", "3.07%", "$5.22",
        "28.9%", "31.6%",
    )
    assert row.asDict().keys() == panels.panel_platform_table(plat).first().asDict().keys()


def test_dashboard_runs_on_the_views_of_the_session(spark):
    raw = ads.frames(spark, *ads.random_feeds(seed=11, rows=60))
    views = pipeline.register_views(*raw)
    frames = panels.dashboard(views["unified_ads"], views, Selection(platforms=["Google", "TikTok"]))
    found = [r.subject for r in frames["findings"].collect()]
    assert found and "Facebook" not in found
    assert {r.kind for r in frames["recommendations"].collect()} >= {"raise_platform"}
    assert frames["funnel_stages"].count() > 0 and frames["quality_points"].count() > 0
