"""Known results, texts included, on three small feeds written out by hand."""

from decimal import Decimal as D

import pytest

from spendweave.operators.pick import ordered
from spendweave.operators.selection import Selection
from spendweave.plans import insights, pipeline
from spendweave.plans.panels import dashboard
from spendweave.sources.specs import SPECS
from spendweave.sources.store import load_raw

FEEDS = {
    "Facebook": """date,campaign_id,campaign_name,ad_set_id,ad_set_name,impressions,clicks,spend,conversions,video_views,engagement_rate,reach,frequency
2024-01-01,F1,Spring,A1,One,1000,50,25.00,5,100,0.0500,800,1.25
2024-01-08,F1,Spring,A1,One,2000,40, 40.00 ,5,NULL,,1500,1.33
""",
    "Google": """date,campaign_id,campaign_name,ad_group_id,ad_group_name,impressions,clicks,cost,conversions,conversion_value,ctr,avg_cpc,quality_score,search_impression_share
2024-01-01,G1,Search,B1,Words,500,50,100.00,20,400.00,0.1000,2.00,8,0.50
2024-01-08,G1,"Search",B1,Words,500,50,100.00,20,500.00,0.1000,2.00,7,0.60
""",
    "TikTok": """date,campaign_id,campaign_name,adgroup_id,adgroup_name,impressions,clicks,cost,conversions,video_views,video_watch_25,video_watch_50,video_watch_75,video_watch_100,likes,shares,comments
2024-01-01,T1,Dance,C1,Young,10000,100,10.00,0,8000,4000,2000,1000,500,10,2,1
2024-01-08,T1,Dance,C1,Young,10000,100,15.00,1,8000,4000,2000,1000,500,20,3,0
""",
}


@pytest.fixture(scope="module")
def marts(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("handmade")
    raw = []
    for spec in SPECS:
        (folder / f"{spec.platform}.csv").write_text(FEEDS[spec.platform])
        raw.append(load_raw(spark, str(folder / f"{spec.platform}.csv"), str(folder / spec.platform), spec))
    return pipeline.publish_marts(*raw, str(folder / "marts"))


def test_platforms(marts):
    rows = ordered(marts["platform_summary"], "platform_summary").collect()
    got = [(r.platform, r.total_spend, r.avg_cpa, r.avg_ctr, r.avg_cpc, r.avg_cpm, r.spend_share, r.conversion_share) for r in rows]
    assert got == [
        ("Google", D("200.00"), D("5.00"), D("0.1000"), D("2.00"), D("200.00"), D("0.6897"), D("0.7843")),
        ("Facebook", D("65.00"), D("6.50"), D("0.0300"), D("0.72"), D("21.67"), D("0.2241"), D("0.1961")),
        ("TikTok", D("25.00"), D("25.00"), D("0.0100"), D("0.13"), D("1.25"), D("0.0862"), D("0.0196")),
    ]


def test_campaigns(marts):
    rows = ordered(marts["campaign_performance"], "campaign_performance").collect()
    got = [(r.campaign_name, r.spend_rank, r.conversions_rank, r.cpa_rank, r.active_days, r.ad_groups, r.roas) for r in rows]
    assert got == [("Search", 1, 1, 1, 2, 1, D("4.5000")), ("Spring", 2, 2, 2, 2, 1, None), ("Dance", 3, 3, 3, 2, 1, None)]


def test_findings_in_order_with_their_texts(marts):
    found = insights.executive_insights(marts["platform_summary"], marts["campaign_performance"], marts["weekly_trends"])
    rows = insights.ordered_insights(found).collect()
    assert [r.title for r in rows] == [
        "Google delivers the lowest CPA at $5.00",
        "TikTok receives 9% of spend but only 2% of conversions",
        "Best campaign: Search (Google)",
        "Highest CPA campaign: Dance (TikTok)",
        "Google has the highest CTR at 10.00%",
        "TikTok drives the most impressions (20,000)",
        "Facebook spend increased 60.0% week-over-week",
        "Google spend decreased 0.0% week-over-week",
        "TikTok spend increased 50.0% week-over-week",
    ]
    assert rows[0].detail.startswith("Google achieves a CPA of $5.00, which is $20.00 lower than TikTok ($25.00). ")
    assert rows[3].detail.startswith("CPA of $25.00 — 5.0x higher than the best. Total spend: $25.00, conversions: 1. ")
    assert rows[8].detail.startswith("Latest week spend for TikTok: $15.00. Conversions WoW change: n/a. ")
    assert [r.severity for r in rows[6:]] == ["warning", "neutral", "warning"]


def test_recommendations(marts):
    recs = insights.budget_recommendations(marts["platform_summary"], marts["campaign_performance"]).orderBy("rec_order")
    rows = recs.collect()
    assert [r.kind for r in rows] == ["raise_platform", "scale_campaign", "optimise_campaign", "keep_diversification"]
    assert rows[0].text.startswith("**Increase Google budget share** (currently 69%): It has the lowest CPA ($5.00)")
    assert rows[2].text.startswith("**Optimize or pause:** Dance (TikTok) has a CPA of $25.00. ")


def test_dashboard_of_one_platform(marts):
    frames = dashboard(marts["unified_ads"], marts, Selection(platforms=["TikTok"]))
    assert [r.subject for r in frames["findings"].orderBy("rule_no").collect()][0] == "TikTok"
    cards = frames["kpi_cards"].first()
    assert (cards.total_impressions, cards.total_clicks, cards.total_conversions) == (20000, 200, 1)
    assert [r["count"] for r in frames["funnel_stages"].orderBy("stage_no").collect()] == [16000, 8000, 4000, 2000, 1000]
