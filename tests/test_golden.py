"""Known results on real feeds: set ADS_FEED_DIR to a folder with the three CSV feeds of January 2024.

The files are told apart by their header.
"""

import os
from decimal import Decimal
from pathlib import Path

import pytest

from spendweave.operators.pick import ordered
from spendweave.operators.unify import unified_ads
from spendweave.plans import audit, insights, marts, panels
from spendweave.sources.specs import SPECS
from spendweave.sources.store import read_raw

FOLDER = os.environ.get("ADS_FEED_DIR")
pytestmark = pytest.mark.skipif(not FOLDER, reason="ADS_FEED_DIR is not set")
D = Decimal


@pytest.fixture(scope="module")
def raw(spark):
    by_header = {f.read_text().split("\n", 1)[0].strip(): str(f) for f in Path(FOLDER).glob("*.csv")}
    return tuple(read_raw(spark, by_header[",".join(s.columns)], s) for s in SPECS)


@pytest.fixture(scope="module")
def unified(raw):
    return unified_ads(*raw).cache()


def test_counts(raw, unified):
    tables = dict(zip("fgt", raw), u=unified, d=marts.daily_platform_summary(unified), w=marts.weekly_rollup(unified))
    counts = dict(tuple(r) for r in audit.row_counts(tables).collect())
    assert counts == {"f": 110, "g": 110, "t": 110, "u": 330, "d": 90, "w": 15}


def test_platforms(unified):
    rows = ordered(marts.platform_summary(unified), "platform_summary").select(
        "platform", "total_spend", "avg_ctr", "avg_cpc", "avg_cpa", "avg_conversion_rate", "avg_cpm", "spend_share",
        "conversion_share",
    )
    assert [tuple(map(str, r)) for r in rows.collect()] == [
        ("TikTok", "74266.70", "0.0161", "0.16", "11.00", "0.0146", "2.59", "0.5702", "0.5051"),
        ("Google", "37686.20", "0.0190", "0.27", "8.93", "0.0307", "5.22", "0.2893", "0.3156"),
        ("Facebook", "18292.00", "0.0196", "0.21", "7.64", "0.0269", "4.03", "0.1404", "0.1792"),
    ]


def test_campaign_ranks(unified):
    rows = ordered(marts.campaign_performance(unified), "campaign_performance").collect()
    assert [(r.campaign_id, r.active_days, str(r.avg_cpa), r.spend_rank, r.conversions_rank, r.cpa_rank) for r in rows] == [
        ("tt_8004", 26, "9.92", 1, 1, 7), ("tt_8002", 27, "10.00", 2, 2, 8), ("tt_8001", 30, "13.00", 3, 5, 9),
        ("g_5002", 27, "24.80", 4, 9, 12), ("tt_8003", 27, "14.06", 5, 7, 10), ("g_5003", 27, "6.34", 6, 3, 3),
        ("g_5001", 30, "5.10", 7, 4, 1), ("fb_1002", 28, "5.95", 8, 6, 2), ("fb_1003", 27, "7.52", 9, 8, 4),
        ("fb_1001", 30, "9.44", 10, 10, 5), ("g_5004", 26, "9.72", 11, 11, 6), ("fb_1004", 25, "14.96", 12, 12, 11),
    ]
    assert {r.campaign_id: str(r.roas) for r in rows if r.roas is not None} == {
        "g_5002": "2.02", "g_5003": "7.89", "g_5001": "9.81", "g_5004": "5.15"
    }


def test_weekly_changes(unified):
    rows = ordered(marts.weekly_trends(unified), "weekly_trends").collect()
    assert [str(r.spend_wow_change) for r in rows] == [
        "None", "None", "None", "0.1346", "0.1529", "0.3006", "0.1441", "0.1312", "0.1996", "0.0209", "0.0471", "0.0667",
        "-0.7151", "-0.7199", "-0.7155",
    ]


def test_funnel_and_quality(raw):
    funnel = ordered(marts.video_funnel(raw[2]), "video_funnel").collect()
    assert [(r.campaign_name, str(r.rate_50pct)) for r in funnel] == [
        ("Influencer_Collab", "0.6468"), ("Awareness_GenZ", "0.4908"), ("Traffic_Campaign", "0.6014"),
        ("Conversion_Focus", "0.4991"),
    ]
    quality = ordered(marts.quality_analysis(raw[1]), "quality_analysis").collect()
    assert [(str(r.avg_quality_score), str(r.avg_search_impression_share)) for r in quality] == [
        ("9.0", "0.91"), ("8.0", "0.67"), ("7.0", "0.35"), ("6.8", "0.44")
    ]


def test_cards(unified):
    assert tuple(panels.kpi_cards(unified, as_text=True).first()) == (
        "$130,244.90", "13,363", "$9.75", "1.70%", "40,473,185", "688,333", "$0.19", "1.94%"
    )


def test_findings_and_recommendations(unified):
    plat, camp, weekly = marts.insight_marts(unified)
    rows = insights.ordered_insights(insights.executive_insights(plat, camp, weekly)).collect()
    assert [(r.category, r.subject, r.severity) for r in rows] == [
        ("Efficiency", "Facebook", "positive"), ("Budget", "Facebook", "positive"),
        ("Campaign", "Search_Brand_Terms", "positive"), ("Campaign", "Search_Generic_Terms", "warning"),
        ("Engagement", "Facebook", "positive"), ("Reach", "TikTok", "neutral"),
        ("Trend", "Facebook", "warning"), ("Trend", "Google", "warning"), ("Trend", "TikTok", "warning"),
    ]
    recs = insights.budget_recommendations(plat, camp).orderBy("rec_order").collect()
    assert [r.subject for r in recs] == ["Facebook", "Search_Brand_Terms", "Search_Generic_Terms", "all"]
