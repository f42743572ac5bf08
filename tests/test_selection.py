from datetime import date, timedelta

import pytest

from spendweave.operators.pick import best, distinct_values, select_columns, worst
from spendweave.operators.selection import (
    Selection,
    date_bounds,
    filter_campaigns,
    filter_daily,
    filter_facts,
    filter_options,
    filter_platform,
    is_empty,
)
from spendweave.operators.unify import unified_ads
from spendweave.plans import marts, panels
from tests import ads
from tests.ads import DAY


@pytest.fixture(scope="module")
def unified(spark):
    days = [DAY + timedelta(days=d) for d in range(3)]
    raw = ads.frames(
        spark,
        [ads.facebook_row(day=d, campaign=c) for d in days for c in "ab"],
        [ads.google_row(day=d, campaign="b") for d in days],
        [ads.tiktok_row(day=d, campaign="t") for d in days[:2]],
    )
    return unified_ads(*raw)


def test_everything_by_default(unified):
    assert filter_facts(unified, Selection()).count() == 11


def test_dates_are_inclusive_and_combined(unified):
    sel = Selection(dates=(DAY, DAY + timedelta(days=1)), platforms=["Facebook", "Google"], campaigns=["N_b"])
    assert filter_facts(unified, sel).count() == 4


@pytest.mark.parametrize("dates", [(DAY,), (), None])
def test_a_range_that_is_not_two_dates_is_no_filter(unified, dates):
    assert filter_facts(unified, Selection(dates=dates)).count() == 11
    assert filter_daily(marts.daily_platform_summary(unified), Selection(dates=dates)).count() == 8


@pytest.mark.parametrize("sel", [Selection(platforms=[]), Selection(campaigns=[]), Selection(campaigns=["unknown"])])
def test_empty_selection_matches_nothing_and_stops_the_dashboard(unified, sel):
    filtered = filter_facts(unified, sel)
    assert is_empty(filtered)
    assert tuple(panels.kpi_cards(filtered).first()) == (0, 0, 0, 0, 0.0, 0.0, 0.0, 0.0)
    assert panels.dashboard(unified, {}, sel) == {}


def test_each_mart_has_its_own_filters(unified):
    sel = Selection(dates=(DAY, DAY), platforms=["Facebook"], campaigns=["N_a"])
    assert filter_daily(marts.daily_platform_summary(unified), sel).count() == 1
    assert filter_daily(marts.daily_platform_summary(unified), sel).first().total_clicks == 20  # both campaigns
    campaigns = filter_campaigns(marts.campaign_performance(unified), sel).collect()
    assert [(c.campaign_id, c.active_days) for c in campaigns] == [("a", 3)]  # all days
    platforms = filter_platform(marts.platform_summary(unified), sel).collect()
    assert len(platforms) == 1 and float(platforms[0].spend_share) == 0.5455  # share of all platforms


def test_options(unified):
    got = [tuple(r) for r in filter_options(unified, ["Google", "TikTok"]).collect()]
    assert got == [
        ("campaign", "N_b"), ("campaign", "N_t"), ("date_max", "2024-01-03"), ("date_min", "2024-01-01"),
        ("platform", "Facebook"), ("platform", "Google"), ("platform", "TikTok"),
    ]
    assert [r.value for r in filter_options(unified, []).filter("option = 'campaign'").collect()] == []


def test_options_of_nothing(spark):
    assert filter_options(unified_ads(*ads.frames(spark))).count() == 0


def test_bounds_and_distinct_values(unified):
    assert tuple(date_bounds(unified).first()) == (date(2024, 1, 1), date(2024, 1, 3))
    assert [r[0] for r in distinct_values(unified, "campaign_name").collect()] == ["N_a", "N_b", "N_t"]


def test_best_and_worst_skip_null_and_break_ties(spark):
    df = spark.createDataFrame([("a", 2, 1), ("b", 2, 5), ("c", 9, 1), ("d", None, 9)], "n string, m int, s int")
    ties = [df.s.desc(), df.n]
    assert best(df, "m", ties).first().n == "b" and worst(df, "m", ties).first().n == "c"
    assert best(df.filter("m is null"), "m", ties).count() == 0


def test_named_columns(spark):
    df = spark.range(1).selectExpr("id", "id + 1 as b", "id + 2 as c")
    assert select_columns(df, ["c", "id"]).columns == ["c", "id"]
    assert select_columns(df, {"b": "B ($)"}).columns == ["B ($)"]
