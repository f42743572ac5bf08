from datetime import timedelta

import pytest

from spendweave.operators.pick import MART_ORDER, ordered
from spendweave.operators.unify import conform, unified_ads, unify
from spendweave.plans import marts, pipeline
from spendweave.sources.specs import GOOGLE, SPECS, UNIFIED_COLUMNS
from tests import ads
from tests.ads import DAY, as_rows, distinct, grouped, half_up, kpis, rank, rows_of, total, week

BASE = ("impressions", "clicks", "spend", "conversions")


@pytest.fixture(scope="module")
def feeds():
    return ads.random_feeds()


@pytest.fixture(scope="module")
def raw(spark, feeds):
    return tuple(df.cache() for df in ads.frames(spark, *feeds))


@pytest.fixture(scope="module")
def unified(raw):
    return unified_ads(*raw)


@pytest.fixture(scope="module")
def facts(feeds):
    return ads.facts(*feeds)


def totals(rows, prefix="total_"):
    return {f"{prefix}{m}": total(rows, m) for m in BASE}


def test_unified_rows_and_row_kpis(unified, facts):
    assert unified.columns == UNIFIED_COLUMNS
    want = [{**f, **kpis([f], "")} for f in facts]
    for row in want:
        for c in UNIFIED_COLUMNS:
            row.setdefault(c, None)
    assert rows_of(unified) == as_rows(want, UNIFIED_COLUMNS)


def test_padding_keeps_declared_types(spark, unified):
    types = dict(unified.dtypes)
    assert types["engagement_rate"] == "decimal(10,4)" and types["likes"] == "bigint"
    assert types["conversion_value"] == types["spend"] == "decimal(12,2)"


def test_conform_drops_source_ratios(raw):
    google = conform(raw[1], GOOGLE)
    assert "ctr" not in google.columns and "avg_cpc" not in google.columns
    assert google.select("platform").distinct().collect() == [("Google",)]


def want_daily(facts):
    return [
        {"date": d, "platform": p, "ad_groups_active": len(rows), **totals(rows), **kpis(rows),
         "total_video_views": total(rows, "video_views")}
        for (d, p), rows in grouped(facts, "date", "platform").items()
    ]


def want_campaigns(facts):
    out = []
    for (p, i, n), rows in grouped(facts, "platform", "campaign_id", "campaign_name").items():
        days = [r["date"] for r in rows]
        out.append(
            {
                "platform": p, "campaign_id": i, "campaign_name": n,
                "first_active_date": min(days), "last_active_date": max(days),
                "active_days": distinct(rows, "date"), "ad_groups": distinct(rows, "ad_group_id"),
                **totals(rows), **kpis(rows),
                "total_video_views": total(rows, "video_views"),
                "total_conversion_value": total(rows, "conversion_value"),
                "roas": half_up(total(rows, "conversion_value"), total(rows, "spend"), 2),
                **{f"total_{m}": total(rows, m) for m in ("likes", "shares", "comments")},
            }
        )
    exact = [None if not c["total_conversions"] else c["total_spend"] / c["total_conversions"] for c in out]
    ranks = zip(
        rank([c["total_spend"] for c in out], True), rank([c["total_conversions"] for c in out], True), rank(exact, False)
    )
    for c, (s, v, a) in zip(out, ranks):
        c.update(spend_rank=s, conversions_rank=v, cpa_rank=a)
    return out


def want_platforms(facts):
    spend, conversions = total(facts, "spend"), total(facts, "conversions")
    return [
        {
            "platform": p, "campaigns": distinct(rows, "campaign_id"), "ad_groups": distinct(rows, "ad_group_id"),
            "active_days": distinct(rows, "date"), **totals(rows), **kpis(rows),
            "spend_share": half_up(total(rows, "spend"), spend, 4),
            "conversion_share": half_up(total(rows, "conversions"), conversions, 4),
        }
        for (p,), rows in grouped(facts, "platform").items()
    ]


def want_weekly(facts):
    by_week = grouped([{**f, "week": week(f["date"])} for f in map(dict, facts)], "platform", "week")
    out, previous = [], {}
    for p, w in sorted(by_week):
        rows = by_week[p, w]
        now = {m: total(rows, m) for m in BASE}
        shown = {k: v for k, v in kpis(rows, "").items() if k in ("ctr", "cpc", "cpa")}
        change = {}
        for m in ("spend", "conversions"):
            before = previous.get(p, {}).get(m)
            change[f"{m}_wow_change"] = None if before is None else half_up(now[m] - before, before, 4)
        out.append({"week_start": w, "platform": p, **now, **shown, **change})
        previous[p] = now
    return out


def test_daily(unified, facts):
    df = marts.daily_platform_summary(unified)
    assert rows_of(df) == as_rows(want_daily(facts), df.columns)


def test_campaigns_with_ranks(unified, facts):
    want = want_campaigns(facts)
    df = marts.campaign_performance(unified)
    assert len(df.columns) == 25
    assert rows_of(df) == as_rows(want, df.columns)
    plain = marts.campaign_totals(unified)
    assert rows_of(plain) == as_rows(want, plain.columns)
    counted = marts.with_ranks(plain)
    assert rows_of(counted, *df.columns) == as_rows(want, df.columns)


def test_platforms(unified, facts):
    df = marts.platform_summary(unified)
    assert rows_of(df) == as_rows(want_platforms(facts), df.columns)


def test_weekly(unified, facts):
    df = marts.weekly_trends(unified)
    assert rows_of(df) == as_rows(want_weekly(facts), df.columns)


def test_marts_from_one_rollup_are_the_same(unified, facts):
    got = pipeline.marts_from_rollup(pipeline.stored_rollup(unified))
    want = {
        "daily_platform_summary": want_daily(facts),
        "campaign_totals": want_campaigns(facts),
        "platform_summary": want_platforms(facts),
        "weekly_trends": want_weekly(facts),
    }
    for name, df in got.items():
        assert rows_of(df) == as_rows(want[name], df.columns), name


def test_insight_marts_agree_with_the_full_ones(unified):
    small = marts.insight_marts(unified)
    full = (marts.platform_summary(unified), marts.campaign_totals(unified), marts.weekly_trends(unified))
    for a, b in zip(small, full):
        assert rows_of(a) == rows_of(b, *a.columns)


def test_funnel(raw, facts):
    steps = {"25": "video_watch_25", "50": "video_watch_50", "75": "video_watch_75", "100": "video_watch_100"}
    want = []
    for (n,), rows in grouped([f for f in facts if f["platform"] == "TikTok"], "campaign_name").items():
        views = total(rows, "video_views")
        want.append(
            {
                "campaign_name": n, "total_views": views,
                **{f"watched_{s}pct": total(rows, c) for s, c in steps.items()},
                **{f"rate_{s}pct": half_up(total(rows, c), views, 4) for s, c in steps.items()},
            }
        )
    df = marts.video_funnel(raw[2])
    assert rows_of(df) == as_rows(want, df.columns)
    sums = marts.funnel_totals(df).first()
    assert sums.total_views == total(want, "total_views") and sums.watched_100pct == total(want, "watched_100pct")


def test_quality(raw, facts):
    want = []
    google = [f for f in facts if f["platform"] == "Google"]
    for (n, g), rows in grouped(google, "campaign_name", "ad_group_name").items():
        scores = [r["quality_score"] for r in rows if r["quality_score"] is not None]
        shares = [r["search_impression_share"] for r in rows if r["search_impression_share"] is not None]
        all_totals = totals(rows)
        want.append(
            {
                "campaign_name": n, "ad_group_name": g,
                "avg_quality_score": half_up(sum(scores), len(scores), 1),
                "avg_search_impression_share": half_up(sum(shares), len(shares), 2),
                "total_cost": all_totals.pop("total_spend"), **all_totals,
                "total_conversion_value": total(rows, "conversion_value"),
                **{k: v for k, v in kpis(rows).items() if k in ("avg_ctr", "avg_cpc", "avg_cpa")},
                "roas": half_up(total(rows, "conversion_value"), total(rows, "spend"), 2),
            }
        )
    df = marts.quality_analysis(raw[1])
    assert rows_of(df) == as_rows(want, df.columns)


def test_roll_ups_agree_and_union_order_does_not_matter(raw, unified, facts):
    spend = total(facts, "spend")
    for df, column in (
        (marts.daily_platform_summary(unified), "total_spend"),
        (marts.campaign_totals(unified), "total_spend"),
        (marts.platform_summary(unified), "total_spend"),
        (marts.weekly_rollup(unified), "spend"),
    ):
        assert df.agg({column: "sum"}).first()[0] == spend
    turned = unify(*[conform(r, s) for r, s in reversed(list(zip(raw, SPECS)))])
    assert rows_of(marts.platform_summary(turned)) == rows_of(marts.platform_summary(unified))
    assert unified.count() == len(facts)


def test_shares_add_to_one(unified):
    row = marts.platform_summary(unified).agg({"spend_share": "sum", "conversion_share": "sum"}).first()
    assert all(abs(float(v) - 1) <= 3 * 0.00005 for v in row)


def test_empty_feeds_give_empty_marts(spark):
    raw = ads.frames(spark)
    unified = unified_ads(*raw)
    frames = [
        marts.daily_platform_summary(unified), marts.campaign_performance(unified), marts.platform_summary(unified),
        marts.weekly_trends(unified), marts.video_funnel(raw[2]), marts.quality_analysis(raw[1]),
        marts.with_ranks(marts.campaign_totals(unified)),
    ]
    assert [df.count() for df in frames] == [0] * len(frames)
    assert tuple(marts.kpi_totals(unified).first()) == (0, 0, 0, 0, 0.0, 0.0, 0.0, 0.0)


def _campaigns(spark, *rows):
    unified = unified_ads(*ads.frames(spark, facebook=[ads.facebook_row(**r) for r in rows]))
    return {r.campaign_id: r for r in marts.campaign_performance(unified).collect()}


def test_campaign_without_conversions_ranks_last(spark):
    got = _campaigns(spark, dict(campaign="a", conversions=0), dict(campaign="b", spend="999.00"))
    assert got["a"].avg_cpa is None and got["a"].cpa_rank == 2 and got["b"].cpa_rank == 1


def test_equal_spend_shares_a_rank_and_skips_the_next(spark):
    got = _campaigns(spark, dict(campaign="a"), dict(campaign="b"), dict(campaign="c", spend="1.00"))
    assert [got[c].spend_rank for c in "abc"] == [1, 1, 3]


def test_cpa_is_ranked_unrounded(spark):
    got = _campaigns(
        spark, dict(campaign="a", spend="10.00", conversions=3), dict(campaign="b", spend="10.01", conversions=3),
        dict(campaign="c", spend="9.99", conversions=3),
    )
    assert got["a"].avg_cpa == ads.cents("3.33") and got["c"].avg_cpa == ads.cents("3.33")
    assert [got[c].cpa_rank for c in "cab"] == [1, 2, 3]


def test_renamed_campaign_is_two_rows(spark):
    unified = unified_ads(*ads.frames(spark, [ads.facebook_row(name="Old"), ads.facebook_row(name="New")]))
    assert marts.campaign_totals(unified).count() == 2


def test_two_campaigns_with_one_name_merge_in_funnel_and_quality(spark):
    raw = ads.frames(
        spark, google=[ads.google_row(campaign=c, name="Same") for c in "ab"],
        tiktok=[ads.tiktok_row(campaign=c, name="Same") for c in "ab"],
    )
    assert marts.video_funnel(raw[2]).select("campaign_name", "total_views").collect() == [("Same", 160)]
    assert marts.quality_analysis(raw[1]).select("total_clicks").collect() == [(20,)]


def test_change_is_against_the_last_week_present(spark):
    days = [(0, "10.00"), (21, "15.00"), (28, "0.00"), (35, "4.00")]
    rows = [ads.facebook_row(day=DAY + timedelta(days=d), spend=s, conversions=2) for d, s in days]
    got = marts.weekly_trends(unified_ads(*ads.frames(spark, rows))).orderBy("week_start").collect()
    assert [None if r.spend_wow_change is None else float(r.spend_wow_change) for r in got] == [None, 0.5, -1.0, None]


def test_output_order(unified, raw):
    names = {
        "daily_platform_summary": marts.daily_platform_summary(unified),
        "campaign_performance": marts.campaign_totals(unified),
        "platform_summary": marts.platform_summary(unified),
        "weekly_trends": marts.weekly_trends(unified),
        "video_funnel": marts.video_funnel(raw[2]),
        "quality_analysis": marts.quality_analysis(raw[1]),
    }
    assert names.keys() == MART_ORDER.keys()
    first = ordered(names["platform_summary"], "platform_summary").collect()
    assert [r.total_spend for r in first] == sorted([r.total_spend for r in first], reverse=True)
    for name, df in names.items():
        assert ordered(df, name).count() == df.count()


def test_publish_and_views(spark, raw, facts, tmp_path):
    out = pipeline.publish_marts(*raw, str(tmp_path / "marts"))
    again = pipeline.publish_marts(*raw, str(tmp_path / "marts"))
    views = pipeline.register_views(*raw)
    assert set(out) == set(again) == {
        "unified_ads", "daily_platform_summary", "campaign_performance", "platform_summary", "weekly_trends",
        "tiktok_video_funnel", "google_quality_analysis",
    }
    for name, df in views.items():
        assert rows_of(spark.table(name)) == rows_of(again[name], *df.columns), name
