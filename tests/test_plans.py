"""What Catalyst makes of the declared plans."""

from datetime import date
from pathlib import Path

import pytest

from pyspark.sql import functions as F

from spendweave.operators.selection import Selection, filter_daily, filter_facts, filter_platform
from spendweave.operators.unify import unified_ads
from spendweave.plans import audit, insights, marts
from spendweave.sources.landing import landing_facts, raw_feeds
from spendweave.sources.store import publish
from tests import ads

DATA = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not Path(DATA).exists(), reason="no test data")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    raw = ads.frames(spark, *ads.random_feeds(rows=20))
    return tuple(publish(df, str(folder / str(i))) for i, df in enumerate(raw))


def test_platform_filter_reads_one_feed(stored):
    unified = unified_ads(*stored)
    assert plan_of(unified).count("FileScan") == 3
    one = plan_of(filter_platform(marts.weekly_trends(unified), Selection(platforms=["Google"])))
    assert one.count("FileScan") == 1 and "Union" not in one


def test_date_filter_above_an_aggregate_reaches_the_scan(stored):
    daily = marts.daily_platform_summary(unified_ads(*stored))
    plan = plan_of(filter_daily(daily, Selection(dates=(date(2024, 1, 5), date(2024, 1, 9)))))
    assert plan.count("GreaterThanOrEqual(date,2024-01-05)") == 3
    assert plan.count("LessThanOrEqual(date,2024-01-09)") == 3


def test_campaign_filter_reaches_the_scan(stored):
    totals = marts.campaign_totals(unified_ads(*stored))
    plan = plan_of(totals.filter("campaign_name = 'N_hot'"))
    assert plan.count("EqualTo(campaign_name,N_hot)") == 3


def test_marts_read_only_what_they_need(stored):
    plan = plan_of(marts.weekly_rollup(unified_ads(*stored)))
    schemas = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert len(schemas) == 3
    assert all("video" not in s and "campaign" not in s and "ad_" not in s for s in schemas)


def test_union_does_not_shuffle(stored):
    assert "Exchange" not in plan_of(unified_ads(*stored))


def test_unused_distinct_counts_cost_nothing(stored):
    totals = marts.campaign_totals(unified_ads(*stored))
    assert "Expand" in plan_of(totals)
    assert "Expand" not in plan_of(totals.select("platform", "campaign_name", "avg_cpa"))
    assert "Expand" not in plan_of(insights.platform_findings(marts.platform_summary(unified_ads(*stored))))


def test_sums_are_combined_before_the_shuffle(stored):
    plan = plan_of(marts.daily_platform_summary(unified_ads(*stored)))
    assert "partial_sum" in plan and "SortAggregate" not in plan


def test_no_python_in_any_plan(stored):
    unified = unified_ads(*stored)
    for df in (
        unified, marts.daily_platform_summary(unified), marts.campaign_performance(unified),
        marts.platform_summary(unified), marts.weekly_trends(unified), marts.video_funnel(stored[2]),
        marts.quality_analysis(stored[1]), insights.executive_insights(*marts.insight_marts(unified)),
    ):
        plan = plan_of(df)
        assert "Python" not in plan and "InPandas" not in plan and "CartesianProduct" not in plan


@needs_data
def test_single_scan_equals_the_three_feeds(spark):
    one, three = landing_facts(spark, DATA), unified_ads(*raw_feeds(spark, DATA))
    assert one.schema.simpleString() == three.schema.simpleString()
    assert one.exceptAll(three).count() == 0 and three.exceptAll(one).count() == 0
    assert plan_of(one).count("lineitem.parquet") == 1


@needs_data
def test_queries_without_campaigns_do_not_join(spark):
    facts = landing_facts(spark, DATA, campaigns=False)
    assert facts.schema == landing_facts(spark, DATA).schema
    assert "Join" not in plan_of(marts.daily_platform_summary(facts))
    chosen = Selection(dates=(date(1996, 1, 1), date(1997, 1, 1)))
    assert "GreaterThanOrEqual(l_shipdate,1996-01-01" in plan_of(filter_facts(facts, chosen))


@needs_data
def test_a_part_with_a_third_of_all_rows_is_split(spark, tmp_path):
    lineitem = spark.read.parquet(f"{DATA}/lineitem.parquet")
    hot = lineitem.withColumn("l_partkey", F.expr("IF(l_linenumber < 3, 7, l_partkey)"))
    hot.repartition(6).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.read.parquet(f"{DATA}/part.parquet").write.parquet(str(tmp_path / "part.parquet"))
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    }
    before = {key: spark.conf.get(key, None) for key in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        totals = marts.campaign_totals_from_rollup(
            marts.campaign_rollup(landing_facts(spark, str(tmp_path)))
        )
        rows = sorted(totals.collect(), key=str)
        plan = totals._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    plain = marts.campaign_totals(landing_facts(spark, str(tmp_path)))
    assert sorted(plain.collect(), key=str) == rows


def test_view_counts_scan_each_feed_once(stored):
    plan = plan_of(audit.view_row_counts(marts.campaign_rollup(unified_ads(*stored))))
    assert plan.count("FileScan parquet") == 3
