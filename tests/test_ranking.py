import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from spendweave.operators.ranking import Ranking, with_global_ranks
from tests.ads import rank


def _values(spread):
    rng = random.Random(3)
    rows = []
    for i in range(600):
        hot = rng.random() < 0.34  # one value holds a third of all rows
        value = None if rng.random() < 0.1 else Decimal(0 if hot else rng.randrange(-spread, spread)).scaleb(-2)
        rows.append((i, value, rng.randrange(5)))
    return rows


@pytest.mark.parametrize("spread", [3, 50, 10**7])
def test_ranks_equal_sorted_positions(spark, spread):
    rows = _values(spread)
    df = spark.createDataFrame(rows, "id int, v decimal(12,2), w int")
    rankings = [Ranking("up", F.col("v")), Ranking("down", F.col("v"), descending=True), Ranking("by_w", F.col("w"))]
    want = list(
        zip(
            range(len(rows)), rank([r[1] for r in rows], False), rank([r[1] for r in rows], True),
            rank([r[2] for r in rows], False),
        )
    )
    got = with_global_ranks(df, rankings)
    assert sorted(map(tuple, got.select("id", "up", "down", "by_w").collect())) == want


def test_only_null_values_and_no_rows(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id int, v decimal(12,2)")
    assert sorted(r.r for r in with_global_ranks(df, [Ranking("r", F.col("v"))]).collect()) == [1, 1]
    assert with_global_ranks(df.where("id > 5"), [Ranking("r", F.col("v"))]).count() == 0


@pytest.mark.parametrize(
    ("kind", "values"),
    [
        ("bigint", ["-9223372036854775808", "-9223372036854775808", "0", "9223372036854775807", None]),
        ("double", ["NaN", "-0.0", "0.0", "-Infinity", "1.5", "NaN", None, None]),
        ("string", ["b", "", "a", "b", None, "\u00e9"]),
        ("date", ["2024-02-29", "1999-12-31", "2024-02-29", None]),
        ("decimal(12,2)", ["1.10", "-3.00", "1.10", None]),
    ],
)
def test_same_as_the_window_function_for_every_type(spark, kind, values):
    df = spark.createDataFrame(list(enumerate(values)), "id int, v string").withColumn("v", F.col("v").cast(kind))
    got = with_global_ranks(df, [Ranking("up", F.col("v")), Ranking("down", F.col("v"), descending=True)])
    want = df.withColumns(
        {
            "up": F.rank().over(Window.orderBy(F.col("v").asc_nulls_last())),
            "down": F.rank().over(Window.orderBy(F.col("v").desc_nulls_last())),
        }
    )
    pairs = lambda out: sorted(map(tuple, out.select("id", "up", "down").collect()))
    assert pairs(got) == pairs(want)


def test_several_ranges(spark):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(3000).withColumn("v", F.expr("(id * 7919) % 1000"))
        got = with_global_ranks(df, [Ranking("r", F.col("v")), Ranking("s", F.col("v"), descending=True)])
        assert all(r.r == 3 * r.v + 1 and r.s == 3 * (999 - r.v) + 1 for r in got.collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_rows_are_joined_back_once_for_any_number_of_rankings(spark):
    df = spark.range(500).withColumn("v", F.col("id") % 40)
    for n in (1, 2, 3):
        ranked = with_global_ranks(df, [Ranking(f"r{i}", F.col("v") + i) for i in range(n)])
        text = ranked._jdf.queryExecution().optimizedPlan().toString()
        assert text.count("Relation") == 4  # the rows, their values alone, ranges and totals of ranges
        assert text.count("Join") == 3  # of ranges with their totals, of values with ranks, and of rows with ranks


def test_a_value_of_a_third_of_all_rows_is_split(spark):
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    }
    before = {key: spark.conf.get(key, None) for key in small}
    df = spark.range(0, 20000, 1, 6).withColumn("v", F.expr("IF(id % 3 = 0, NULL, id % 5000)"))
    try:
        for key, value in small.items():
            spark.conf.set(key, value)
        ranked = with_global_ranks(df, [Ranking("r", F.col("v"))])
        got = {r.id: r.r for r in ranked.collect()}
        assert "SortMergeJoin(skew=true)" in ranked._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    values = [None if i % 3 == 0 else i % 5000 for i in range(20000)]
    below, seen = {}, 0
    for v in sorted(v for v in values if v is not None):
        below.setdefault(v, seen)
        seen += 1
    assert got == {i: 1 + (seen if v is None else below[v]) for i, v in enumerate(values)}
