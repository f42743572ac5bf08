import random
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from spendweave.functions import kpis, text
from tests.ads import half_up

COUNTS = st.integers(min_value=-(10**9), max_value=10**9)
AMOUNTS = st.integers(min_value=-(10**11), max_value=10**11)


def _frame(spark, rows):
    data = [(i, c, Decimal(s).scaleb(-2), v) for i, c, s, v in rows]
    return spark.createDataFrame(data, "i bigint, c bigint, s decimal(12,2), v bigint")


def _expected(i, c, s, v):
    spend = Decimal(s).scaleb(-2)
    return (
        half_up(c, i, 4), half_up(spend, c, 2), half_up(spend, v, 2), half_up(v, c, 4), half_up(spend * 1000, i, 2)
    )


def _check(spark, rows):
    df = _frame(spark, rows)
    names = ["ctr", "cpc", "cpa", "conversion_rate", "cpm"]
    by_row = kpis.row_kpis("i", "c", "s", "v")
    by_sum = kpis.mart_kpis("i", "c", "s", "v", prefix="")
    got = df.select(*[by_row[n] for n in names], *[by_sum[n] for n in names]).collect()
    for row, values in zip(rows, got):
        assert tuple(values[:5]) == _expected(*row), row
        assert tuple(values[5:]) == _expected(*row), row


def test_zero_denominators_ties_and_signs(spark):
    rng = random.Random(1)
    rows = [(0, 0, 0, 0), (0, 5, 100, 1), (8, 1, 1, 8), (20000, 1, 1, 2), (20000, -1, -1, 2), (-20000, 1, 1, -2)]
    rows += [(rng.randrange(0, 30), rng.randrange(0, 9), rng.randrange(-99, 999), rng.randrange(0, 5)) for _ in range(400)]
    _check(spark, rows)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(COUNTS, COUNTS, AMOUNTS, COUNTS), min_size=1, max_size=60))
def test_both_forms_equal_exact_rounding(spark, rows):
    _check(spark, rows)


def test_overflow_of_a_row_fails_loudly(spark):
    df = spark.createDataFrame([(1, 2**62)], "i bigint, c bigint")
    with pytest.raises(Exception, match="OVERFLOW"):
        df.select(kpis.row_ratio("c", "i", 4)).collect()


def test_null_operand_gives_null(spark):
    df = spark.createDataFrame([(None, 3), (3, None)], "a bigint, b bigint")
    got = df.select(kpis.row_ratio("a", "b", 4).alias("x"), kpis.ratio("a", "b", 4).alias("y")).collect()
    assert [tuple(r) for r in got] == [(None, None), (None, None)]


def test_guards(spark):
    df = spark.createDataFrame([(4.0, 0.0), (0.0, 2.0), (-1.0, None)], "a double, b double")
    got = df.select(kpis.inverse("a").alias("i"), kpis.ratio_or_zero("a", "b").alias("z")).collect()
    assert [tuple(r) for r in got] == [(0.25, 0.0), (0.0, 0.0), (0.0, 0.0)]


def test_number_texts_round_in_decimal(spark):
    df = spark.createDataFrame([(Decimal("1234.50"), Decimal("0.7155"), 28708167)], "m decimal(12,2), p decimal(10,4), n bigint")
    row = df.selectExpr(
        text.money("m"), text.percent("p", 1), text.percent("-p", 0), text.whole("n"), text.times("4.85"),
        text.fill("{a} of {b}'s!", {"a": "'x'", "b": "CAST(NULL AS STRING)"}),
    ).first()
    assert tuple(row) == ("$1,234.50", "71.6%", "-72%", "28,708,167", "4.9x", "x of n/a's!")


def test_totals_beyond_a_quintillion(spark):
    row = "12e17 AS clicks, 3e18 AS impressions, cast('99999999999999999999.99' AS decimal(22,2)) AS spend, 7 AS conversions"
    df = spark.sql(f"SELECT cast(clicks AS bigint) clicks, cast(impressions AS bigint) impressions, spend, cast(conversions AS bigint) conversions FROM (SELECT {row})")
    got = df.select(*[c.alias(n) for n, c in kpis.mart_kpis("impressions", "clicks", "spend", "conversions").items()]).first()
    assert str(got.avg_ctr) == "0.4000" and str(got.avg_cpc) == "83.33"
    assert str(got.avg_cpa) == "14285714285714285714.28"
