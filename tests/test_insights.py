from decimal import Decimal

import pytest

from spendweave.plans.insights import (
    budget_recommendations,
    campaign_findings,
    executive_insights,
    ordered_insights,
    platform_findings,
    trend_findings,
)

PLATFORM = (
    "platform string, total_spend decimal(22,2), total_impressions bigint, avg_ctr decimal(10,4), avg_cpc decimal(10,2), "
    "avg_cpa decimal(10,2), avg_conversion_rate decimal(10,4), avg_cpm decimal(10,2), spend_share decimal(10,4), "
    "conversion_share decimal(10,4)"
)
CAMPAIGN = (
    "platform string, campaign_name string, avg_cpa decimal(10,2), total_conversions bigint, total_spend decimal(22,2), "
    "avg_ctr decimal(10,4), avg_conversion_rate decimal(10,4)"
)
WEEKLY = (
    "week_start date, platform string, spend decimal(22,2), spend_wow_change decimal(10,4), "
    "conversions_wow_change decimal(10,4)"
)
D = Decimal


def platform(name, spend="100.00", impressions=1000, ctr="0.0100", cpa="5.00", spend_share="0.5000", conv_share="0.5000"):
    cpa = None if cpa is None else D(cpa)
    ctr = None if ctr is None else D(ctr)
    return (name, D(spend), impressions, ctr, D("0.50"), cpa, D("0.0300"), D("4.00"), D(spend_share), D(conv_share))


def campaign(name, cpa="5.00", spend="100.00"):
    return ("Google", name, None if cpa is None else D(cpa), 20, D(spend), D("0.0522"), D("0.0374"))


@pytest.fixture(scope="module")
def make(spark):
    def frame(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    return frame


def subjects(df, rule):
    return [r.subject for r in df.filter(f"rule_no = {rule}").collect()]


def test_lowest_cpa_and_gap(make):
    df = platform_findings(make(PLATFORM, platform("A", cpa="7.64"), platform("B", cpa="11.00"), platform("C", cpa=None)))
    row = df.filter("rule_no = 1").first()
    assert (row.category, row.subject, row.severity) == ("Efficiency", "A", "positive")
    assert (row.value, row.benchmark, row.change) == (D("7.64"), D("11.00"), D("3.36"))
    assert row.title == "A delivers the lowest CPA at $7.64"
    assert row.detail.startswith("A achieves a CPA of $7.64, which is $3.36 lower than B ($11.00).")


@pytest.mark.parametrize(
    "spend_share, conv_share, severity",
    [
        ("0.5000", "0.4000", None),  # exactly 0.8
        ("0.5000", "0.3999", "warning"),
        ("0.3000", "0.2400", None),  # 0.8, but less in binary floats
        ("0.5000", "0.6000", None),  # exactly 1.2
        ("0.5000", "0.6001", "positive"),
        ("0.0000", "0.6000", None),
        ("0.5000", "0.0000", None),
    ],
)
def test_budget_limits_are_strict(make, spend_share, conv_share, severity):
    df = platform_findings(make(PLATFORM, platform("A", spend_share=spend_share, conv_share=conv_share)))
    got = [r.severity for r in df.filter("rule_no = 2").collect()]
    assert got == ([severity] if severity else [])


def test_budget_texts(make):
    df = platform_findings(
        make(PLATFORM, platform("A", spend_share="0.5702", conv_share="0.1051"), platform("B", spend_share="0.1404", conv_share="0.1792"))
    )
    rows = {r.subject: r for r in df.filter("rule_no = 2").collect()}
    assert rows["A"].title == "A receives 57% of spend but only 11% of conversions"
    assert "46.5% gap" in rows["A"].detail
    assert rows["B"].title == "B over-delivers: 18% of conversions on 14% of spend"
    assert rows["B"].change == D("1.2764")


def test_leaders_and_ties(make):
    df = platform_findings(
        make(
            PLATFORM, platform("A", ctr=None, impressions=9), platform("B", spend="50.00", impressions=77),
            platform("C", spend="60.00", impressions=77), platform("D", spend="60.00", impressions=1),
        )
    )
    # a tie goes to the higher spend, then to the name
    assert subjects(df, 1) == ["A"] and subjects(df, 5) == ["C"] and subjects(df, 6) == ["C"]
    assert df.filter("rule_no = 6").first().title == "C drives the most impressions (77)"


def test_campaign_extremes(make):
    df = campaign_findings(make(CAMPAIGN, campaign("a", "24.80"), campaign("b", "5.10"), campaign("c", None), campaign("d", "5.10", "900.00")))
    best, worst = df.orderBy("rule_no").collect()
    assert best.subject == "d" and worst.subject == "a"
    assert best.detail == "CPA of $5.10 with 20 conversions on $900.00 spend. CTR: 5.22%, Conv Rate: 3.74%."
    assert (worst.change, worst.severity) == (D("4.9"), "warning") and "4.9x higher than the best" in worst.detail


def test_campaigns_without_any_cpa_give_nothing(make):
    assert campaign_findings(make(CAMPAIGN, campaign("a", None))).count() == 0


@pytest.mark.parametrize(
    "change, severity, direction",
    [
        ("0.1499", "neutral", "increased"),
        ("0.1500", "warning", "increased"),
        ("-0.1500", "warning", "decreased"),
        ("0.0000", "neutral", "decreased"),
    ],
)
def test_trend(make, change, severity, direction):
    from datetime import date

    df = trend_findings(
        make(WEEKLY, (date(2024, 1, 1), "A", D("9.00"), D("9"), D("9")), (date(2024, 1, 8), "A", D("8.00"), D(change), None))
    )
    row = df.collect()[0]
    assert df.count() == 1 and row.severity == severity and row.change == D(change)
    assert row.title.startswith(f"A spend {direction} ")
    assert "Conversions WoW change: n/a." in row.detail


def test_one_week_gives_no_trend(make):
    from datetime import date

    assert trend_findings(make(WEEKLY, (date(2024, 1, 1), "A", D("9.00"), None, None))).count() == 0


def test_all_findings_in_order(make):
    from datetime import date

    plat = make(
        PLATFORM, platform("A", spend="10.00", spend_share="0.1000", conv_share="0.4000"),
        platform("B", spend="90.00", spend_share="0.9000", conv_share="0.6000", cpa="8.00"),
    )
    camp = make(CAMPAIGN, campaign("x"), campaign("y", "7.00"))
    weekly = make(WEEKLY, *[(date(2024, 1, 8), p, D("8.00"), D("0.2000"), D("0.1000")) for p in "BA"])
    rows = ordered_insights(executive_insights(plat, camp, weekly)).collect()
    assert [(r.rule_no, r.subject) for r in rows] == [
        (1, "A"), (2, "B"), (2, "A"), (3, "x"), (4, "y"), (5, "B"), (6, "B"), (7, "A"), (7, "B")
    ]


def test_empty_marts_give_no_findings(make):
    assert executive_insights(make(PLATFORM), make(CAMPAIGN), make(WEEKLY)).count() == 0
    assert budget_recommendations(make(PLATFORM), make(CAMPAIGN, campaign("a"), campaign("b"))).count() == 0


def kinds(plat, camp):
    return [r.kind for r in budget_recommendations(plat, camp).orderBy("rec_order").collect()]


def test_recommendations(make):
    plat = make(PLATFORM, platform("A", "14.00", cpa="7.64"), platform("B", "36.00", cpa="11.00"), platform("C", "50.00", cpa="9.00"))
    camp = make(CAMPAIGN, campaign("x", "24.80"), campaign("y", "5.10"))
    rows = budget_recommendations(plat, camp).orderBy("rec_order").collect()
    assert [(r.kind, r.subject) for r in rows] == [
        ("raise_platform", "A"), ("scale_campaign", "y"), ("optimise_campaign", "x"), ("keep_diversification", "all")
    ]
    assert rows[0].text.startswith("**Increase A budget share** (currently 14%): It has the lowest CPA ($7.64)")
    assert "shift from B could" in rows[0].text and rows[0].value == D("0.14")


def test_recommendations_depend_on_what_is_shown(make):
    two = make(PLATFORM, platform("A"), platform("B", cpa="6.00"))
    one_campaign = make(CAMPAIGN, campaign("x"))
    assert kinds(two, one_campaign) == ["raise_platform"]
    four = make(PLATFORM, *[platform(p) for p in "ABCD"])
    assert kinds(four, make(CAMPAIGN)) == ["raise_platform"]
    no_cpa = make(PLATFORM, *[platform(p, cpa=None) for p in "ABC"])
    assert kinds(no_cpa, make(CAMPAIGN, campaign("x"), campaign("y"))) == [
        "scale_campaign", "optimise_campaign", "keep_diversification"
    ]
