"""Rule-based findings and budget recommendations over the marts.

Each mart is evaluated once per call however many rules look at it: platform rules
flag the best and worst rows of the small platform mart with windows, campaign
rules reduce the campaign mart to its two extreme rows in one aggregate. All rules
compare the rounded mart columns, in DECIMAL. A tie goes to the higher spend, then
to the name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from spendweave.functions.text import fill, literal, money, percent, times, whole
from spendweave.operators.windows import latest_week
from spendweave.plans import messages

# Limits of the rules (fixed values).
UNDER_RATIO = "0.8"
OVER_RATIO = "1.2"
STEADY_CHANGE = "0.15"
DIVERSIFIED_PLATFORMS = 3

_NUMBER = "DECIMAL(24,4)"


def _struct(**fields: str) -> str:
    return "NAMED_STRUCT(" + ", ".join(f"'{name}', {value}" for name, value in fields.items()) + ")"


def _when(condition: str, entry: str) -> str:
    return f"IF({condition}, {entry}, NULL)"


def _emit(df: DataFrame, *entries: str) -> DataFrame:
    """The non-NULL structs of each row as rows."""
    return df.selectExpr(f"EXPLODE(ARRAY({', '.join(entries)})) AS e").filter("e IS NOT NULL").select("e.*")


def _finding(
    rule_no: int,
    message: tuple[str, str, str],
    severity: str,
    subject: str,
    texts: dict[str, str],
    value: str,
    benchmark: str = "NULL",
    change: str = "NULL",
) -> str:
    """One finding as a struct: rule, texts, and the numbers it rests on."""
    category, title, detail = message
    return _struct(
        rule_no=str(rule_no),
        category=literal(category),
        subject=subject,
        title=fill(title, texts),
        detail=fill(detail, texts),
        severity=severity,
        value=f"CAST({value} AS {_NUMBER})",
        benchmark=f"CAST({benchmark} AS {_NUMBER})",
        change=f"CAST({change} AS {_NUMBER})",
    )


def _with_extremes(plat: DataFrame) -> DataFrame:
    """Flag best and worst platforms. One row per platform, so one task suffices."""

    def leads(metric: str, direction: str) -> str:
        order = f"{metric} {direction} NULLS LAST, total_spend DESC NULLS LAST, platform"
        return f"ROW_NUMBER() OVER (ORDER BY {order}) = 1 AND {metric} IS NOT NULL"

    by_high_cpa = (
        "OVER (ORDER BY avg_cpa DESC NULLS LAST, total_spend DESC NULLS LAST, platform "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
    )
    return plat.selectExpr(
        "*",
        f"{leads('avg_cpa', 'ASC')} AS is_lowest_cpa",
        f"{leads('avg_ctr', 'DESC')} AS is_top_ctr",
        f"{leads('total_impressions', 'DESC')} AS is_top_reach",
        f"FIRST(avg_cpa) {by_high_cpa} AS highest_cpa",
        f"FIRST(platform) {by_high_cpa} AS highest_cpa_platform",
    )


def platform_findings(plat: DataFrame) -> DataFrame:
    """Lowest CPA, budget under- and over-delivery, best CTR, largest reach."""
    both_shares = "spend_share > 0 AND conversion_share > 0"
    share_texts = {
        "platform": "platform",
        "spend_share": percent("spend_share", 0),
        "conversion_share": percent("conversion_share", 0),
        "gap": percent("(spend_share - conversion_share)", 1),
    }
    share_numbers = (
        "conversion_share",
        "spend_share",
        "ROUND(CAST(conversion_share AS DECIMAL(20,4)) / NULLIF(spend_share, 0), 4)",
    )
    return _emit(
        _with_extremes(plat),
        _when(
            "is_lowest_cpa",
            _finding(
                1, messages.LOWEST_CPA, "'positive'", "platform",
                {
                    "platform": "platform",
                    "cpa": money("avg_cpa"),
                    "gap": money("(highest_cpa - avg_cpa)"),
                    "other": "highest_cpa_platform",
                    "other_cpa": money("highest_cpa"),
                },
                "avg_cpa", "highest_cpa", "highest_cpa - avg_cpa",
            ),
        ),
        _when(
            f"{both_shares} AND conversion_share < spend_share * {UNDER_RATIO}",
            _finding(2, messages.UNDER_DELIVERY, "'warning'", "platform", share_texts, *share_numbers),
        ),
        _when(
            f"{both_shares} AND conversion_share > spend_share * {OVER_RATIO}",
            _finding(2, messages.OVER_DELIVERY, "'positive'", "platform", share_texts, *share_numbers),
        ),
        _when(
            "is_top_ctr",
            _finding(
                5, messages.HIGHEST_CTR, "'positive'", "platform",
                {
                    "platform": "platform",
                    "ctr": percent("avg_ctr", 2),
                    "cpc": money("avg_cpc"),
                    "conversion_rate": percent("avg_conversion_rate", 2),
                },
                "avg_ctr",
            ),
        ),
        _when(
            "is_top_reach",
            _finding(
                6, messages.MOST_IMPRESSIONS, "'neutral'", "platform",
                {
                    "platform": "platform",
                    "impressions": whole("total_impressions"),
                    "cpm": money("avg_cpm"),
                },
                "total_impressions",
            ),
        ),
    )


def _campaign_extremes(camp: DataFrame) -> DataFrame:
    """One row: the campaigns with the lowest and the highest CPA, and how many there are."""
    row = (
        "STRUCT(platform, campaign_name, avg_cpa, total_conversions, total_spend, avg_ctr, avg_conversion_rate)"
    )

    def first_by(cpa: str) -> str:
        # a NULL key is ignored, so a campaign without conversions is neither
        key = f"IF(avg_cpa IS NOT NULL, STRUCT({cpa}, -total_spend, platform, campaign_name), NULL)"
        return f"MIN_BY({row}, {key})"

    # an aggregate without keys gives a row even for no campaign
    return camp.selectExpr(
        f"{first_by('avg_cpa')} AS best", f"{first_by('-avg_cpa')} AS worst", "COUNT(*) AS campaigns"
    ).filter("best IS NOT NULL")


def _campaign_texts(side: str) -> dict[str, str]:
    return {
        "campaign": f"{side}.campaign_name",
        "platform": f"{side}.platform",
        "cpa": money(f"{side}.avg_cpa"),
        "spend": money(f"{side}.total_spend"),
        "conversions": whole(f"{side}.total_conversions"),
        "ctr": percent(f"{side}.avg_ctr", 2),
        "conversion_rate": percent(f"{side}.avg_conversion_rate", 2),
    }


def campaign_findings(camp: DataFrame) -> DataFrame:
    """Best and worst campaign by CPA, and how many times the best the worst is."""
    multiple = "ROUND(CAST(worst.avg_cpa AS DECIMAL(20,2)) / NULLIF(best.avg_cpa, 0), 1)"
    return _emit(
        _campaign_extremes(camp),
        _finding(
            3, messages.BEST_CAMPAIGN, "'positive'", "best.campaign_name", _campaign_texts("best"), "best.avg_cpa"
        ),
        _finding(
            4, messages.WORST_CAMPAIGN, "'warning'", "worst.campaign_name",
            {**_campaign_texts("worst"), "multiple": times(multiple)},
            "worst.avg_cpa", "best.avg_cpa", multiple,
        ),
    )


def trend_findings(weekly: DataFrame) -> DataFrame:
    """Spend change of the latest week per platform; 0 counts as decreased."""
    return _emit(
        latest_week(weekly).filter("spend_wow_change IS NOT NULL"),
        _finding(
            7, messages.WEEKLY_TREND,
            f"IF(ABS(spend_wow_change) < {STEADY_CHANGE}, 'neutral', 'warning')",
            "platform",
            {
                "platform": "platform",
                "direction": "IF(spend_wow_change > 0, 'increased', 'decreased')",
                "change": percent("ABS(spend_wow_change)", 1),
                "spend": money("spend"),
                "conversions_change": percent("conversions_wow_change", 1),
            },
            "spend", "NULL", "spend_wow_change",
        ),
    )


def executive_insights(plat: DataFrame, camp: DataFrame, weekly: DataFrame) -> DataFrame:
    """All findings; no rows for an empty mart. ``ordered_insights`` sorts them for output."""
    return platform_findings(plat).unionByName(campaign_findings(camp)).unionByName(trend_findings(weekly))


def ordered_insights(findings: DataFrame) -> DataFrame:
    """Rule by rule; budget findings by spend share, trends by platform name."""
    by_spend = findings.selectExpr("*", "IF(rule_no = 2, -benchmark, NULL) AS _by_spend")
    return by_spend.orderBy("rule_no", "_by_spend", "subject").drop("_by_spend")


def _recommendation(order: int, kind: str, subject: str, text: str, value: str) -> str:
    return _struct(
        rec_order=str(order), kind=literal(kind), subject=subject, text=text, value=f"CAST({value} AS {_NUMBER})"
    )


def platform_recommendations(plat: DataFrame) -> DataFrame:
    """Raise the platform with the lowest CPA; keep three platforms if there are three."""
    shown = _with_extremes(plat).selectExpr(
        "*",
        "COALESCE(ROUND(CAST(total_spend AS DECIMAL(20,2)) / NULLIF(SUM(total_spend) OVER (), 0), 4), 0) AS share",
        "COUNT(*) OVER () AS platforms",
        "ROW_NUMBER() OVER (ORDER BY total_spend DESC NULLS LAST, platform) AS position",
    )
    return _emit(
        shown,
        _when(
            "is_lowest_cpa",
            _recommendation(
                1, "raise_platform", "platform",
                fill(
                    messages.RAISE_PLATFORM,
                    {
                        "platform": "platform",
                        "share": percent("share", 0),
                        "cpa": money("avg_cpa"),
                        "other": "highest_cpa_platform",
                    },
                ),
                "share",
            ),
        ),
        _when(
            f"platforms = {DIVERSIFIED_PLATFORMS} AND position = 1",
            _recommendation(
                4, "keep_diversification", "'all'", literal(messages.KEEP_DIVERSIFICATION), "platforms"
            ),
        ),
    )


def campaign_recommendations(camp: DataFrame) -> DataFrame:
    """Scale the best and review the worst campaign, if there is more than one."""
    return _emit(
        _campaign_extremes(camp).filter("campaigns > 1"),
        _recommendation(
            2, "scale_campaign", "best.campaign_name",
            fill(messages.SCALE_CAMPAIGN, _campaign_texts("best")), "best.avg_cpa",
        ),
        _recommendation(
            3, "optimise_campaign", "worst.campaign_name",
            fill(messages.OPTIMISE_CAMPAIGN, _campaign_texts("worst")), "worst.avg_cpa",
        ),
    )


def budget_recommendations(plat: DataFrame, camp: DataFrame) -> DataFrame:
    """All recommendations; none without platforms. Sort by rec_order for output."""
    on_campaigns = campaign_recommendations(camp).filter(plat.select("platform").limit(1).exists())
    return platform_recommendations(plat).unionByName(on_campaigns)
