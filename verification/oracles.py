"""The same results as ANSI SQL on the same tables.

Quotients are rounded half-up in integer arithmetic, because a quotient that went
through DOUBLE would miss ties.
"""

from __future__ import annotations

import re

from spendweave.plans import messages

MEASURES = ("impressions", "clicks", "spend", "conversions")

LANDING = """
landing AS (
    SELECT l_returnflag AS flag,
           CAST(l_shipdate AS DATE) AS date,
           p_brand AS campaign_id,
           'C_' || p_brand AS campaign_name,
           p_brand || '/' || p_type AS ad_group_id,
           p_type AS ad_group_name,
           (CAST(l_quantity AS BIGINT) - 1) * 100 AS impressions,
           GREATEST(CAST(l_quantity AS BIGINT) - l_linenumber, 0) AS clicks,
           CAST(l_extendedprice AS DECIMAL(12,2)) AS spend,
           CAST(CASE l_returnflag WHEN 'A' THEN l_linenumber + 1
                                  WHEN 'N' THEN l_linenumber - 1
                                  ELSE GREATEST(l_linenumber - 3, 0) END AS BIGINT) AS conversions,
           CAST(l_quantity AS BIGINT) AS quantity,
           CAST(l_linenumber AS BIGINT) AS line,
           CAST(l_tax AS DECIMAL(10,4)) AS engagement_rate,
           CAST(l_discount + 1 AS DECIMAL(10,2)) AS frequency,
           CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(12,2))
               AS conversion_value,
           CAST(l_discount AS DECIMAL(10,2)) AS search_impression_share
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
    WHERE l_returnflag IN ('A', 'N', 'R')
)"""

COMMON = (
    "date, campaign_id, campaign_name, ad_group_id, ad_group_name, impressions, clicks, spend, conversions"
)
FACEBOOK_OWN = "quantity * 50 AS video_views, engagement_rate, quantity * 80 AS reach, frequency"
GOOGLE_OWN = "conversion_value, NULLIF(line + 1, 8) AS quality_score, search_impression_share"
TIKTOK_OWN = (
    "quantity * 40 AS video_watch_25, quantity * 30 AS video_watch_50, quantity * 20 AS video_watch_75, "
    "quantity * 10 AS video_watch_100, line * 7 AS likes, line * 2 AS shares, line AS comments"
)
NO_GOOGLE = "NULL AS conversion_value, NULL AS quality_score, NULL AS search_impression_share"
NO_TIKTOK = (
    "NULL AS video_watch_25, NULL AS video_watch_50, NULL AS video_watch_75, NULL AS video_watch_100, "
    "NULL AS likes, NULL AS shares, NULL AS comments"
)

UNIFIED = f"""
facts AS (
    SELECT 'Facebook' AS platform, {COMMON}, {FACEBOOK_OWN}, {NO_GOOGLE}, {NO_TIKTOK}
    FROM landing WHERE flag = 'A'
    UNION ALL
    SELECT 'Google', {COMMON}, NULL, NULL, NULL, NULL, {GOOGLE_OWN}, {NO_TIKTOK}
    FROM landing WHERE flag = 'N'
    UNION ALL
    SELECT 'TikTok', {COMMON}, quantity * 50, NULL, NULL, NULL, {NO_GOOGLE}, {TIKTOK_OWN}
    FROM landing WHERE flag = 'R'
)"""


def half_up(num: str, den: str, places: int, num_scale: int = 1) -> str:
    """``num / den`` rounded to ``places`` as DOUBLE; ``num_scale`` makes an amount whole cents."""
    n = f"CAST(({num}) * {num_scale} AS HUGEINT)" if num_scale != 1 else f"CAST({num} AS HUGEINT)"
    d = f"CAST(({den}) * {num_scale} AS HUGEINT)" if num_scale != 1 else f"CAST({den} AS HUGEINT)"
    units = f"(2 * ABS({n}) * {10**places} + ABS({d})) // NULLIF(2 * ABS({d}), 0)"
    return f"CAST(SIGN({n}) * ({units}) AS DOUBLE) / {10**places}"


def kpis(impressions: str, clicks: str, spend: str, conversions: str, prefix: str, names=None) -> str:
    parts = {
        "ctr": half_up(clicks, impressions, 4),
        "cpc": half_up(spend, clicks, 2, 100),
        "cpa": half_up(spend, conversions, 2, 100),
        "conversion_rate": half_up(conversions, clicks, 4),
        "cpm": half_up(f"{spend} * 1000", impressions, 2, 100),
    }
    return ", ".join(f"{v} AS {prefix}{k}" for k, v in parts.items() if names is None or k in names)


def big(expr: str, name: str) -> str:
    return f"CAST({expr} AS BIGINT) AS {name}"


def dbl(expr: str, name: str) -> str:
    return f"CAST({expr} AS DOUBLE) AS {name}"


def totals(prefix: str = "total_") -> str:
    return ", ".join(
        (dbl if m == "spend" else big)(f"SUM({m})", f"{prefix}{m}") for m in MEASURES
    )


SUMS = tuple(f"SUM({m})" for m in MEASURES)

OWN_PLAIN = ", ".join(
    (dbl if c in ("engagement_rate", "frequency", "conversion_value", "search_impression_share") else big)(c, c)
    for c in (
        "video_views engagement_rate reach frequency conversion_value quality_score search_impression_share "
        "video_watch_25 video_watch_50 video_watch_75 video_watch_100 likes shares comments"
    ).split()
)
COMMON_PLAIN = (
    "platform, date, campaign_id, campaign_name, ad_group_id, ad_group_name, "
    f"{big('impressions', 'impressions')}, {big('clicks', 'clicks')}, {dbl('spend', 'spend')}, "
    f"{big('conversions', 'conversions')}"
)
ROW_KPIS = kpis(*MEASURES, "")

DAILY = f"""
daily AS (
    SELECT date, platform, {big('COUNT(*)', 'ad_groups_active')}, {totals()},
           {kpis(*SUMS, 'avg_')}, {big('SUM(video_views)', 'total_video_views')}
    FROM facts GROUP BY date, platform
)"""

CAMPAIGNS = f"""
campaigns AS (
    SELECT platform, campaign_id, campaign_name,
           MIN(date) AS first_active_date, MAX(date) AS last_active_date,
           COUNT(DISTINCT date) AS active_days, COUNT(DISTINCT ad_group_id) AS ad_groups,
           {totals()}, {kpis(*SUMS, 'avg_')},
           {big('SUM(video_views)', 'total_video_views')},
           {dbl('SUM(conversion_value)', 'total_conversion_value')},
           {half_up('SUM(conversion_value)', 'SUM(spend)', 2, 100)} AS roas,
           {big('SUM(likes)', 'total_likes')}, {big('SUM(shares)', 'total_shares')},
           {big('SUM(comments)', 'total_comments')},
           RANK() OVER (ORDER BY SUM(spend) DESC NULLS LAST) AS spend_rank,
           RANK() OVER (ORDER BY SUM(conversions) DESC NULLS LAST) AS conversions_rank,
           RANK() OVER (ORDER BY CAST(SUM(spend) AS DOUBLE) / NULLIF(SUM(conversions), 0) ASC NULLS LAST)
               AS cpa_rank
    FROM facts GROUP BY platform, campaign_id, campaign_name
)"""
RANKS = "spend_rank, conversions_rank, cpa_rank"

PLATFORMS = f"""
platforms AS (
    SELECT platform, COUNT(DISTINCT campaign_id) AS campaigns, COUNT(DISTINCT ad_group_id) AS ad_groups,
           COUNT(DISTINCT date) AS active_days, {totals()}, {kpis(*SUMS, 'avg_')},
           {half_up('SUM(spend)', 'SUM(SUM(spend)) OVER ()', 4, 100)} AS spend_share,
           {half_up('SUM(conversions)', 'SUM(SUM(conversions)) OVER ()', 4)} AS conversion_share
    FROM facts GROUP BY platform
)"""


def _change(measure: str, scale: int) -> str:
    return half_up(f"{measure} - previous_{measure}", f"previous_{measure}", 4, scale)


WEEKLY = f"""
weeks AS (
    SELECT CAST(date_trunc('week', date) AS DATE) AS week_start, platform,
           {', '.join(f'SUM({m}) AS {m}' for m in MEASURES)}
    FROM facts GROUP BY 1, 2
),
lagged AS (
    SELECT *, LAG(spend) OVER (PARTITION BY platform ORDER BY week_start) AS previous_spend,
           LAG(conversions) OVER (PARTITION BY platform ORDER BY week_start) AS previous_conversions
    FROM weeks
),
weekly AS (
    SELECT week_start, platform, {big('impressions', 'impressions')}, {big('clicks', 'clicks')},
           {dbl('spend', 'spend')}, {big('conversions', 'conversions')},
           {kpis(*MEASURES, '', ('ctr', 'cpc', 'cpa'))},
           {_change('spend', 100)} AS spend_wow_change,
           {_change('conversions', 1)} AS conversions_wow_change
    FROM lagged
)"""

STEPS = ("25", "50", "75", "100")
FUNNEL = f"""
funnel AS (
    SELECT campaign_name, {big('SUM(video_views)', 'total_views')},
           {', '.join(big(f'SUM(video_watch_{s})', f'watched_{s}pct') for s in STEPS)},
           {', '.join(f"{half_up(f'SUM(video_watch_{s})', 'SUM(video_views)', 4)} AS rate_{s}pct" for s in STEPS)}
    FROM facts WHERE platform = 'TikTok' GROUP BY campaign_name
)"""
FUNNEL_SUM = ", ".join(
    big(f"SUM({c})", c) for c in ("total_views", *[f"watched_{s}pct" for s in STEPS])
)

QUALITY = f"""
quality AS (
    SELECT campaign_name, ad_group_name,
           {half_up('SUM(quality_score)', 'COUNT(quality_score)', 1)} AS avg_quality_score,
           {big('SUM(impressions)', 'total_impressions')}, {big('SUM(clicks)', 'total_clicks')},
           {dbl('SUM(spend)', 'total_cost')}, {big('SUM(conversions)', 'total_conversions')},
           {dbl('SUM(conversion_value)', 'total_conversion_value')},
           {kpis(*SUMS, 'avg_', ('ctr', 'cpc', 'cpa'))},
           {half_up('SUM(conversion_value)', 'SUM(spend)', 2, 100)} AS roas,
           {half_up('SUM(search_impression_share)', 'COUNT(search_impression_share)', 2, 100)}
               AS avg_search_impression_share
    FROM facts WHERE platform = 'Google' GROUP BY campaign_name, ad_group_name
)"""

CHOSEN_DATES = "date BETWEEN DATE '1996-03-01' AND DATE '2000-02-29'"
CHOSEN_PLATFORMS = "platform IN ('Facebook', 'Google')"
CHOSEN_CAMPAIGNS = "campaign_name IN ('C_Brand#2', 'C_Brand#7', 'C_Brand#11', 'C_Brand#17', 'C_Brand#23')"
CHOSEN = f"{CHOSEN_DATES} AND {CHOSEN_PLATFORMS} AND {CHOSEN_CAMPAIGNS}"


def with_(select: str, *ctes: str) -> str:
    return "WITH " + ",".join((LANDING, UNIFIED, *ctes)) + "\n" + select


def kpi_totals(where: str = "") -> str:
    imp, clk, spd, cnv = [f"COALESCE(SUM({m}), 0)" for m in MEASURES]

    def card(num: str, den: str, name: str) -> str:
        return f"COALESCE(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0), 0) AS {name}"

    return with_(
        f"SELECT {big(imp, 'total_impressions')}, {big(clk, 'total_clicks')}, {dbl(spd, 'total_spend')}, "
        f"{big(cnv, 'total_conversions')}, {card(spd, cnv, 'avg_cpa')}, {card(clk, imp, 'avg_ctr')}, "
        f"{card(spd, clk, 'avg_cpc')}, {card(cnv, clk, 'avg_conversion_rate')} FROM facts {where}"
    )


def conformed(platform: str) -> str:
    return with_(f"SELECT {COMMON_PLAIN}, {OWN_PLAIN} FROM facts WHERE platform = '{platform}'")


UNIFIED_ROWS = with_(f"SELECT {COMMON_PLAIN}, {ROW_KPIS}, {OWN_PLAIN} FROM facts")


def unified_rows(where: str) -> str:
    return with_(f"SELECT {COMMON_PLAIN}, {ROW_KPIS}, {OWN_PLAIN} FROM facts WHERE {where}")


def _loaded(platform: str, ids: tuple[str, str], spend: str, own: str) -> str:
    return with_(
        f"SELECT date, campaign_id, campaign_name, ad_group_id AS {ids[0]}, ad_group_name AS {ids[1]}, "
        f"{big('impressions', 'impressions')}, {big('clicks', 'clicks')}, {dbl('spend', spend)}, "
        f"{big('conversions', 'conversions')}, {own} FROM facts WHERE platform = '{platform}'"
    )


def money(x: str) -> str:
    return f"'$' || format('{{:,.2f}}', CAST({x} AS DOUBLE))"


def whole(x: str) -> str:
    return f"format('{{:,}}', CAST({x} AS BIGINT))"


def percent(x: str, places: int) -> str:
    """Of a fraction in ten-thousandths, rounded half-up in whole numbers."""
    unit = 10 ** (2 - places)
    units = f"((ABS(CAST(ROUND(({x}) * 10000) AS BIGINT)) + {unit // 2}) // {unit})"
    sign = f"CASE WHEN {x} < 0 AND {units} > 0 THEN '-' ELSE '' END"
    digits = f"CAST({units} // {10**places} AS VARCHAR)"
    if places:
        digits += f" || '.' || lpad(CAST({units} % {10**places} AS VARCHAR), {places}, '0')"
    return f"{sign} || {digits} || '%'"


def worded(template: str, fields: dict[str, str]) -> str:
    """A sentence with its gaps filled."""
    parts = re.split(r"\{(\w+)\}", template)
    shown = ["'" + t.replace("'", "''") + "'" if i % 2 == 0 else f"COALESCE({fields[t]}, 'n/a')" for i, t in enumerate(parts)]
    return " || ".join(shown)


def _gaps(platform: str, campaign: str = "") -> dict[str, str]:
    """Text of the columns of a platform or campaign row."""
    row = f"{campaign or platform}."
    return {
        "platform": f"{row}platform", "campaign": f"{row}campaign_name", "cpa": money(f"{row}avg_cpa"),
        "spend": money(f"{row}total_spend"), "conversions": whole(f"{row}total_conversions"),
        "ctr": percent(f"{row}avg_ctr", 2), "conversion_rate": percent(f"{row}avg_conversion_rate", 2),
        "cpc": money(f"{row}avg_cpc"), "cpm": money(f"{row}avg_cpm"), "impressions": whole(f"{row}total_impressions"),
    }


def texts_of(rule: int) -> dict[str, tuple[tuple[str, str, str], dict[str, str]]]:
    share = {
        "platform": "platform", "spend_share": percent("spend_share", 0), "conversion_share": percent("conversion_share", 0),
        "gap": percent("(spend_share - conversion_share)", 1),
    }
    times = half_up(_tenths("w.avg_cpa", 100), _tenths("b.avg_cpa", 100), 1)
    return {
        1: {"": (messages.LOWEST_CPA, _gaps("b") | {
            "gap": money("(w.avg_cpa - b.avg_cpa)"), "other": "w.platform", "other_cpa": money("w.avg_cpa")})},
        2: {f"{SHARE_UNITS[0]} * 10 < {SHARE_UNITS[1]} * 8": (messages.UNDER_DELIVERY, share), "": (messages.OVER_DELIVERY, share)},
        3: {"": (messages.BEST_CAMPAIGN, _gaps("", "b"))},
        4: {"": (messages.WORST_CAMPAIGN, _gaps("", "w") | {"multiple": f"format('{{:.1f}}x', {times})"})},
        5: {"": (messages.HIGHEST_CTR, _gaps("p"))},
        6: {"": (messages.MOST_IMPRESSIONS, _gaps("p"))},
        7: {"": (messages.WEEKLY_TREND, {
            "platform": "platform", "direction": "CASE WHEN spend_wow_change > 0 THEN 'increased' ELSE 'decreased' END",
            "change": percent("ABS(spend_wow_change)", 1), "spend": money("spend"),
            "conversions_change": percent("conversions_wow_change", 1)})},
    }[rule]


def _cases(rule: int, which: int) -> str:
    texts = {condition: worded(message[which], gaps) for condition, (message, gaps) in texts_of(rule).items()}
    last = texts.pop("")
    return "CASE " + " ".join(f"WHEN {c} THEN {t}" for c, t in texts.items()) + f" ELSE {last} END" if texts else last


def finding(rule: int, category: str, subject: str, severity: str, value: str, benchmark: str, change: str) -> str:
    return (
        f"SELECT CAST({rule} AS BIGINT) AS rule_no, '{category}' AS category, {subject} AS subject, "
        f"{_cases(rule, 1)} AS title, {_cases(rule, 2)} AS detail, "
        f"{severity} AS severity, CAST({value} AS DOUBLE) AS value, CAST({benchmark} AS DOUBLE) AS benchmark, "
        f"CAST({change} AS DOUBLE) AS change"
    )


def _first(table: str, order: str) -> str:
    return f"(SELECT * FROM {table} WHERE {order.split()[0]} IS NOT NULL ORDER BY {order} LIMIT 1)"


BEST_PLATFORM = _first("platforms", "avg_cpa ASC, total_spend DESC, platform")
WORST_PLATFORM = _first("platforms", "avg_cpa DESC, total_spend DESC, platform")
BEST_CAMPAIGN = _first("campaigns", "avg_cpa ASC, total_spend DESC, platform, campaign_name")
WORST_CAMPAIGN = _first("campaigns", "avg_cpa DESC, total_spend DESC, platform, campaign_name")


def _tenths(x: str, scale: int) -> str:
    return f"CAST(ROUND(({x}) * {scale}) AS BIGINT)"


SHARE_UNITS = (_tenths("conversion_share", 10000), _tenths("spend_share", 10000))
FINDINGS = {
    1: finding(1, "Efficiency", "b.platform", "'positive'", "b.avg_cpa", "w.avg_cpa",
               f"CAST({_tenths('w.avg_cpa', 100)} - {_tenths('b.avg_cpa', 100)} AS DOUBLE) / 100")
    + f" FROM {BEST_PLATFORM} b, {WORST_PLATFORM} w",
    2: finding(2, "Budget", "platform",
               f"CASE WHEN {SHARE_UNITS[0]} * 10 < {SHARE_UNITS[1]} * 8 THEN 'warning' ELSE 'positive' END",
               "conversion_share", "spend_share", half_up(*SHARE_UNITS, 4))
    + f" FROM platforms WHERE spend_share > 0 AND conversion_share > 0 AND ({SHARE_UNITS[0]} * 10 < "
    f"{SHARE_UNITS[1]} * 8 OR {SHARE_UNITS[0]} * 10 > {SHARE_UNITS[1]} * 12)",
    3: finding(3, "Campaign", "b.campaign_name", "'positive'", "b.avg_cpa", "NULL", "NULL")
    + f" FROM {BEST_CAMPAIGN} b",
    4: finding(4, "Campaign", "w.campaign_name", "'warning'", "w.avg_cpa", "b.avg_cpa",
               half_up(_tenths("w.avg_cpa", 100), _tenths("b.avg_cpa", 100), 1))
    + f" FROM {BEST_CAMPAIGN} b, {WORST_CAMPAIGN} w",
    5: finding(5, "Engagement", "platform", "'positive'", "avg_ctr", "NULL", "NULL")
    + f" FROM {_first('platforms', 'avg_ctr DESC, total_spend DESC, platform')} p",
    6: finding(6, "Reach", "platform", "'neutral'", "total_impressions", "NULL", "NULL")
    + f" FROM {_first('platforms', 'total_impressions DESC, total_spend DESC, platform')} p",
    7: finding(7, "Trend", "platform",
               "CASE WHEN ABS(spend_wow_change) < 0.15 THEN 'neutral' ELSE 'warning' END",
               "spend", "NULL", "spend_wow_change")
    + " FROM weekly WHERE week_start = (SELECT MAX(week_start) FROM weekly) AND spend_wow_change IS NOT NULL",
}


def _union(rules) -> str:
    return "\nUNION ALL\n".join(f"SELECT * FROM ({FINDINGS[r]}) r{r}" for r in rules)


def findings(*rules: int) -> str:
    return with_(_union(rules), CAMPAIGNS, PLATFORMS, WEEKLY)


def _recommendation(order: int, kind: str, subject: str, text: str, value: str, source: str) -> str:
    return (
        f"SELECT CAST({order} AS BIGINT) AS rec_order, '{kind}' AS kind, {subject} AS subject, {text} AS text, "
        f"CAST({value} AS DOUBLE) AS value FROM {source}"
    )


SHARE_OF_ALL = half_up("b.total_spend", "(SELECT SUM(total_spend) FROM platforms)", 4, 100)
RECOMMENDATIONS = "\nUNION ALL\n".join(
    [
        _recommendation(
            1, "raise_platform", "b.platform",
            worded(messages.RAISE_PLATFORM, _gaps("b") | {"share": percent(SHARE_OF_ALL, 0), "other": "w.platform"}),
            SHARE_OF_ALL, f"{BEST_PLATFORM} b, {WORST_PLATFORM} w",
        ),
        _recommendation(
            2, "scale_campaign", "campaign_name", worded(messages.SCALE_CAMPAIGN, _gaps("", "c")), "avg_cpa",
            f"{BEST_CAMPAIGN} c WHERE (SELECT COUNT(*) FROM campaigns) > 1",
        ),
        _recommendation(
            3, "optimise_campaign", "campaign_name", worded(messages.OPTIMISE_CAMPAIGN, _gaps("", "c")), "avg_cpa",
            f"{WORST_CAMPAIGN} c WHERE (SELECT COUNT(*) FROM campaigns) > 1",
        ),
        _recommendation(
            4, "keep_diversification", "'all'", worded(messages.KEEP_DIVERSIFICATION, {}), "COUNT(*)",
            "platforms HAVING COUNT(*) = 3",
        ),
    ]
)


def selected(query: str) -> str:
    """On marts that the chosen selection filters: each keeps its name, so the query stays as it is."""
    narrowed = {
        "campaigns": f"SELECT * FROM all_campaigns WHERE {CHOSEN_PLATFORMS} AND {CHOSEN_CAMPAIGNS}",
        "platforms": f"SELECT * FROM all_platforms WHERE {CHOSEN_PLATFORMS}",
        "weekly": f"SELECT * FROM all_weekly WHERE {CHOSEN_PLATFORMS}",
    }
    whole_marts = with_("SELECT 1", CAMPAIGNS, PLATFORMS, WEEKLY)
    for name in narrowed:
        whole_marts = re.sub(rf"\b{name} AS \(", f"all_{name} AS (", whole_marts)
    head = whole_marts[: whole_marts.rindex("SELECT 1")].rstrip()
    return head + ", " + ", ".join(f"{n} AS ({q})" for n, q in narrowed.items()) + f"\n{query}"


def ordered(source: str, order: str, *marts: str) -> str:
    """Keys of a mart with their place in its output order."""
    keys = ", ".join(part.split()[0] for part in order.split(", "))
    return with_(f"SELECT {keys}, ROW_NUMBER() OVER (ORDER BY {order}) AS position FROM {source}", *marts)


RADAR_VALUES = {
    "CTR": "COALESCE(avg_ctr, 0)",
    "Conv Rate": "COALESCE(avg_conversion_rate, 0)",
    "Cost Eff (1/CPA)": "CASE WHEN avg_cpa > 0 THEN 1.0::DOUBLE / avg_cpa ELSE 0 END",
    "Click Eff (1/CPC)": "CASE WHEN avg_cpc > 0 THEN 1.0::DOUBLE / avg_cpc ELSE 0 END",
}
RADAR = "\nUNION ALL\n".join(
    f"SELECT platform, '{axis}' AS axis, CASE WHEN MAX({v}) OVER () > 0 THEN {v} / MAX({v}) OVER () "
    f"ELSE {v} END AS value FROM platforms"
    for axis, v in RADAR_VALUES.items()
)

STAGES = {
    "Views": "total_views",
    **{f"{s}% Watched": f"watched_{s}pct" for s in STEPS},
}
FUNNEL_STAGES = "\nUNION ALL\n".join(
    f"SELECT CAST({no} AS BIGINT) AS stage_no, '{label}' AS stage, {big(f'SUM({c})', 'count')}, "
    f"CAST(SUM({c}) AS DOUBLE) / NULLIF(CAST(SUM(total_views) AS DOUBLE), 0) * 100 AS pct FROM funnel"
    for no, (label, c) in enumerate(STAGES.items(), start=1)
)

PLATFORM_TABLE = (
    'platform AS "Platform", campaigns AS "Campaigns", total_impressions AS "Impressions", '
    'total_clicks AS "Clicks", total_spend AS "Spend ($)", total_conversions AS "Conversions", '
    'avg_ctr AS "CTR", avg_cpc AS "CPC ($)", avg_cpa AS "CPA ($)", avg_conversion_rate AS "Conv Rate", '
    'avg_cpm AS "CPM ($)", spend_share AS "Spend Share", conversion_share AS "Conv Share"'
)
CAMPAIGN_TABLE = (
    'platform AS "Platform", campaign_name AS "Campaign", total_spend AS "Spend ($)", '
    'total_impressions AS "Impressions", total_clicks AS "Clicks", total_conversions AS "Conversions", '
    'avg_ctr AS "CTR", avg_cpc AS "CPC ($)", avg_cpa AS "CPA ($)", avg_conversion_rate AS "Conv Rate", '
    'spend_rank AS "Spend Rank", cpa_rank AS "CPA Rank"'
)


def shown(table: str) -> str:
    """The columns of a table as the dashboard prints them."""
    out = []
    for part in table.split(", "):
        column, name = part.split(" AS ")
        if "($)" in name:
            column = money(column)
        elif column.endswith("_share"):
            column = percent(column, 1)
        elif column in ("avg_ctr", "avg_conversion_rate"):
            column = percent(column, 2)
        elif column not in ("platform", "campaign_name", "campaigns"):
            column = whole(column)
        out.append(f"{column} AS {name}")
    return ", ".join(out)


def counted(tables: dict[str, str], name: str = "table_name") -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{label}' AS {name}, COUNT(*) AS row_count FROM {source}" for label, source in tables.items()
    )


FEED_FILTERS = {p: f"facts WHERE platform = '{p}'" for p in ("Facebook", "Google", "TikTok")}
TOTALS_ONLY = f"SELECT * EXCLUDE ({RANKS}) FROM campaigns"

FACEBOOK_LOADED = _loaded(
        "Facebook", ("ad_set_id", "ad_set_name"), "spend",
        f"{big('video_views', 'video_views')}, {dbl('engagement_rate', 'engagement_rate')}, "
        f"{big('reach', 'reach')}, {dbl('frequency', 'frequency')}",
    )

PUBLISHED_COUNTS = with_(
    counted(
        {
            "unified_ads": "facts",
            "daily_platform_summary": "daily",
            "campaign_performance": "campaigns",
            "platform_summary": "platforms",
            "weekly_trends": "weekly",
            "tiktok_video_funnel": "funnel",
            "google_quality_analysis": "quality",
        }
    ),
    DAILY, CAMPAIGNS, PLATFORMS, WEEKLY, FUNNEL, QUALITY,
)

ORACLES: dict[str, str] = {
    "load_raw_facebook": FACEBOOK_LOADED,
    "load_raw_google": _loaded(
        "Google", ("ad_group_id", "ad_group_name"), "cost",
        f"{dbl('conversion_value', 'conversion_value')}, {dbl('0', 'ctr')}, {dbl('0', 'avg_cpc')}, "
        f"{big('quality_score', 'quality_score')}, {dbl('search_impression_share', 'search_impression_share')}",
    ),
    "load_raw_tiktok": _loaded(
        "TikTok", ("adgroup_id", "adgroup_name"), "cost",
        ", ".join(
            big(c, c)
            for c in (
                "video_views video_watch_25 video_watch_50 video_watch_75 video_watch_100 likes shares comments"
            ).split()
        ),
    ),
    "unify_conform_facebook": conformed("Facebook"),
    "unify_conform_google": conformed("Google"),
    "unify_conform_tiktok": conformed("TikTok"),
    "unified_ads": UNIFIED_ROWS,
    "unified_row_kpis": UNIFIED_ROWS,
    "published_row_counts": PUBLISHED_COUNTS,
    "stored_row_counts": PUBLISHED_COUNTS,
    "raw_row_counts": with_(
        counted(
            {
                "FACEBOOK_ADS": FEED_FILTERS["Facebook"],
                "GOOGLE_ADS": FEED_FILTERS["Google"],
                "TIKTOK_ADS": FEED_FILTERS["TikTok"],
            }
        )
    ),
    "view_row_counts": with_(
        counted(
            {
                "UNIFIED_ADS": "facts",
                "DAILY_PLATFORM_SUMMARY": "daily",
                "CAMPAIGN_PERFORMANCE": "campaigns",
                "PLATFORM_SUMMARY": "platforms",
            },
            "view_name",
        ),
        DAILY, CAMPAIGNS, PLATFORMS,
    ),
    "daily_platform_summary": with_("SELECT * FROM daily", DAILY),
    "campaign_totals": with_(TOTALS_ONLY, CAMPAIGNS),
    "campaign_performance": with_("SELECT * FROM campaigns", CAMPAIGNS),
    "campaign_ranks_counted": with_(
        f"SELECT platform, campaign_id, campaign_name, {RANKS} FROM campaigns", CAMPAIGNS
    ),
    "platform_summary": with_("SELECT * FROM platforms", PLATFORMS),
    "weekly_rollup": with_(
        "SELECT week_start, platform, impressions, clicks, spend, conversions FROM weekly", WEEKLY
    ),
    "weekly_trends": with_("SELECT * FROM weekly", WEEKLY),
    "video_funnel": with_("SELECT * FROM funnel", FUNNEL),
    "quality_analysis": with_("SELECT * FROM quality", QUALITY),
    "kpi_totals": kpi_totals(),
    "platform_totals": with_(
        f"SELECT platform, {dbl('SUM(spend)', 'total_spend')}, {big('SUM(conversions)', 'total_conversions')} "
        "FROM facts GROUP BY platform"
    ),
    "funnel_totals": with_(f"SELECT {FUNNEL_SUM} FROM funnel", FUNNEL),
    "latest_week": with_(
        "SELECT * FROM weekly WHERE week_start = (SELECT MAX(week_start) FROM weekly)", WEEKLY
    ),
    "best_worst_campaign": with_(
        f"SELECT platform, campaign_name, avg_cpa, total_spend, 'best' AS pick FROM {BEST_CAMPAIGN} b UNION ALL "
        f"SELECT platform, campaign_name, avg_cpa, total_spend, 'worst' AS pick FROM {WORST_CAMPAIGN} w",
        CAMPAIGNS,
    ),
    "date_bounds": with_("SELECT MIN(date) AS min_date, MAX(date) AS max_date FROM facts"),
    "distinct_campaigns": with_("SELECT DISTINCT campaign_name FROM facts"),
    "filter_options": with_(
        "SELECT 'date_min' AS option, CAST(MIN(date) AS VARCHAR) AS value FROM facts UNION ALL "
        "SELECT 'date_max', CAST(MAX(date) AS VARCHAR) FROM facts UNION ALL "
        "SELECT DISTINCT 'platform', platform FROM facts UNION ALL "
        f"SELECT DISTINCT 'campaign', campaign_name FROM facts WHERE {CHOSEN_PLATFORMS}"
    ),
    "filter_facts": unified_rows(CHOSEN),
    "filter_daily": with_(f"SELECT * FROM daily WHERE {CHOSEN_DATES} AND {CHOSEN_PLATFORMS}", DAILY),
    "filter_campaigns": with_(
        f"SELECT * FROM campaigns WHERE {CHOSEN_PLATFORMS} AND {CHOSEN_CAMPAIGNS}", CAMPAIGNS
    ),
    "filter_platform": with_(f"SELECT * FROM weekly WHERE {CHOSEN_PLATFORMS}", WEEKLY),
    "filter_platform_summary": with_(f"SELECT * FROM platforms WHERE {CHOSEN_PLATFORMS}", PLATFORMS),
    "filter_platform_facts": unified_rows("platform = 'Google'"),
    "kpi_cards": kpi_totals(f"WHERE {CHOSEN}"),
    "panel_daily_spend": with_("SELECT date, platform, total_spend FROM daily", DAILY),
    "panel_spend_share": with_(
        f"SELECT platform, {dbl('SUM(spend)', 'total_spend')}, "
        f"{half_up('SUM(spend)', 'SUM(SUM(spend)) OVER ()', 4, 100)} AS spend_share FROM facts GROUP BY platform"
    ),
    "panel_conversions": with_(
        f"SELECT platform, {big('SUM(conversions)', 'total_conversions')} FROM facts GROUP BY platform"
    ),
    "panel_daily_conversions": with_("SELECT date, platform, total_conversions FROM daily", DAILY),
    "panel_platform_table": with_(f"SELECT {PLATFORM_TABLE} FROM platforms", PLATFORMS),
    "panel_platform_table_text": with_(f"SELECT {shown(PLATFORM_TABLE)} FROM platforms", PLATFORMS),
    "panel_campaign_table_text": with_(f"SELECT {shown(CAMPAIGN_TABLE)} FROM campaigns", CAMPAIGNS),
    "panel_radar": with_(RADAR, PLATFORMS),
    "panel_daily_cpa": with_("SELECT date, platform, avg_cpa FROM daily", DAILY),
    "panel_cpm": with_("SELECT platform, avg_cpm FROM platforms", PLATFORMS),
    "panel_weekly_spend": with_("SELECT week_start, platform, spend FROM weekly", WEEKLY),
    "panel_funnel_stages": with_(FUNNEL_STAGES, FUNNEL),
    "panel_quality_points": with_(
        "SELECT campaign_name, ad_group_name, avg_quality_score, avg_cpa, total_cost FROM quality", QUALITY
    ),
    "panel_campaign_table": with_(f"SELECT {CAMPAIGN_TABLE} FROM campaigns", CAMPAIGNS),
    "panel_cpa_by_campaign": with_("SELECT platform, campaign_name, avg_cpa FROM campaigns", CAMPAIGNS),
    "panel_ctr_cvr_points": with_(
        "SELECT platform, campaign_name, avg_ctr, avg_conversion_rate, total_spend FROM campaigns", CAMPAIGNS
    ),
    "panel_spend_conv_points": with_(
        "SELECT platform, campaign_name, total_spend, total_conversions, total_clicks FROM campaigns", CAMPAIGNS
    ),
    "insight_cpa_platform": findings(1),
    "insight_budget": findings(2),
    "insight_campaigns": findings(3, 4),
    "insight_ctr_leader": findings(5),
    "insight_volume_leader": findings(6),
    "insight_trend": findings(7),
    "executive_insights": with_(
        "SELECT *, ROW_NUMBER() OVER (ORDER BY rule_no, CASE WHEN rule_no = 2 THEN -benchmark END, subject) AS position "
        f"FROM ({_union(range(1, 8))}) every",
        CAMPAIGNS, PLATFORMS, WEEKLY,
    ),
    "recommendations": with_(
        f"SELECT *, ROW_NUMBER() OVER (ORDER BY rec_order) AS position FROM ({RECOMMENDATIONS}) every", CAMPAIGNS, PLATFORMS
    ),
    "selected_insights": selected(_union(range(1, 8))),
    "selected_recommendations": selected(RECOMMENDATIONS),
    "published_daily": with_("SELECT * FROM daily", DAILY),
    "published_campaigns": with_("SELECT * FROM campaigns", CAMPAIGNS),
    "published_platforms": with_("SELECT * FROM platforms", PLATFORMS),
    "published_weekly": with_("SELECT * FROM weekly", WEEKLY),
    "published_funnel": with_("SELECT * FROM funnel", FUNNEL),
    "published_quality": with_("SELECT * FROM quality", QUALITY),
    "refreshed_facts": UNIFIED_ROWS,
    "refreshed_campaigns": with_("SELECT * FROM campaigns", CAMPAIGNS),
    "refreshed_quality": with_("SELECT * FROM quality", QUALITY),
    "stored_facts": unified_rows(CHOSEN),
    "dashboard_cards": kpi_totals(f"WHERE {CHOSEN}"),
    "dashboard_spend_share": with_(
        f"SELECT platform, {dbl('SUM(spend)', 'total_spend')}, "
        f"{half_up('SUM(spend)', 'SUM(SUM(spend)) OVER ()', 4, 100)} AS spend_share FROM facts WHERE {CHOSEN_PLATFORMS} GROUP BY platform"
    ),
    "reload_twice": FACEBOOK_LOADED,
    "load_dialect": f"""
SELECT * REPLACE (campaign_name || chr(10) || '"second", line' AS campaign_name,
                  CASE WHEN clicks % 4 = 3 THEN video_views END AS video_views) FROM ({FACEBOOK_LOADED}) loaded""",
    "bad_row_report": with_(
        "SELECT 'FACEBOOK_ADS' AS table_name, CAST(0 AS BIGINT) AS stopped UNION ALL "
        "SELECT 'GOOGLE_ADS', CAST(COUNT(*) > 0 AS BIGINT) FROM facts WHERE platform = 'Google' AND clicks = 0 UNION ALL "
        "SELECT 'TIKTOK_ADS', 0"
    ),
    "view_read": with_("SELECT * FROM weekly", WEEKLY),
    "view_read_daily": with_("SELECT * FROM daily", DAILY),
    "empty_selection": with_(
        f"SELECT 'chosen' AS selection, CAST(COUNT(*) = 0 AS BIGINT) AS is_empty, COUNT(*) AS row_count FROM facts WHERE {CHOSEN} UNION ALL "
        "SELECT 'nobody', CAST(COUNT(*) = 0 AS BIGINT), COUNT(*) FROM facts WHERE FALSE UNION ALL "
        "SELECT 'everything', CAST(COUNT(*) = 0 AS BIGINT), COUNT(*) FROM facts"
    ),
    "ordered_daily": ordered("daily", "date, platform", DAILY),
    "ordered_campaigns": ordered("campaigns", "total_spend DESC, platform, campaign_id, campaign_name", CAMPAIGNS),
    "ordered_platforms": ordered("platforms", "total_spend DESC, platform", PLATFORMS),
    "ordered_weekly": ordered("weekly", "week_start, platform", WEEKLY),
    "ordered_funnel": ordered("funnel", "total_views DESC NULLS LAST, campaign_name", FUNNEL),
    "stored_date_bounds": with_("SELECT MIN(date) AS min_date, MAX(date) AS max_date FROM facts"),
    "bad_cells": with_(
        "SELECT 'GOOGLE_ADS' AS table_name, * FROM ("
        "SELECT 'clicks' AS column, 'none' AS cell, 'not a bigint' AS problem, COUNT(*) AS n, COUNT(*) AS n_lines "
        "FROM facts WHERE platform = 'Google' AND clicks = 0 HAVING COUNT(*) > 0 UNION ALL "
        "SELECT 'date', 'soon', 'not a date', COUNT(*), COUNT(*) "
        "FROM facts WHERE platform = 'Google' AND conversions = 5 HAVING COUNT(*) > 0)"
    ),
    "ordered_panel_conversions": with_(
        f"SELECT platform, {big('SUM(conversions)', 'total_conversions')}, "
        "ROW_NUMBER() OVER (ORDER BY SUM(conversions), platform) AS position FROM facts GROUP BY platform"
    ),
    "ordered_panel_cpm": with_(
        "SELECT platform, avg_cpm, ROW_NUMBER() OVER (ORDER BY avg_cpm NULLS LAST, platform) AS position FROM platforms", PLATFORMS
    ),
    "ordered_panel_cpa": with_(
        "SELECT platform, campaign_name, avg_cpa, "
        "ROW_NUMBER() OVER (ORDER BY avg_cpa NULLS LAST, platform, campaign_id, campaign_name) AS position FROM campaigns", CAMPAIGNS
    ),
    "ordered_quality": ordered("quality", "avg_quality_score DESC NULLS LAST, campaign_name, ad_group_name", QUALITY),
    "kpi_cards_text": f"""
SELECT {money('total_spend')} AS total_spend, {whole('total_conversions')} AS total_conversions, {money('avg_cpa')} AS avg_cpa,
  {percent('avg_ctr', 2)} AS avg_ctr, {whole('total_impressions')} AS total_impressions, {whole('total_clicks')} AS total_clicks,
  {money('avg_cpc')} AS avg_cpc, {percent('avg_conversion_rate', 2)} AS avg_conversion_rate
FROM ({kpi_totals(f"WHERE {CHOSEN}")}) cards""",
}
