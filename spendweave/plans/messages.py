"""Texts of findings and recommendations (fixed values: they are part of the result).

A name in braces is a gap filled with a formatted column.
"""

# category, title, detail
LOWEST_CPA = (
    "Efficiency",
    "{platform} delivers the lowest CPA at {cpa}",
    "{platform} achieves a CPA of {cpa}, which is {gap} lower than {other} ({other_cpa}). "
    "Consider shifting budget toward {platform} if the goal is cost-efficient conversions.",
)
UNDER_DELIVERY = (
    "Budget",
    "{platform} receives {spend_share} of spend but only {conversion_share} of conversions",
    "There is a {gap} gap between budget allocation and conversion output for {platform}. "
    "This suggests the platform may be over-funded relative to its conversion efficiency. "
    "Evaluate whether this spend is justified by upper-funnel objectives (brand awareness, reach).",
)
OVER_DELIVERY = (
    "Budget",
    "{platform} over-delivers: {conversion_share} of conversions on {spend_share} of spend",
    "{platform} is converting efficiently — producing a disproportionately high share of "
    "conversions relative to its budget. This is a strong candidate for budget increase to "
    "capture more volume at efficient rates.",
)
BEST_CAMPAIGN = (
    "Campaign",
    "Best campaign: {campaign} ({platform})",
    "CPA of {cpa} with {conversions} conversions on {spend} spend. CTR: {ctr}, Conv Rate: {conversion_rate}.",
)
WORST_CAMPAIGN = (
    "Campaign",
    "Highest CPA campaign: {campaign} ({platform})",
    "CPA of {cpa} — {multiple} higher than the best. Total spend: {spend}, conversions: {conversions}. "
    "Review targeting, creative, and bid strategy for optimization.",
)
HIGHEST_CTR = (
    "Engagement",
    "{platform} has the highest CTR at {ctr}",
    "High CTR indicates strong ad-audience relevance. Combined with a CPC of {cpc} and conversion "
    "rate of {conversion_rate}, this platform shows strong top-of-funnel engagement.",
)
MOST_IMPRESSIONS = (
    "Reach",
    "{platform} drives the most impressions ({impressions})",
    "With {impressions} impressions and a CPM of {cpm}, {platform} is the primary reach driver. "
    "This makes it well-suited for awareness and consideration campaigns.",
)
WEEKLY_TREND = (
    "Trend",
    "{platform} spend {direction} {change} week-over-week",
    "Latest week spend for {platform}: {spend}. Conversions WoW change: {conversions_change}. "
    "Monitor whether spend changes are proportional to conversion changes.",
)

RAISE_PLATFORM = (
    "**Increase {platform} budget share** (currently {share}): It has the lowest CPA ({cpa}) and the "
    "highest conversion efficiency. A 10-20% budget shift from {other} could yield more conversions "
    "at lower cost."
)
SCALE_CAMPAIGN = (
    "**Scale top performer:** {campaign} ({platform}) at {cpa} CPA is the best-performing campaign. "
    "Increase its daily budget or expand its audience targeting."
)
OPTIMISE_CAMPAIGN = (
    "**Optimize or pause:** {campaign} ({platform}) has a CPA of {cpa}. "
    "Test new creatives, tighten targeting, or reallocate its budget."
)
KEEP_DIVERSIFICATION = (
    "**Maintain cross-platform diversification:** Running on 3 platforms reduces audience saturation "
    "risk. Each platform serves different funnel stages — use TikTok/Facebook for awareness, Google "
    "for high-intent conversion capture."
)
