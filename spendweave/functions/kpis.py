"""Delivery and cost indicators, defined once for rows and for aggregates.

An indicator is an exact quotient with a single half-up rounding at the end, as a
DECIMAL. A zero denominator gives NULL. On aggregates divide sums, so that the
result is a ratio of sums and never a mean of row ratios.

Operands are SQL expressions (mostly column names), so that an indicator is parsed
as one expression rather than built from many Column calls.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Decimal places of each indicator (fixed values).
KPI_PLACES = {"ctr": 4, "cpc": 2, "cpa": 2, "conversion_rate": 4, "cpm": 2, "roas": 2}

# as wide as sums of amounts, DECIMAL(22,2), and of counts, BIGINT; a quotient keeps 13 places or more
_EXACT = "DECIMAL(22,2)"


def _quotient(num: str, den: str) -> str:
    return f"CAST({num} AS {_EXACT}) / NULLIF({den}, 0)"


def quotient(num: str, den: str) -> Column:
    """``num / den`` in DECIMAL, unrounded; NULL where ``den`` is zero."""
    return F.expr(_quotient(num, den))


def ratio(num: str, den: str, places: int) -> Column:
    """``num / den`` rounded half-up to ``places``; NULL where ``den`` is zero."""
    return F.expr(f"ROUND({_quotient(num, den)}, {places})")


def row_ratio(num: str, den: str, places: int, num_places: int = 0) -> Column:
    """``ratio`` of two BIGINT operands in long arithmetic, several times cheaper.

    ``num`` counts units of ``10**-num_places`` (cents: 2). For single rows only:
    ``2 * num * 10**(places - num_places)`` has to fit in a BIGINT, which holds for
    the counts and cents of one fact row but not for sums over a large table; ANSI
    mode raises where it does not.
    """
    twice = 2 * 10 ** (places - num_places)
    # integer division of |num / den| + 1/2, then the sign
    units = f"(ABS({num}) * {twice} + ABS({den})) DIV NULLIF(2 * ABS({den}), 0)"
    signed = f"({units}) * IF(({num} < 0) != ({den} < 0), -1, 1)"
    return F.expr(f"CAST(CAST({signed} AS DECIMAL(16,0)) * {10**-places:.{places}f} AS DECIMAL(18,{places}))")


def mean(value: str, places: int) -> Column:
    """Aggregate: unweighted mean of the non-NULL rows, rounded half-up once."""
    return ratio(f"SUM({value})", f"COUNT({value})", places)


def ratio_or_zero(num: str, den: str) -> Column:
    """Unrounded DOUBLE quotient, 0 on a zero or missing denominator (KPI cards)."""
    return F.expr(f"COALESCE(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0), 0D)")


def inverse(value: str) -> Column:
    """``1 / value`` where it is positive, otherwise 0 (also for NULL)."""
    return F.expr(f"IF({value} > 0, 1D / CAST({value} AS DOUBLE), 0D)")


def row_kpis(impressions: str, clicks: str, spend: str, conversions: str) -> dict[str, Column]:
    """The five delivery indicators of single fact rows; ``spend`` has two decimals."""
    cents = f"CAST({spend} * 100 AS BIGINT)"
    return {
        "ctr": row_ratio(clicks, impressions, KPI_PLACES["ctr"]),
        "cpc": row_ratio(cents, clicks, KPI_PLACES["cpc"], num_places=2),
        "cpa": row_ratio(cents, conversions, KPI_PLACES["cpa"], num_places=2),
        "conversion_rate": row_ratio(conversions, clicks, KPI_PLACES["conversion_rate"]),
        "cpm": row_ratio(f"({cents} * 1000)", impressions, KPI_PLACES["cpm"], num_places=2),
    }


def mart_kpis(
    impressions: str, clicks: str, spend: str, conversions: str, prefix: str = "avg_"
) -> dict[str, Column]:
    """The five delivery indicators of aggregated rows as ``{prefix + name: column}``."""
    exact = {
        "ctr": _quotient(clicks, impressions),
        "cpc": _quotient(spend, clicks),
        "cpa": _quotient(spend, conversions),
        "conversion_rate": _quotient(conversions, clicks),
        # multiplied before the division, so that only one rounding happens
        "cpm": f"CAST({spend} AS {_EXACT}) * 1000 / NULLIF({impressions}, 0)",
    }
    return {prefix + name: F.expr(f"ROUND({value}, {KPI_PLACES[name]})") for name, value in exact.items()}


def roas(conversion_value: str, spend: str) -> Column:
    """Return on ad spend; NULL where the platform reports no conversion value."""
    return ratio(conversion_value, spend, KPI_PLACES["roas"])
