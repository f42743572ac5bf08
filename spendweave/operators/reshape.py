"""Wide to long."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Funnel column -> label of the stage, in order (fixed values).
FUNNEL_STAGES = {
    "total_views": "Views",
    "watched_25pct": "25% Watched",
    "watched_50pct": "50% Watched",
    "watched_75pct": "75% Watched",
    "watched_100pct": "100% Watched",
}


def funnel_stages(totals: DataFrame) -> DataFrame:
    """One row of funnel totals as five rows (stage_no, stage, count)."""
    stages = [
        F.struct(F.lit(no).alias("stage_no"), F.lit(label).alias("stage"), F.col(c).alias("count"))
        for no, (c, label) in enumerate(FUNNEL_STAGES.items(), start=1)
    ]
    return totals.select(F.inline(F.array(*stages)))


def to_long(df: DataFrame, keys: list[str], columns: list[str], name: str, value: str) -> DataFrame:
    """Columns to (name, value) rows."""
    return df.unpivot(keys, columns, name, value)
