"""Which published table answers a question about delivery: the smallest that its filters allow."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendweave.operators.selection import Selection, filter_facts
from spendweave.plans.marts import BASE_MEASURES, day_rows

# Published table, smallest first -> the columns that it can be filtered by.
LEVELS = {
    "platform_summary": {"platform"},
    "daily_platform_summary": {"platform", "date"},
    "campaign_performance": {"platform", "campaign_name"},
    "campaign_rollup": {"platform", "date", "campaign_name"},
}


class PublishedTables(dict[str, DataFrame]):
    """The tables of one published version by name; ``rollups`` has those that the marts were taken from."""

    def __init__(self, tables: dict[str, DataFrame], rollups: dict[str, DataFrame]):
        super().__init__(tables)
        self.rollups = rollups


def level(sel: Selection) -> str:
    """Name of the smallest table that has all columns the selection restricts."""
    needed = sel.restricted()
    return next(name for name, columns in LEVELS.items() if needed <= columns)


def delivery(unified: DataFrame, tables: dict[str, DataFrame], sel: Selection) -> DataFrame:
    """Selected rows with ``platform`` and the base measures, whose sums are those of the selected facts.

    Of tables that are not a published version (such as the views of a session) they are the facts themselves.
    """
    if not isinstance(tables, PublishedTables):
        return filter_facts(unified, sel)
    name = level(sel)
    rows = day_rows(tables.rollups[name]) if name in tables.rollups else tables[name]
    summed = [F.col(m if m in rows.columns else f"total_{m}").alias(m) for m in BASE_MEASURES]
    return filter_facts(rows, sel).select("platform", *summed)
