"""Conform the raw feeds to one fact table and compute the row indicators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from spendweave.functions.kpis import row_kpis
from spendweave.sources.specs import FACT_FIELDS, FACEBOOK, GOOGLE, TIKTOK, UNIFIED_COLUMNS, SourceSpec


def conform(raw: DataFrame, spec: SourceSpec) -> DataFrame:
    """Rename to the fact layout, tag the platform, pad what the feed lacks with typed NULLs.

    The platform is a literal, so a later filter on it folds to true or false and
    Catalyst drops the other feeds without reading them.
    """
    provides = spec.provides

    def source(name: str) -> str:
        return f"'{spec.platform}'" if name == "platform" else provides.get(name, "NULL")

    return raw.selectExpr(*[f"CAST({source(f.name)} AS {f.type}) AS {f.name}" for f in FACT_FIELDS])


def unify(*conformed: DataFrame) -> DataFrame:
    """Bag union of conformed feeds: nothing is de-duplicated and nothing shuffles."""
    return reduce(DataFrame.unionByName, conformed)


def with_row_kpis(facts: DataFrame) -> DataFrame:
    """Add CTR, CPC, CPA, conversion rate and CPM to each row, in unified column order.

    Columns that a later step does not read are pruned, so the marts can take this
    frame without paying for the row quotients.
    """
    kpis = row_kpis("impressions", "clicks", "spend", "conversions")
    return facts.select(*[kpis[c].alias(c) if c in kpis else c for c in UNIFIED_COLUMNS])


def unified_ads(facebook: DataFrame, google: DataFrame, tiktok: DataFrame) -> DataFrame:
    """The unified view over the three raw feeds."""
    feeds = ((facebook, FACEBOOK), (google, GOOGLE), (tiktok, TIKTOK))
    return with_row_kpis(unify(*[conform(raw, spec) for raw, spec in feeds]))
