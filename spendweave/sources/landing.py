"""Ad feeds out of the order tables that this repository is tested and measured on.

The tables hold no advertising data, so ``lineitem`` (with brand and type from
``part``) is read as one landing table that holds the rows of all three feeds,
told apart by ``l_returnflag``.

* ``raw_feeds`` gives the three raw-shaped frames, the input that ``unified_ads``
  and the raw marts are made for.
* ``landing_facts`` gives the same unified rows in a single scan: a column that a
  platform does not deliver is NULL on its rows. Three filtered reads of one big
  table would cost three times the input.

Campaigns and ad groups come from the lookup in ``part``. Queries that read none of
their columns take the frames with ``campaigns=False``, without the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendweave.operators.unify import with_row_kpis
from spendweave.sources.specs import FACT_FIELDS, FACEBOOK, GOOGLE, SPECS, TIKTOK, SourceSpec

FLAG = {FACEBOOK.platform: "A", GOOGLE.platform: "N", TIKTOK.platform: "R"}

_QUANTITY = "CAST(l_quantity AS BIGINT)"
_LINE = "CAST(l_linenumber AS BIGINT)"
_PRICE = "CAST(l_extendedprice AS DECIMAL(12,2))"

# of each part: computed once per part, not per row
LOOKUP = {
    "campaign_id": "p_brand",
    "campaign_name": "CONCAT('C_', p_brand)",
    "ad_group_id": "CONCAT(p_brand, '/', p_type)",
    "ad_group_name": "p_type",
}

MEASURES = {
    "date": "CAST(l_shipdate AS DATE)",
    **{name: name for name in LOOKUP},
    "impressions": f"({_QUANTITY} - 1) * 100",
    "clicks": f"GREATEST({_QUANTITY} - {_LINE}, 0)",
    "spend": _PRICE,
    # differs by feed, so that platforms differ in cost per conversion
    "conversions": f"CASE l_returnflag WHEN 'A' THEN {_LINE} + 1 WHEN 'N' THEN {_LINE} - 1 "
    f"ELSE GREATEST({_LINE} - 3, 0) END",
    "video_views": f"{_QUANTITY} * 50",
    "engagement_rate": "l_tax",
    "reach": f"{_QUANTITY} * 80",
    "frequency": "l_discount + 1",
    "conversion_value": f"{_PRICE} * CAST(l_tax AS DECIMAL(4,2))",
    "quality_score": f"NULLIF({_LINE} + 1, 8)",
    "search_impression_share": "l_discount",
    "video_watch_25": f"{_QUANTITY} * 40",
    "video_watch_50": f"{_QUANTITY} * 30",
    "video_watch_75": f"{_QUANTITY} * 20",
    "video_watch_100": f"{_QUANTITY} * 10",
    "likes": f"{_LINE} * 7",
    "shares": f"{_LINE} * 2",
    "comments": _LINE,
}


def _landing(spark: SparkSession, data_dir: str, campaigns: bool) -> DataFrame:
    lineitem = spark.read.parquet(f"{data_dir}/lineitem.parquet").filter("l_returnflag IN ('A', 'N', 'R')")
    if not campaigns:
        return lineitem.selectExpr("*", *[f"CAST(NULL AS STRING) AS {name}" for name in LOOKUP])
    part = spark.read.parquet(f"{data_dir}/part.parquet")
    part = part.selectExpr("p_partkey", *[f"{value} AS {name}" for name, value in LOOKUP.items()])
    # No broadcast hint: the table grows with the data. By its size it is broadcast, or
    # joined sort-merge, where AQE splits the partition of a part that many rows name.
    return lineitem.join(part, F.expr("l_partkey = p_partkey"), "left")


def _as_raw(landing: DataFrame, spec: SourceSpec) -> DataFrame:
    unified_name = {raw: name for name, raw in spec.provides.items()}
    columns = []
    for f in spec.fields:
        value = "0" if f.name in spec.dropped else MEASURES[unified_name[f.name]]
        columns.append(f"CAST({value} AS {f.type}) AS {f.name}")
    return landing.filter(f"l_returnflag = '{FLAG[spec.platform]}'").selectExpr(*columns)


def raw_feeds(
    spark: SparkSession, data_dir: str, campaigns: bool = True
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Facebook-, Google- and TikTok-shaped raw frames."""
    landing = _landing(spark, data_dir, campaigns)
    return tuple(_as_raw(landing, spec) for spec in (FACEBOOK, GOOGLE, TIKTOK))


def landing_facts(spark: SparkSession, data_dir: str, campaigns: bool = True) -> DataFrame:
    """The unified view of the landing table, read once."""
    platforms = " ".join(f"WHEN '{FLAG[s.platform]}' THEN '{s.platform}'" for s in SPECS)

    def source(name: str) -> str:
        if name == "platform":
            return f"CASE l_returnflag {platforms} END"
        owners = [FLAG[s.platform] for s in SPECS if name in s.provides]
        if len(owners) == len(SPECS):
            return MEASURES[name]
        flags = ", ".join(f"'{o}'" for o in owners)
        return f"IF(l_returnflag IN ({flags}), {MEASURES[name]}, NULL)"

    facts = _landing(spark, data_dir, campaigns).selectExpr(
        *[f"CAST({source(f.name)} AS {f.type}) AS {f.name}" for f in FACT_FIELDS]
    )
    return with_row_kpis(facts)
