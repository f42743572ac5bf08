"""Declared layouts: one ``SourceSpec`` per ad platform, and the unified fact table.

A further platform is a further ``SourceSpec``; no operator has to change.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


# Cells that mean NULL in a raw feed (fixed values).
NULL_TOKENS = ("", "NULL", "null")


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    max_length: int | None = None


@dataclass(frozen=True)
class SourceSpec:
    """Layout of one raw feed and how its columns are called in the fact table."""

    platform: str
    table: str
    fields: tuple[Field, ...]
    renames: dict[str, str] = field(default_factory=dict)
    dropped: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def provides(self) -> dict[str, str]:
        """Unified column name -> raw column name."""
        return {self.renames.get(c, c): c for c in self.columns if c not in self.dropped}

    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(", ".join(f"{f.name} {f.type}" for f in self.fields))

    def string_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])


COUNT = "bigint"
MONEY = "decimal(12,2)"


def _text(name: str, limit: int) -> Field:
    return Field(name, "string", limit)


# Column names, order, types and length limits of the raw feeds.
FACEBOOK = SourceSpec(
    platform="Facebook",
    table="FACEBOOK_ADS",
    fields=(
        Field("date", "date"),
        _text("campaign_id", 50),
        _text("campaign_name", 200),
        _text("ad_set_id", 50),
        _text("ad_set_name", 200),
        Field("impressions", COUNT),
        Field("clicks", COUNT),
        Field("spend", MONEY),
        Field("conversions", COUNT),
        Field("video_views", COUNT),
        Field("engagement_rate", "decimal(10,4)"),
        Field("reach", COUNT),
        Field("frequency", "decimal(10,2)"),
    ),
    renames={"ad_set_id": "ad_group_id", "ad_set_name": "ad_group_name"},
)

GOOGLE = SourceSpec(
    platform="Google",
    table="GOOGLE_ADS",
    fields=(
        Field("date", "date"),
        _text("campaign_id", 50),
        _text("campaign_name", 200),
        _text("ad_group_id", 50),
        _text("ad_group_name", 200),
        Field("impressions", COUNT),
        Field("clicks", COUNT),
        Field("cost", MONEY),
        Field("conversions", COUNT),
        Field("conversion_value", MONEY),
        Field("ctr", "decimal(10,4)"),
        Field("avg_cpc", "decimal(10,2)"),
        Field("quality_score", COUNT),
        Field("search_impression_share", "decimal(10,2)"),
    ),
    renames={"cost": "spend"},
    dropped=("ctr", "avg_cpc"),  # recomputed from clicks and spend
)

TIKTOK = SourceSpec(
    platform="TikTok",
    table="TIKTOK_ADS",
    fields=(
        Field("date", "date"),
        _text("campaign_id", 50),
        _text("campaign_name", 200),
        _text("adgroup_id", 50),
        _text("adgroup_name", 200),
        Field("impressions", COUNT),
        Field("clicks", COUNT),
        Field("cost", MONEY),
        Field("conversions", COUNT),
        Field("video_views", COUNT),
        Field("video_watch_25", COUNT),
        Field("video_watch_50", COUNT),
        Field("video_watch_75", COUNT),
        Field("video_watch_100", COUNT),
        Field("likes", COUNT),
        Field("shares", COUNT),
        Field("comments", COUNT),
    ),
    renames={"adgroup_id": "ad_group_id", "adgroup_name": "ad_group_name", "cost": "spend"},
)

SPECS: tuple[SourceSpec, ...] = (FACEBOOK, GOOGLE, TIKTOK)

# The unified fact table, in output order.
COMMON_FIELDS = (
    Field("platform", "string"),
    Field("date", "date"),
    Field("campaign_id", "string"),
    Field("campaign_name", "string"),
    Field("ad_group_id", "string"),
    Field("ad_group_name", "string"),
    Field("impressions", COUNT),
    Field("clicks", COUNT),
    Field("spend", MONEY),
    Field("conversions", COUNT),
)
KPI_NAMES = ("ctr", "cpc", "cpa", "conversion_rate", "cpm")
PLATFORM_FIELDS = (
    Field("video_views", COUNT),
    Field("engagement_rate", "decimal(10,4)"),
    Field("reach", COUNT),
    Field("frequency", "decimal(10,2)"),
    Field("conversion_value", MONEY),
    Field("quality_score", COUNT),
    Field("search_impression_share", "decimal(10,2)"),
    Field("video_watch_25", COUNT),
    Field("video_watch_50", COUNT),
    Field("video_watch_75", COUNT),
    Field("video_watch_100", COUNT),
    Field("likes", COUNT),
    Field("shares", COUNT),
    Field("comments", COUNT),
)
FACT_FIELDS = COMMON_FIELDS + PLATFORM_FIELDS
UNIFIED_COLUMNS = [f.name for f in COMMON_FIELDS] + list(KPI_NAMES) + [f.name for f in PLATFORM_FIELDS]
