"""Row counts and checks of raw feeds."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendweave.operators.selection import date_bounds

from spendweave.plans.marts import CAMPAIGN_KEYS, day_rows
from spendweave.sources import versions
from spendweave.sources.specs import SourceSpec


def row_counts(tables: dict[str, DataFrame], name: str = "table_name") -> DataFrame:
    """(name, row_count) of each frame, as one query over all of them."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(label).alias(name), "row_count")
        for label, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def view_row_counts(rollup: DataFrame) -> DataFrame:
    """(view_name, row_count) of the four unified views, all from one campaign roll-up of the facts."""
    days = day_rows(rollup)  # all four are in them; ad groups are not read
    one = days.agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("UNIFIED_ADS"),
        F.count_distinct(F.struct("date", "platform")).alias("DAILY_PLATFORM_SUMMARY"),
        F.count_distinct(F.struct(*CAMPAIGN_KEYS)).alias("CAMPAIGN_PERFORMANCE"),
        F.count_distinct("platform").alias("PLATFORM_SUMMARY"),
    )
    rows = [F.struct(F.lit(c).alias("view_name"), F.col(c).alias("row_count")) for c in one.columns]
    return one.select(F.inline(F.array(*rows)))


@contextmanager
def _footers(spark: SparkSession) -> Iterator[SparkSession]:
    """A session beside ``spark`` that answers counts and bounds from Parquet footers, without reading rows."""
    beside = spark.newSession()
    for key, value in {
        "spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text",
        "spark.sql.parquet.aggregatePushdown": "true",
        "spark.sql.session.timeZone": spark.conf.get("spark.sql.session.timeZone"),
    }.items():
        beside.conf.set(key, value)
    yield beside


def stored_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    """(table_name, row_count) of the published tables but the roll-ups, from file footers alone."""
    with _footers(spark) as beside:
        version = versions.version(beside, folder)
        return row_counts({name: version.read(name) for name in version.tables if not name.endswith("_rollup")})


def stored_date_bounds(spark: SparkSession, folder: str) -> DataFrame:
    """First and last date of the published facts, from file footers; by a scan where a footer has no bounds."""
    with _footers(spark) as beside:
        bounds = date_bounds(versions.version(beside, folder).read("unified_ads"))
        try:
            bounds.collect()
        except PySparkException:
            return date_bounds(versions.version(spark, folder).read("unified_ads"))
        return bounds


def length_violations(raw: DataFrame, spec: SourceSpec) -> DataFrame:
    """(column, limit, too_long): texts over their declared length, in one pass."""
    limited = [f for f in spec.fields if f.max_length]
    over = raw.agg(*[F.count_if(F.length(f.name) > f.max_length).alias(f.name) for f in limited])
    rows = [
        F.struct(
            F.lit(f.name).alias("column"), F.lit(f.max_length).alias("limit"), F.col(f.name).alias("too_long")
        )
        for f in limited
    ]
    return over.select(F.inline(F.array(*rows)))
