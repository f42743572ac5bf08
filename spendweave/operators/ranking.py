"""Competition ranks over a whole table, without sorting it in one task.

``rank() over (order by x)`` moves every row to one partition. Here ranks are counted instead:
values of all rankings are reduced to (value, how often) in one pass over the rows, dealt out in
ranges of their order, summed up within each range, and shifted by what the ranges before hold.
Equal values share a rank, and NULL comes last. There is one plan for all sizes and all
types that have an order; a small table makes one range.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendweave.sources.store import materialise


@dataclass(frozen=True)
class Ranking:
    """Rank ``value`` into column ``out``, best first."""

    out: str
    value: Column
    descending: bool = False


def with_global_ranks(df: DataFrame, rankings: list[Ranking]) -> DataFrame:
    """Add one rank column per entry of ``rankings``.

    Runs ``df`` once and keeps it as a scratch table, so that no rank has to compute it again.
    """
    values = [f"_value{i}" for i in range(len(rankings))]
    placed = df.withColumns({v: r.value for v, r in zip(values, rankings)})
    stored, _ = materialise(placed.withColumn("_row", F.monotonically_increasing_id()), "ranked")
    # the id of a grouping set has a bit for each column that it leaves out
    sets = [2 ** len(values) - 1 - 2 ** (len(values) - 1 - i) for i in range(len(values))]
    order = [_ordered(v, r.descending) for v, r in zip(values, rankings)]
    ranks = _ranks(_ranges(stored, values, order), values, order)
    # a narrow row for each row and ranking, with that ranking's value alone, meets its rank
    kinds = dict(stored.select(*values).dtypes)
    each = F.array(*[
        F.struct(F.lit(own).alias("_set"), *[(F.col(v) if v == value else F.lit(None).cast(kinds[v])).alias(f"{v}_own") for v in values])
        for own, value in zip(sets, values)
    ])
    narrow = stored.select("_row", F.inline(each))
    same = F.col("_set") == F.col("_ranked_set")
    for value in values:
        same &= F.col(f"{value}_own").eqNullSafe(F.col(value))
    # one match per row; AQE splits the partition of a value that many rows share
    found = narrow.join(ranks, same).groupBy("_row").agg(
        *[F.max(F.when(F.col("_set") == own, F.col("_rank"))).alias(r.out) for own, r in zip(sets, rankings)]
    )
    return stored.drop(*values).join(found, "_row").drop("_row")


def _ordered(value: str, descending: bool) -> Column:
    return F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()


def _ranges(stored: DataFrame, values: list[str], order: list[Column]) -> DataFrame:
    """(set, value columns, n, range): distinct values of each ranking with their range in its order.

    Stored, so that all that is built on range numbers agrees on them.
    """
    keys = [F.col(v) for v in values]
    # a value held by many rows becomes one row here, combined before the shuffle
    counts = stored.groupingSets([[k] for k in keys], *keys).agg(
        F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("_n")
    )
    ranged = counts.repartitionByRange(F.col("_set"), *order).withColumn("_range", F.spark_partition_id())
    return materialise(ranged, "ranges")[0]


def _ranks(ranges: DataFrame, values: list[str], order: list[Column]) -> DataFrame:
    """(ranked set, value columns, rank) of all rankings; within a set only its own value is not NULL."""
    # a row per set and range
    before_range = Window.partitionBy("_set").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranges.groupBy("_set", "_range")
        .agg(F.sum("_n").alias("_total"))
        .select("_set", "_range", F.coalesce(F.sum("_total").over(before_range), F.lit(0)).alias("_offset"))
    )
    in_range = Window.partitionBy("_set", "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranges.withColumn("_before", F.coalesce(F.sum("_n").over(in_range), F.lit(0)))
        .join(offsets, ["_set", "_range"])
        .select(
            F.col("_set").alias("_ranked_set"), *values,
            (F.col("_offset") + F.col("_before") + 1).cast("bigint").alias("_rank"),
        )
    )
