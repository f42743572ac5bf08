"""Exact top-k search by inner product over vectors that are bucketed by their length.

Vectors are dealt out by length into groups of bounded size, and a group's vectors into buckets of
similar length. A query that has k scores of at least t needs a vector of length t / |q| or more to
beat them: groups and buckets below that are never asked. In a bucket whose longest vector is l, only
a cosine of t / (|q| l) or more helps. From that local threshold each bucket's pruning is chosen: by
one coordinate, whose values must lie in an interval around the query's, where few of the bucket's
do, else by length. What is left is verified by exact products.

Thresholds come first from nested samples of the vectors (only as lower bounds, results rest on every
row), then rise within a group from its longest bucket on.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendweave.llm.batches import small_batches
from spendweave.sources.store import materialise

K = 10
#: Components are scaled by this before they are rounded down.
SCALE = 1024
#: Components of a group's vectors: what a task holds, about; groups are smaller where there are few vectors.
GROUP = 1 << 22
LEAST_GROUP = 1 << 11
#: Lengths that the plan of a search names, at most, to tell which groups a query has to ask.
STEPS = 1 << 10
#: A bucket's shortest vector has this part of its longest one's length, and it has so many vectors at most.
SIMILAR = 0.9
BUCKET = 1 << 12
#: Coordinates tried per query, those where it is largest, and the part of a bucket that one may leave to be chosen.
FOCUS = 3
FEW = 0.25
#: Queries that are asked together, and the share of vectors of each sample in the next larger one.
TOGETHER = 256
SAMPLE = 64
#: Scores stop here.
LIMITS = -(1 << 63), (1 << 63) - 1
#: Bounds are loosened by this much, against rounding in lengths and cosines.
SLACK = 1e-6

ROWS = "grp int, asks boolean, row bigint, id bigint, vec array<bigint>, length double, least bigint"
HITS = "row bigint, query_id bigint, vec_id bigint, score bigint"


def scaled(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(id, vec, length): whole-number vectors of the rows that take part."""
    parts = F.col(f"`{embedding}`").cast("array<double>").alias("parts")
    rows = vectors.select(F.col(f"`{vec_id}`").cast("bigint").alias("id"), parts)
    finite = "forall(parts, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    rows = rows.where(f"id IS NOT NULL AND parts IS NOT NULL AND {finite}")
    most = float(1 << 62)
    whole = f"transform(parts, x -> cast(floor(greatest(least(x * {SCALE}D, {most}D), -{most}D)) AS bigint)) AS vec"
    length = "sqrt(aggregate(vec, 0D, (s, x) -> s + cast(x AS double) * x)) AS length"
    return rows.selectExpr("id", whole).selectExpr("id", "vec", length)


def _matrix(vectors: pa.Array, width: int = 0) -> np.ndarray:
    """Vectors as rows, shorter ones filled up with zeros."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    width = max(width, int(sizes.max(initial=0)))
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _exact_type(longest: float) -> type:
    """The cheapest numbers that hold all sums of products up to a product of two lengths exactly."""
    if longest < 1 << 23:
        return np.float32
    return np.float64 if longest < 1 << 52 else object


class Buckets:
    """A group's vectors by falling length, cut into buckets, with each coordinate's order in each bucket."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, lengths: np.ndarray):
        order = np.lexsort((ids, -lengths))
        self.ids, self.whole, self.lengths = ids[order], vectors[order], lengths[order]
        self.longest = float(lengths.max(initial=0))
        self.by_type: dict[type, np.ndarray] = {}
        self.cuts = [0]
        while (lo := self.cuts[-1]) < len(ids):
            similar = int(np.searchsorted(-self.lengths, -SIMILAR * self.lengths[lo], "right"))
            self.cuts.append(max(lo + 1, min(lo + BUCKET, similar)))
        self.sorted: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    @staticmethod
    def _loose(scores):
        """Below scores that a float cannot hold exactly."""
        return scores - np.abs(scores) * SLACK - 1

    def typed(self, kind: type) -> np.ndarray:
        if kind not in self.by_type:
            self.by_type[kind] = self.whole.astype(kind)
        return self.by_type[kind]

    def coordinates(self, bucket: int) -> tuple[np.ndarray, np.ndarray]:
        """Of a bucket's vectors at length one: the places and the values of each coordinate in its order."""
        if bucket not in self.sorted:
            lo, hi = self.cuts[bucket : bucket + 2]
            unit = self.whole[lo:hi] / np.maximum(self.lengths[lo:hi, None], 1e-300)
            places = unit.argsort(axis=0)
            self.sorted[bucket] = places, np.take_along_axis(unit, places, 0)
        return self.sorted[bucket]

    def ask(self, own: np.ndarray, queries: np.ndarray, lengths: np.ndarray, least: np.ndarray) -> Iterator[tuple]:
        """(query's place, ids, scores) of the k best of this group that reach each query's threshold."""
        kind = _exact_type(self.longest * float(lengths.max(initial=0)))
        asked, stored = queries.astype(kind), self.typed(kind)
        n, k = len(own), K
        ids = np.zeros((n, k), np.int64)
        scores = np.full((n, k), -np.inf if kind is not object else None, kind)
        filled = np.zeros(n, np.int64)
        bar = self._loose(least) if kind is object else least.copy()  # no score below counts
        unit = queries / np.maximum(lengths[:, None], 1e-300)
        focus = np.abs(unit).argsort(axis=1)[:, ::-1][:, :FOCUS]

        def merge(q: int, places: np.ndarray, got: np.ndarray) -> None:
            if kind is object:
                got = np.clip(got, *LIMITS)
            good = (got >= bar[q]) & (self.ids[places] != own[q]) if np.isfinite(bar[q]) else self.ids[places] != own[q]
            if not good.any():
                return
            got, places = got[good], places[good]
            if len(got) > 4 * k:  # ties with the last of them stay in
                at = np.sort(got)[-k] if kind is object else np.partition(got, -k)[-k]
                got, places = got[got >= at], places[got >= at]
            f = filled[q]
            got, names = np.append(scores[q, :f], got), np.append(ids[q, :f], self.ids[places])
            best = np.array(sorted(range(len(got)), key=lambda i: (-got[i], names[i]))[:k]) if kind is object else np.lexsort((names, -got))[:k]
            filled[q] = len(best)
            scores[q, : len(best)], ids[q, : len(best)] = got[best], names[best]
            if len(best) == k:
                last = float(scores[q, k - 1])
                bar[q] = max(bar[q], self._loose(last) if kind is object else last)

        for bucket, (lo, hi) in enumerate(zip(self.cuts, self.cuts[1:])):
            top = self.lengths[lo]
            reach = lengths * top
            active = np.flatnonzero(~(bar > reach * (1 + SLACK) + SLACK))
            if not len(active):
                break  # vectors only get shorter
            cosine = np.where(bar[active] > 0, bar[active] / np.maximum(reach[active], 1e-300), 0) * (1 - SLACK)
            by_length = []
            for q, c in zip(active.tolist(), np.minimum(cosine, 1).tolist()):
                chosen = None
                if c > 0:
                    places, values = self.coordinates(bucket)
                    spread = np.arccos(c)
                    for f in focus[q].tolist():
                        angle = np.arccos(min(1.0, max(-1.0, unit[q, f])))
                        low = np.cos(min(np.pi, angle + spread)) - SLACK
                        high = np.cos(max(0.0, angle - spread)) + SLACK
                        a, b = np.searchsorted(values[:, f], (low, high))
                        if chosen is None or b - a < chosen[2] - chosen[1]:
                            chosen = f, a, b
                if chosen and chosen[2] - chosen[1] < FEW * (hi - lo):
                    f, a, b = chosen
                    rows = lo + places[a:b, f]
                    merge(q, rows, stored[rows] @ asked[q])
                else:
                    by_length.append(q)
            if by_length:
                # as far down the bucket as the least demanding of these queries needs
                need = np.min(np.where(bar[by_length] > 0, bar[by_length], 0) / np.maximum(lengths[by_length], 1e-300))
                end = lo + int(np.searchsorted(-self.lengths[lo:hi], -need * (1 - SLACK) + SLACK, "right"))
                products = stored[lo:end] @ asked[by_length].T
                for column, q in enumerate(by_length):
                    merge(q, np.arange(lo, end), products[:, column])
        for q in range(n):
            yield q, ids[q, : filled[q]], scores[q, : filled[q]]


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ROWS: a group's vectors, then its queries, which stream past them."""
    group, parts, buckets = None, [], None
    for batch in batches:
        grp, asks = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.append(True, (grp[1:] != grp[:-1]) | (asks[1:] != asks[:-1]))) if len(grp) else []
        for lo, hi in zip(cuts, [*cuts[1:], len(grp)]):
            part = batch.slice(lo, hi - lo)
            if grp[lo] != group:
                group, parts, buckets = grp[lo], [], None
            if not asks[lo]:
                parts.append(part)
                continue
            if parts:
                held = pa.Table.from_batches(parts)
                ids, vec, length = (held.column(c).combine_chunks() for c in ("id", "vec", "length"))
                buckets, parts = Buckets(ids.to_numpy(), _matrix(vec), length.to_numpy()), []
            if buckets is not None:
                for at in range(0, part.num_rows, TOGETHER):
                    yield _answers(buckets, part.slice(at, TOGETHER))


def _answers(buckets: Buckets, part: pa.RecordBatch) -> pa.RecordBatch:
    row, own, length = (part.column(c).to_numpy() for c in ("row", "id", "length"))
    least = part.column("least").cast(pa.float64()).fill_null(-np.inf).to_numpy(zero_copy_only=False)
    width = buckets.whole.shape[1]
    asked = _matrix(part.column("vec"), width)
    if asked.shape[1] > width:  # what a vector does not have is zero
        asked = asked[:, :width]
    out = [(q, ids, scores) for q, ids, scores in buckets.ask(own, asked, length, least) if len(ids)]
    sizes = [len(ids) for _, ids, _ in out]
    at = np.repeat(np.array([q for q, _, _ in out], np.int64), sizes)
    ids = np.concatenate([x for _, x, _ in out]) if out else np.zeros(0, np.int64)
    scores = [int(s) for _, _, x in out for s in x]
    return pa.RecordBatch.from_arrays([pa.array(row[at]), pa.array(own[at]), pa.array(ids), pa.array(scores, pa.int64())], ["row", "query_id", "vec_id", "score"])


def _best(hits: DataFrame) -> DataFrame:
    """The k best per query row; the limit works before the shuffle too."""
    order = Window.partitionBy("row").orderBy(F.col("score").desc(), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(f"rank <= {K}")


def _asked(vectors: DataFrame, queries: DataFrame, longest: list[float], every: int) -> DataFrame:
    """Hits of all queries in one of ``every`` vectors. Groups that no vector of can reach a query's threshold are not asked."""
    sample = vectors if every == 1 else vectors.where(f"pmod(xxhash64(row), {every}) = 0")
    held = sample.selectExpr(f"cast(grp / {every} AS int) AS grp", "false AS asks", "row", "id", "vec", "length", "cast(NULL AS bigint) AS least")
    # groups are by rising length: all from the first that reaches the threshold on, told in steps of some groups
    last = (len(longest) - 1) // every
    step = every * (last // STEPS + 1)
    tops = F.array(*[F.lit(max(longest[at : at + step])) for at in range(0, len(longest), step)])
    need = F.when(F.col("least") > 0, F.col("least") / F.greatest("length", F.lit(1e-300)) * (1 - SLACK)).otherwise(F.lit(0.0))
    from_group = (F.size(F.filter(tops, lambda top: top < need)) * (step // every)).cast("int")
    reached = F.when(from_group <= last, F.sequence(from_group, F.lit(last)))
    asking = queries.select(F.explode(reached).alias("grp"), F.lit(True).alias("asks"), "row", "id", "vec", "length", "least")
    dealt = held.unionByName(asking).repartition("grp").sortWithinPartitions("grp", "asks")
    return dealt.mapInArrow(_search, HITS)


def search(vectors: DataFrame, asks: str = "vec_id % 100 = 0", vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k vectors with the highest inner product for each query.

    ``asks`` is SQL on ``vec_id`` that tells which rows are queries. Of equal scores the smaller vec_id
    comes first; all vectors are listed where there are fewer than k. Rows without vec_id or vector, and
    vectors with a null or non-finite component, take no part. A vector that is shorter than another has
    zeros there. Rows that repeat a vec_id are candidates each, and queries each, but none for a query of
    its own vec_id. Scores and scaled components stop at the limits of 64 bits. An empty table has no
    queries. Other columns are not read.

    A task holds one group of vectors, whose queries stream past it in batches; hot lengths and repeated
    vectors are dealt out like any others, since groups are cut by length and id together.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    n, components = vectors.agg(F.count("*"), F.coalesce(F.sum(F.size(f"`{embedding}`").cast("bigint")), F.lit(0))).first()
    groups = max(1, -(-components // GROUP), min(-(-n // LEAST_GROUP), 2 * spark.sparkContext.defaultParallelism))
    rows = scaled(vectors, vec_id, embedding).repartitionByRange(groups, "length", "id")
    rows = rows.withColumns({"grp": F.spark_partition_id(), "row": F.monotonically_increasing_id()})
    rows, n = materialise(rows, "scaled-vectors")
    # a number per group
    tops = dict(rows.groupBy("grp").agg(F.max("length")).toLocalIterator())
    if not tops:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    longest = list(accumulate((tops.get(g, 0.0) for g in range(max(tops) + 1)), max))
    queries = rows.withColumnRenamed("id", "vec_id").where(asks).withColumnRenamed("vec_id", "id")
    queries, _ = materialise(queries.drop("grp").withColumn("least", F.lit(None).cast("bigint")), "queries")
    every = 1
    while n // every > LEAST_GROUP * SAMPLE // 4:
        every *= SAMPLE
    while every > 1:
        best = _best(_asked(rows, queries, longest, every))
        least = best.where(f"rank = {K}").select("row", F.col("score").alias("found"))
        better = queries.join(least, "row", "left").withColumn("least", F.greatest("least", "found")).drop("found")
        queries, _ = materialise(better, "queries")
        every //= SAMPLE
    return _best(_asked(rows, queries, longest, 1)).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
