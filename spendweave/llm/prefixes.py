"""Prefix trie of conversations, with a count-min sketch that keeps singletons out of the shuffles.

A conversation's turns become a chain of digests: the digest of depth d stands for its first d turns.
All digests are counted in a count-min sketch. A counter never reads too low, so a digest with a
counter of one is held by one conversation only, and so is all below it. Nodes of such tails are put
out where they are. Only what may be shared goes on to exact grouping, as narrow rows without texts.

What the sketch sends to the tasks is one bit per counter, whether it is over one, and has a fixed
bound. On larger inputs it fills up and proves less; the rest is grouped exactly, so results are whole.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendweave.llm.batches import small_batches
from spendweave.sources.store import materialise

#: Conversations of so many ids share the opening of the first of them; its length is below OPENING.
HUNDRED = 100
OPENING = 6
#: Rows of counters, and counters of a row per digest; a row has MOST_CELLS at most (both rows 16 MB of bits).
SKETCH_ROWS = 2
CELLS = 8
MOST_CELLS = 1 << 26
#: Ids of conversations that end at a node are joined to texts of so many before they are hashed in turn.
IDS = 4096

NOTHING = hashlib.sha256(b"").hexdigest()
CHAIN = "conv_id bigint, depth bigint, up1 bigint, up2 bigint, h1 bigint, h2 bigint, size bigint, last boolean"
ROOT = hashlib.sha256(b"").digest()[:16]


def _turns(conversations: DataFrame) -> DataFrame:
    """Turns as (base, own, conv_id, turn, digest, size, h); texts go no further."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        # the role's length keeps role and text apart
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.length(text).cast("bigint").alias("size"),
    ).where("conv_id IS NOT NULL")
    return rows.selectExpr(
        f"conv_id - conv_id % {HUNDRED} AS base", f"conv_id % {HUNDRED} <> 0 AS own", "conv_id", "turn", "digest", "size",
        f"cast(crc32(cast(cast(conv_id AS string) AS binary)) % {OPENING} AS int) AS h",
    )


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns to rows of CHAIN, a row for each prefix of each rebuilt conversation, the empty one included."""
    names = [part.split()[0] for part in CHAIN.split(", ")]
    base = conv = None
    opening: list[tuple[bytes, int]] = []  # of the base, OPENING - 1 turns at most
    out: list[tuple] = []
    waiting: list = []  # the last prefix of the conversation so far, by which another may follow
    seen = h = 0

    def grown(digest: bytes, size: int) -> None:
        _, depth, _, _, one, two, _ = waiting
        node = hashlib.sha256(struct.pack("<qq", one, two) + digest).digest()
        out.append((*waiting, False))
        waiting[:] = [conv, depth + 1, one, two, *struct.unpack("<qq", node[:16]), size]

    for row in chain.from_iterable(zip(*(c.to_pylist() for c in b.columns)) for b in batches):
        group, own, i, digest, size, most = row
        if i != conv:
            if waiting:
                out.append((*waiting, True))
            if group != base:
                base, opening = group, []
            conv, seen, h = i, 0, most
            waiting = [i, 0, None, None, *struct.unpack("<qq", ROOT), 0]
            if own:
                for turn in opening[:h]:
                    grown(*turn)
            # the base starts with its own turns, whatever its h
        seen += 1
        if not own:
            if len(opening) < OPENING - 1:
                opening.append((digest, size))
            grown(digest, size)
        elif seen > h:
            grown(digest, size)
        if len(out) > 8192:
            yield _batch(out, names)
            out = []
    if waiting:
        out.append((*waiting, True))
    if out:
        yield _batch(out, names)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    types = [pa.int64()] * 7 + [pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def _cells(width: int) -> str:
    """SQL for the counters of a digest, one in each row of the sketch, numbered from one."""
    return f"array(1L + pmod(h1, {width}L), 1L + {width}L + pmod(h2, {width}L))"


def sketch(chains: DataFrame, n: int) -> tuple[int, np.ndarray]:
    """(width, bits): the bit of each counter that is over one, of a count-min sketch of all digests but the root's.

    Counters are summed before and after their shuffle, so a digest that very many share costs a row per task.
    """
    width = 1 << 15
    while width < min(CELLS * n, MOST_CELLS):
        width *= 2
    counters = chains.where("depth > 0").selectExpr(f"explode({_cells(width)}) AS cell").groupBy("cell").count()
    blocks = counters.where("count > 1").groupBy(F.bitmap_bucket_number("cell").alias("block"))
    bits = np.zeros(SKETCH_ROWS * width // 8 + 4096, np.uint8)
    # at most SKETCH_ROWS * MOST_CELLS bits come here, whatever the input
    for block, part in blocks.agg(F.bitmap_construct_agg(F.bitmap_bit_position("cell"))).toLocalIterator():
        bits[(block - 1) * 4096 : block * 4096] = np.frombuffer(part, np.uint8)
    return width, bits


def _prover(width: int, shared):
    """Adds whether the sketch proves a prefix, and the prefix before it, to be of one conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value

        def once(one: pa.Array, two: pa.Array) -> np.ndarray:
            out = np.zeros(len(one), bool)
            for row, column in enumerate((one, two)):
                cell = column.fill_null(0).to_numpy(zero_copy_only=False) % width + row * width
                out |= (bits[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 0
            return out

        for batch in batches:
            deep = batch.column(1).to_numpy()
            alone = once(batch.column(4), batch.column(5)) & (deep > 0)
            before = once(batch.column(2), batch.column(3)) & (deep > 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(alone), pa.array(before)], [*batch.schema.names, "alone", "before"])

    return run


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted parts (h1, h2, least, ids) to (h1, h2, ends): a running hash per node, parts are not held."""
    node, running, out = None, None, []
    for h1, h2, _, ids in chain.from_iterable(zip(*(c.to_pylist() for c in b.columns)) for b in batches):
        if (h1, h2) != node:
            if node:
                out.append((*node, running.hexdigest()))
            node, running = (h1, h2), hashlib.sha256(ids.encode())
        else:
            running.update(b"," + ids.encode())
        if len(out) > 4096:
            yield _ends_batch(out)
            out = []
    if node:
        out.append((*node, running.hexdigest()))
    if out:
        yield _ends_batch(out)


def _ends_batch(rows: list[tuple]) -> pa.RecordBatch:
    h1, h2, ends = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(ends)], ["h1", "h2", "ends"])


def _join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (h1, h2, conv_id) to parts of IDS ids at most: (h1, h2, least, ids)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        h1, h2, ids = (c.to_numpy() for c in batch.columns)
        fresh = np.append(True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]))
        cuts = np.unique(np.concatenate([np.flatnonzero(fresh), np.arange(0, len(ids), IDS)]))
        texts = ids.astype("U20").tolist()
        joined = [",".join(texts[lo:hi]) for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), len(ids)])]
        yield pa.RecordBatch.from_arrays([pa.array(h1[cuts]), pa.array(h2[cuts]), pa.array(ids[cuts]), pa.array(joined)], ["h1", "h2", "least", "ids"])


def _ends(shared: DataFrame) -> DataFrame:
    """(h1, h2, ends): hash of the ids that end at each node. A hot node's ids are dealt out by range and joined there first."""
    rows = shared.where("last").select("h1", "h2", "conv_id")
    ranged = rows.repartitionByRange("h1", "h2", "conv_id").sortWithinPartitions("h1", "h2", "conv_id")
    parts = ranged.mapInArrow(_join_ids, "h1 bigint, h2 bigint, least bigint, ids string")
    dealt = parts.repartition("h1", "h2").sortWithinPartitions("h1", "h2", "least")
    return dealt.mapInArrow(_hash_ends, "h1 bigint, h2 bigint, ends string")


def _own_end() -> Column:
    """Hash of the ids that end at a node of one conversation."""
    return F.when(F.col("last"), F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(F.lit(NOTHING))


def trie(conversations: DataFrame) -> DataFrame:
    """A row per node: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256).

    Turns are ordered by ``turn``, null first, equal ones by a digest of role and text. A null role or
    text is empty. Rows without conv_id take no part. Repeated rows are repeated turns. An empty table
    has no nodes, not even a root. Other columns are not read.

    A hundred conversations pass through one task one turn at a time, since a digest rests on the
    one before; nothing of them is held but an opening of five digests. Groups are combined before each
    shuffle, and what joins a node's many members or children is one row of it, which adaptive execution can copy.
    """
    small_batches(conversations.sparkSession)
    turns = _turns(conversations).repartition("base")
    turns = turns.sortWithinPartitions("base", "own", "conv_id", F.col("turn").asc_nulls_first(), "digest")
    chains = turns.select("base", "own", "conv_id", "digest", "size", "h").mapInArrow(_chains, CHAIN)
    chains, n = materialise(chains, "prefix-chains")
    width, bits = sketch(chains, n)
    marked = chains.mapInArrow(_prover(width, conversations.sparkSession.sparkContext.broadcast(bits)), f"{CHAIN}, alone boolean, before boolean")
    marked, _ = materialise(marked, "prefixes")

    # nodes of one conversation by the sketch: all but the parent's name is known on the spot
    on_own = [
        "conv_id", "depth", "1L AS n_convs", "cast(NOT last AS bigint) AS n_children", "1L AS n_leaves", "0L AS saved_tokens",
    ]
    tails = marked.where("alone AND before").select(*map(F.expr, on_own), F.col("conv_id").alias("parent_conv_id"), _own_end().alias("ends_sha256"))
    heads = marked.where("alone AND NOT before").select(*map(F.expr, on_own), "up1", "up2", F.lit(False).alias("known"), _own_end().alias("ends_sha256"))

    # the others are grouped
    shared = marked.where("NOT alone")
    nodes = shared.groupBy("h1", "h2").agg(
        F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.min("up1").alias("up1"), F.min("up2").alias("up2"),
        F.count("*").alias("n_convs"), F.min("size").alias("size"), F.bool_and("before").alias("known"),
    )
    nodes, _ = materialise(nodes, "shared-nodes")
    edges = nodes.where("depth > 0 AND NOT known").select("up1", "up2").union(heads.select("up1", "up2"))
    children = edges.groupBy(F.col("up1").alias("h1"), F.col("up2").alias("h2")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, ["h1", "h2"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes, _ = materialise(nodes, "shared-nodes")

    # a node's own leaf and savings count at each prefix of its first member, and so once for each node above it
    own = nodes.selectExpr("conv_id", "depth", "(n_convs - 1) * size AS saved", "cast(n_children = 0 AS bigint) AS leaf")
    leaves = marked.where("alone AND last").selectExpr("conv_id", "depth", "0L AS saved", "1L AS leaf")
    given = own.where("saved > 0 OR leaf > 0").union(leaves).selectExpr("*", "cast(NULL AS bigint) AS h1", "cast(NULL AS bigint) AS h2")
    asked = shared.selectExpr("conv_id", "depth", "0L AS saved", "0L AS leaf", "h1", "h2")
    below = "OVER (PARTITION BY conv_id ORDER BY depth DESC)"
    summed = given.union(asked).selectExpr("h1", "h2", f"sum(saved) {below} AS saved", f"sum(leaf) {below} AS leaf")
    totals = summed.where("h1 IS NOT NULL").groupBy("h1", "h2").agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    grouped = nodes.join(totals, ["h1", "h2"]).join(_ends(shared), ["h1", "h2"], "left")
    grouped = grouped.select(
        "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "up1", "up2", "known",
        F.coalesce("ends", F.lit(NOTHING)).alias("ends_sha256"),
    )

    names = nodes.select(F.col("h1").alias("up1"), F.col("h2").alias("up2"), F.col("conv_id").alias("above"))
    named = grouped.unionByName(heads).join(names, ["up1", "up2"], "left")
    # below a node that the sketch proves to be of one conversation stands that conversation
    named = named.withColumn("parent_conv_id", F.when(F.col("known"), F.col("conv_id")).otherwise(F.col("above")))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return named.select(*columns).union(tails.select(*columns))
