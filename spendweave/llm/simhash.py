"""Near-duplicate documents: SimHash fingerprints linked by covering locality-sensitive hashing.

Each of the 64 bits gets a vector phi of R + 1 bits, not zero. For every non-zero vector v there
is a table, whose key is the fingerprint with those bits kept where <phi, v> is odd. The at most R
bits in which two linked fingerprints differ span at most R of R + 1 dimensions, so some v is
orthogonal to all of them: its table keeps none of the bits that differ, and there both have
the same key. No pair within the radius is missed, and there are only 2^(R+1) - 1 tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendweave.llm.batches import small_batches
from spendweave.llm.components import components
from spendweave.sources.store import materialise

#: Fingerprints link at so many differing bits at most.
RADIUS = 3
SHINGLE = 3
SEED = 42
#: A bucket of more fingerprints is dealt out again by a second covering of its free bits.
BUCKET = 2048
SECOND = 4


def masks(step: int = 0, radius: int = RADIUS) -> list[int]:
    """The bits that each table keeps. phi runs through the non-zero vectors in turn, in each turn from another start."""
    n = 2 ** (radius + 1) - 1
    phi = [1 + (bit * (1 + step) + bit // n * step) % n for bit in range(64)]
    return [sum(1 << bit for bit, p in enumerate(phi) if (p & v).bit_count() % 2) for v in range(1, n + 1)]


def fingerprint(text: str | None) -> int:
    """Majority vote of the shingles' hashes, bit by bit; 0 for a text without words."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z, only ASCII white space
    if not words:
        return 0
    n = max(1, len(words) - SHINGLE + 1)
    shingles = map(b" ".join, zip(*(words[k:] for k in range(SHINGLE)))) if n > 1 else [b" ".join(words[:SHINGLE])]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n)
    votes = np.zeros(64, np.int64)
    for lo in range(0, n, 4096):
        bits = np.unpackbits(hashes[lo : lo + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = np.fromiter((fingerprint(t.as_py()) for t in batch.column(1)), np.uint64, batch.num_rows)
        columns = [batch.column(0), pa.array(fp.view(np.int64)), *batch.columns[2:]]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "fp", *batch.schema.names[2:]])


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per bucket of distinct fingerprints, edges that connect exactly what its links connect."""
    for batch in batches:
        roots, ends = [], []
        for bucket in batch.column(0):
            left = np.array(bucket.as_py(), np.int64).view(np.uint64)
            while len(left) > 1:  # take a component from what is left
                root, front, left = left[0], left[:1], left[1:]
                while len(front) and len(left):
                    near = np.zeros(len(left), bool)
                    for f in front:
                        near |= np.bitwise_count(left ^ f) <= RADIUS
                    front, left = left[near], left[~near]
                    roots.append(np.full(len(front), root))
                    ends.append(front)
        if ends:
            u, v = (np.concatenate(x).view(np.int64) for x in (roots, ends))
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])


def _bucketed(fps: DataFrame, keys: str) -> tuple[DataFrame, DataFrame]:
    """Buckets of two and more up to BUCKET fingerprints, and the rows (fp, table, key) of larger ones."""
    rows = fps.selectExpr("*", f"inline({keys})")
    names = [c for c in rows.columns if c != "fp"]
    sizes = rows.groupBy(*names).agg(F.count("*").alias("n")).where("n > 1")
    sizes, _ = materialise(sizes, "bucket-sizes")
    few = rows.join(sizes.where(f"n <= {BUCKET}").drop("n"), names, "left_semi")
    many = rows.join(sizes.where(f"n > {BUCKET}").drop("n"), names, "left_semi")
    return few.groupBy(*names).agg(F.collect_list("fp").alias("fps")), many


def _keys(kept: list[int], table: str, key: str) -> str:
    """SQL for an array of (table, key); a key keeps the bits of its mask."""
    signed = [m - (1 << 64) if m >> 63 else m for m in kept]
    parts = [f"named_struct('{table}', {i}, '{key}', fp & {m}L)" for i, m in enumerate(signed)]
    return f"array({', '.join(parts)})"


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", place: str | None = None) -> DataFrame:
    """(doc_id, fp, component_id, label) per row of ``docs``; the component is the smallest doc_id reachable by links.

    ``label``, a fingerprint, tells components apart also where ids repeat or are null. ``place``
    names a BIGINT column of ``docs`` that comes back with each row, as ``place``.

    Equal fingerprints meet as one before any pairing, so copies cost nothing beyond their
    row. Only tables' buckets are searched, and a bucket gives as many edges as connect its
    fingerprints, not its pairs. A bucket of more than BUCKET fingerprints is dealt out by a
    second covering, in which its linked pairs meet again. Keys of both coverings leave 22
    bits free at most, mostly 15: that bounds the distinct fingerprints of a bucket, whatever the data.

    A text that is null, empty or without words has fingerprint zero and links like any other.
    Rows without doc_id get the component of their fingerprint too, and never name one;
    it is null where no row of the component has an id. Repeated rows repeat. Other columns of
    ``docs`` are not read.
    """
    small_batches(docs.sparkSession)
    told = [F.col(f"`{place}`").cast("bigint").alias("place")] if place else []
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"), *told)
    rows = rows.withColumn("doc_id", F.col("doc_id").cast("bigint"))
    kept = "doc_id bigint, fp bigint" + (", place bigint" if place else "")
    rows, _ = materialise(rows.mapInArrow(_fingerprints, kept), "fingerprints")
    classes, _ = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprint-classes")
    fps = classes.select("fp")
    few, many = _bucketed(fps, _keys(masks(), "t", "k"))
    finer = many.selectExpr("*", f"inline({_keys(masks(SECOND), 't2', 'k2')})")
    finer = finer.groupBy("t", "k", "t2", "k2").agg(F.collect_list("fp").alias("fps")).where("size(fps) > 1")
    buckets = few.select("fps").union(finer.select("fps"))
    edges = buckets.mapInArrow(_links, "u bigint, v bigint").distinct()
    labels = components(edges).withColumnsRenamed({"node": "fp", "component": "label"})
    labelled = classes.join(labels, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    named = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    return rows.join(labelled.join(named, "label").select("fp", "component_id", "label"), "fp")


def digest(linked: DataFrame) -> DataFrame:
    """With the fingerprint in hexadecimal."""
    return linked.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
