"""Exact removal of repeated 100-byte strings, by run-length indexes over candidate shards.

A string of WIDTH bytes has an anchor: of its K-byte pieces the one with the smallest hash, the leftmost
of several. Equal strings have equal anchors at equal places, so strings are compared only among
those of one anchor. The strings of a document that have the same anchor piece overlap and make one
segment of less than 2 WIDTH bytes.

1. Segments meet by anchor, as hashes. Of equal segments the first stays, and the strings of all others are repeats.
   What repeats within a task's batch is known before it is dealt out, so that copies do not crowd at their anchor.
2. Segments that share an anchor but differ, mostly around the ends of repeats, send their
   bytes, one copy of each, to shards by the anchor and the SIDE bytes before or behind it, one of which any two
   equal strings share as well. So a short text that is everywhere draws nothing together.
3. A shard builds a Burrows-Wheeler transform of its segments as runs, with the places of run ends, and streams
   the segments backwards through it. The row that the stream reaches says to which match of WIDTH bytes a
   string belongs; strings whose match has an earlier member are repeats.
4. The strings found are laid over the documents' bytes.

A key with more bytes than a shard takes is cut; what then is first in its part goes
through a grouped minimum by the string's 128-bit hash, so that no group has to fit anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendweave.llm.batches import small_batches
from spendweave.sources.store import materialise

#: A string of so many bytes that also starts earlier is removed.
WIDTH = 100
#: Bytes of an anchor.
K = 16
#: Of the bytes beside its anchor a string holds so many before, or else as many behind.
SIDE = (WIDTH - K) // 2
#: A shard is closed at so many bytes.
SHARD_BYTES = 2 << 20
#: Documents of at most so many bytes are scanned together; longer ones in steps of as many strings.
TOGETHER = 1 << 20

_KNOWN = 128  # in the place of an anchor, which is less: the segment is known to be a repeat
_LAST = 0x7FFFFFFFFFFFFFFF
_PLACE = np.uint64((1 << 24) - 1)


def _hashes(points: np.ndarray) -> np.ndarray:
    """A mixed 64-bit hash of the K bytes from each place."""
    h, width = points.astype(np.uint64) + np.uint64(1), 1
    while width < K:
        h = h[:-width] * np.uint64(pow(0x9E3779B97F4A7C15, width, 1 << 64)) + h[width:]
        width *= 2
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ h >> np.uint64(29)


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    n = 1
    while 2 * n <= width:
        x = np.minimum(x[:-n], x[n:])
        n *= 2
    return np.minimum(x[: len(x) - (width - n)], x[width - n :]) if n < width else x


def segments(points: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts laid end to end: anchor hash, first string, strings and place of the anchor, for each segment."""
    none = (np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3)))
    if len(points) < WIDTH:
        return none
    h = _hashes(points)
    least = _sliding_least((h & ~_PLACE) | np.arange(len(h), dtype=np.uint64), WIDTH - K + 1)
    anchor = (least & _PLACE).astype(np.int64)
    within = np.ones(len(anchor), bool)
    for end in ends.tolist():  # strings do not cross texts
        within[max(0, end - WIDTH + 1) : end] = False
    starts = np.flatnonzero(within)
    if not len(starts):
        return none
    new = np.concatenate([[True], (np.diff(starts) != 1) | (np.diff(anchor[starts]) != 0)])
    first = starts[new]
    n = np.diff(np.append(np.flatnonzero(new), len(starts)))
    place = anchor[first]
    return h[place], first, n, place - first


def _combined(rows: np.ndarray) -> np.ndarray:
    """Segments with those marked that repeat another one here: they need not meet their anchor, and so are spread."""
    order = np.lexsort(rows[::-1])
    rows = rows[:, order]
    new = np.concatenate([[True], (rows[:2, 1:] != rows[:2, :-1]).any(axis=0)])[: rows.shape[1]]
    lead = rows[2:, np.maximum.accumulate(np.where(new, np.arange(rows.shape[1]), 0))]
    later = (rows[2:] != lead).any(axis=0)
    rows[4, later] |= _KNOWN
    rows[0, later] = _mixed(rows[:, later])
    return rows


def _mixed(rows: np.ndarray) -> np.ndarray:
    """A mixed number for each column."""
    mixed = rows[2].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + rows[4].astype(np.uint64)
    mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(0xD6E8FEB86659FD93)
    return (mixed ^ mixed >> np.uint64(32)).view(np.int64)


def _anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, tie, text) to (anchor, content, doc, tie, at); at packs first string, strings and anchor's place, marked if known to repeat."""
    for batch in batches:
        docs, ties = (batch.column(i).to_numpy() for i in (0, 1))
        todo: list[tuple[int, int, bytes]] = []  # row, offset, piece
        size = 0

        def flushed() -> pa.RecordBatch:
            raw = b"".join(piece for _, _, piece in todo)
            ends = np.cumsum([len(piece) for _, _, piece in todo])
            anchor, first, n, place = segments(np.frombuffer(raw, np.uint8), ends)
            content = np.fromiter(
                (xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(first.tolist(), (first + n + WIDTH - 1).tolist())),
                np.uint64, len(first),
            )
            of = np.searchsorted(ends, first, "right")
            row = np.array([r for r, _, _ in todo], np.int64)[of]
            shift = np.array([o - (e - len(p)) for (_, o, p), e in zip(todo, ends.tolist())], np.int64)[of]
            at = (first + shift) << 16 | n << 8 | place
            columns = _combined(np.stack([anchor.view(np.int64), content.view(np.int64), docs[row], ties[row], at]))
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "content", "doc", "tie", "at"])

        for r, text in enumerate(batch.column(2)):
            raw = (text.as_py() or "").encode()
            for lo in range(0, max(len(raw) - WIDTH + 1, 0), TOGETHER):
                piece = raw[lo : lo + TOGETHER + WIDTH - 1]
                if todo and size + len(piece) > 2 * TOGETHER:
                    yield flushed()
                    todo, size = [], 0
                todo.append((r, lo, piece))
                size += len(piece)
        if todo:
            yield flushed()


def _first_of_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From segments sorted by anchor, content and place: those that repeat an earlier equal one, with a
    null anchor, and the first ones of anchors with several contents. Holds one row between batches."""
    names = ["doc", "tie", "at", "anchor"]
    first = None  # first segment of the content that is open
    held = None  # first segment of the anchor that is open, as long as it has one content
    for batch in batches:
        if not batch.num_rows:
            continue
        anchor, content, doc, tie, at = (batch.column(i).to_numpy() for i in range(5))
        rows = np.stack([anchor, content, doc, tie, at])
        known = rows[4] & _KNOWN > 0
        if known.any():
            passed = rows[2:, known]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c) for c in (passed[0], passed[1], passed[2] & ~_KNOWN)), pa.nulls(known.sum(), pa.int64())], names
            )
            rows = rows[:, ~known]
            if not rows.shape[1]:
                continue
        if first is not None:  # what is open goes before this batch
            rows = np.concatenate([first[:, None], rows], axis=1)
        new_anchor = np.concatenate([[True], rows[0, 1:] != rows[0, :-1]])
        new = new_anchor | np.concatenate([[True], rows[1, 1:] != rows[1, :-1]])
        opened = np.maximum.accumulate(np.where(new, np.arange(rows.shape[1]), 0))
        lead = rows[:, opened]
        later = (rows[2:] != lead[2:]).any(axis=0)
        heads = np.flatnonzero(new)
        # several heads in an anchor: all of them are to be compared
        alone = np.append(new_anchor[heads][1:], True) & new_anchor[heads]
        if first is not None:
            # the first head was a head before: it is out already unless it is held
            alone[0] = held is None or alone[0]
        out = [rows[2:, later], rows[2:, heads[~alone]]]
        kinds = [np.full(later.sum(), True), np.full((~alone).sum(), False)]
        anchors = [np.zeros(later.sum(), np.int64), rows[0, heads[~alone]]]
        last = heads[-1]
        held = rows[:, last] if alone[-1] and (len(heads) > 1 or first is None or held is not None) else None
        first = rows[:, last]
        joined = np.concatenate(out, axis=1)
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(c) for c in joined), pa.array(np.concatenate(anchors), mask=np.concatenate(kinds))], names
        )


@dataclass
class RunIndex:
    """Burrows-Wheeler transform of segments, each closed by an end of its own, as runs.

    A row is a suffix. Only runs are kept: their first rows and symbols, how often the symbol was seen before,
    and the place of the suffix at the end of a run where it begins. ``matches`` are the rows where a suffix shares less
    than WIDTH symbols with the one before.
    """

    starts: np.ndarray
    symbols: np.ndarray
    seen: np.ndarray
    run_place: np.ndarray
    matches: np.ndarray
    less: np.ndarray
    rows: int

    @classmethod
    def build(cls, pieces: list[bytes]) -> RunIndex:
        lengths = np.array([len(p) for p in pieces], np.int64)
        ends = (lengths + 1).cumsum() - 1
        text = np.frombuffer(b"\0".join([*pieces, b""]), np.uint8).astype(np.int64) + 1  # 0xFF is in no UTF-8
        text[ends] = 0
        order, matches = suffix_order(text)
        before = text[order - 1]
        starts = np.flatnonzero(np.concatenate([[True], before[1:] != before[:-1]]))
        symbols, sizes = before[starts], np.diff(np.append(starts, len(text)))
        by = np.argsort(symbols, kind="stable")
        total = sizes[by].cumsum() - sizes[by]
        fresh = np.concatenate([[True], np.diff(symbols[by]) != 0])
        seen = np.empty(len(starts), np.int64)
        seen[by] = total - np.maximum.accumulate(np.where(fresh, total, 0))
        counts = np.bincount(text, minlength=258)
        return cls(
            starts, symbols, seen, order[starts], matches, counts.cumsum() - counts, len(text)
        )

    def stream(self, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Backward through all segments at once: (segments, places in them, matches) of whole strings.

        A stream starts at the row of its segment's end. Each step finds the run of the row, and so
        the symbol before and its row. At a sampled run end the kept place has to be where the stream is.
        """
        ends = (lengths + 1).cumsum() - 1
        rows, left, open_ = np.arange(len(lengths)), lengths.copy(), np.arange(len(lengths))
        for step in range(int(lengths.max(initial=0)) + 1):
            run = np.searchsorted(self.starts, rows, "right") - 1
            at_start = rows == self.starts[run]
            if (self.run_place[run[at_start]] != (ends[open_] - step)[at_start]).any():
                raise AssertionError("the stream has left its segment")
            if step >= WIDTH:  # what is nearer to the end starts no whole string
                yield open_, left[open_] - step, np.searchsorted(self.matches, rows, "right") - 1
            going = left[open_] > step
            rows = (self.less[self.symbols[run]] + self.seen[run] + rows - self.starts[run])[going]
            open_ = open_[going]


def suffix_order(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and the rows that share less than WIDTH symbols with the row before.

    Zeros end segments; they differ and rank by place. Ranks of 8 symbols are doubled, and only
    suffixes that still have equals are sorted again.
    """
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.int64)]).astype(np.uint64)
    key, over = np.zeros(n, np.uint64), np.zeros(n, bool)
    for k in range(8):  # nothing behind an end counts
        key = key << np.uint64(8) | np.where(over, np.uint64(0), padded[k : n + k])
        over |= padded[k : n + k] == 0
    order = np.argsort(key)
    sorted_key, ended = key[order], over[order]
    level = np.flatnonzero(ended & (np.append(sorted_key[1:] == sorted_key[:-1], False) | np.append(False, sorted_key[1:] == sorted_key[:-1])))
    order[level] = order[level][np.lexsort((order[level], sorted_key[level]))]  # ended ones by place
    new = np.concatenate([[True], (sorted_key[1:] != sorted_key[:-1]) | ended[1:] | ended[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))  # first row of a suffix's equals
    width, low, rest = 8, rank, 0
    while True:
        if width <= WIDTH < 2 * width:  # WIDTH symbols are equal if so many are at two places
            low, rest = rank.copy(), WIDTH - width
        tied = np.flatnonzero(~new | np.append(~new[1:], False))
        if not len(tied):
            break
        suffixes = order[tied]
        second = rank[suffixes + width]
        by = np.argsort(rank[suffixes] * n + second)
        order[tied] = suffixes = suffixes[by]
        second, group = second[by], rank[suffixes]
        new[tied] |= np.concatenate([[True], (group[1:] != group[:-1]) | (second[1:] != second[:-1])])
        rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        width *= 2
    if not rest and WIDTH > 8 and width <= WIDTH:
        low = rank  # all suffixes differ before that
    a, b = order[:-1], order[1:]
    same = (low[a] == low[b]) & (low[np.minimum(a + rest, n - 1)] == low[np.minimum(b + rest, n - 1)])
    return order, np.flatnonzero(np.concatenate([[True], ~same]))


def repeated(pieces: list[bytes]) -> list[np.ndarray]:
    """Per segment, which of its strings an earlier place of the shard starts too."""
    index = RunIndex.build(pieces)
    lengths = np.array([len(p) for p in pieces], np.int64)
    offsets = (lengths + 1).cumsum() - lengths - 1
    match = np.full(index.rows, -1, np.int64)
    for which, place, at in index.stream(lengths):
        match[offsets[which] + place] = at
    places = np.flatnonzero(match >= 0)
    first = np.full(len(index.matches), index.rows, np.int64)
    np.minimum.at(first, match[places], places)
    again = np.zeros(index.rows, bool)
    again[places] = first[match[places]] < places
    return [again[o : o + max(n - WIDTH + 1, 0)] for o, n in zip(offsets.tolist(), lengths.tolist())]


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as compressed bytes, to travel twice."""
    packer = zstd.ZstdCompressor(level=3)
    for batch in batches:
        packed = [packer.compress((t.as_py() or "").encode()) for t in batch.column(2)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(packed, pa.binary())], ["doc", "tie", "packed"]
        )


def sides(raw: bytes, at: int) -> Iterator[tuple[int, int, bytes]]:
    """(key, at, bytes) of a segment's strings that hold the SIDE bytes before its anchor, and of the others, which
    hold those behind it. Equal strings lie on one side of equal anchors and so have equal keys."""
    first, n = at >> 16, at >> 8 & 255
    anchor = first + (at & 255)
    n_before = min(n, max(anchor - SIDE - first + 1, 0))
    if n_before:
        key = xxhash.xxh3_64_intdigest(raw[anchor - SIDE : anchor + K], 0)
        yield key, first << 16 | n_before << 8, raw[first : first + n_before + WIDTH - 1]
    if n_before < n:
        start = first + n_before
        key = xxhash.xxh3_64_intdigest(raw[anchor : anchor + K + SIDE], 1)
        yield key, start << 16 | (n - n_before) << 8, raw[start : first + n + WIDTH - 1]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the segments that are to be compared, by side."""
    reader = zstd.ZstdDecompressor()
    for batch in batches:
        for row in batch.to_pylist():
            raw = reader.decompress(row["packed"])
            made = [x for at in row["found"] for x in sides(raw, at)]
            keys, ats, pieces = zip(*made) if made else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.array(keys, np.uint64).view(np.int64)),
                    pa.array([row["doc"]] * len(made), pa.int64()),
                    pa.array([row["tie"]] * len(made), pa.int64()),
                    pa.array(ats, pa.int64()),
                    pa.array(pieces, pa.binary()),
                ],
                ["key", "doc", "tie", "at", "segment"],
            )


def _compare(shard_bytes: int):
    """Segments sorted by key and place to the repeats among them, as (doc, tie, at, null).

    Nothing is compared to a segment that is alone with its key, and of equal segments only the first is
    indexed. Of a key with more bytes than a shard takes, what is first in its part also comes, string by string, with its hash.
    """

    def listed(rows: list[tuple[int, int, int, bytes | None]]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        columns = zip(*rows) if rows else [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(columns, kinds)], ["doc", "tie", "at", "hash"])

    def judged(rows: list[tuple], part: bool) -> pa.RecordBatch:
        out = []
        for (_, doc, tie, at, piece), again in zip(rows, repeated([r[4] for r in rows])):
            edges = np.flatnonzero(np.diff(np.concatenate([[False], again, [False]])))
            for lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist()):
                out.append((doc, tie, (at >> 16) + lo << 16 | hi - lo << 8, None))
            for k in np.flatnonzero(~again).tolist() if part else ():
                digest = xxhash.xxh3_128_digest(piece[k : k + WIDTH])
                out.append((doc, tie, (at >> 16) + k << 16 | 1 << 8, digest))
        return listed(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, size = [], 0  # whole keys
        key, group, seen, group_size, parts = None, [], set(), 0, False
        for batch in batches:
            equal = []
            for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if row[0] != key:
                    if parts and group:
                        yield judged(group, True)
                    elif len(group) > 1:
                        shard += group
                        size += group_size
                        if size >= shard_bytes:
                            yield judged(shard, False)
                            shard, size = [], 0
                    key, group, seen, group_size, parts = row[0], [], set(), 0, False
                if row[4] in seen:
                    equal.append((row[1], row[2], row[3], None))
                    continue
                group.append(row)
                seen.add(row[4])
                group_size += len(row[4])
                if group_size >= shard_bytes:
                    yield judged(group, True)
                    group, seen, group_size, parts = [], set(), 0, True
            if equal:
                yield listed(equal)
        if parts and group:
            yield judged(group, True)
        elif len(group) > 1:
            shard += group
        if shard:
            yield judged(shard, False)

    return run


def _laid_over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    reader = zstd.ZstdDecompressor()
    for batch in batches:
        out = []
        for doc, found, packed in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            raw = reader.decompress(packed.as_py())
            at = np.sort(found.values.to_numpy()) if found.is_valid else np.zeros(0, np.int64)
            first, n = at >> 16, at >> 8 & 255
            gone = np.zeros(len(raw) + 1, np.int32)
            np.add.at(gone, first, 1)
            np.add.at(gone, first + n + WIDTH - 1, -1)
            gone = gone.cumsum()[: len(raw)] > 0
            kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
            spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(raw) else 0
            out.append((doc, len(raw), int(gone.sum()), spans, kept))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
        )


SEGMENTS = "anchor bigint, content bigint, doc bigint, tie bigint, at bigint"
KEPT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) per row: the bytes left when all that repeats is gone.

    A byte goes if any string of WIDTH bytes over it also starts earlier, at a smaller doc_id or before
    in the same document. A null text has no bytes. Rows without doc_id come after all others. Rows that
    share a doc_id stand in one place if their texts are equal, so they do not repeat each other; else their
    texts' hash orders them. ``kept`` may not be UTF-8, since strings may end within a character. Other columns are
    not read. Equality is that of two 64-bit hashes for whole segments, and of the bytes in shards.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    doc = F.coalesce("doc_id", F.lit(_LAST))
    shared = rows.select(doc.alias("doc")).groupBy("doc").count().where("count > 1").limit(1).count()
    tie = F.xxhash64(F.coalesce("text", F.lit(""))) if shared else F.lit(0).cast("bigint")
    placed = rows.select(doc.alias("doc"), tie.alias("tie"), "text")

    met = placed.mapInArrow(_anchored, SEGMENTS).repartition("anchor")
    met = met.sortWithinPartitions("anchor", "content", "doc", "tie", "at")
    found, _ = materialise(met.mapInArrow(_first_of_each, "doc bigint, tie bigint, at bigint, anchor bigint"), "segments")

    packed = placed.mapInArrow(_pack, "doc bigint, tie bigint, packed binary")
    differing = found.where("anchor IS NOT NULL").groupBy("doc", "tie").agg(F.collect_set("at").alias("found"))
    once = packed.dropDuplicates(["doc", "tie"]) if shared else packed
    cut = once.join(differing, ["doc", "tie"]).mapInArrow(_cut, "key bigint, doc bigint, tie bigint, at bigint, segment binary")
    cut = cut.repartition("key").sortWithinPartitions("key", "doc", "tie", "at")
    compared, _ = materialise(cut.mapInArrow(_compare(shard_bytes), "doc bigint, tie bigint, at bigint, hash binary"), "compared")
    single = compared.where("hash IS NOT NULL")
    first = single.groupBy("hash").agg(F.min(F.struct("doc", "tie", "at")).alias("first"))
    late = single.join(first, "hash").where("struct(doc, tie, at) > first")

    repeats = (
        found.where("anchor IS NULL").select("doc", "tie", "at")
        .union(compared.where("hash IS NULL").select("doc", "tie", "at"))
        .union(late.select("doc", "tie", "at"))
    )
    repeats = repeats.groupBy("doc", "tie").agg(F.collect_set("at").alias("found"))
    laid = packed.join(repeats, ["doc", "tie"], "left").select("doc", "found", "packed").mapInArrow(_laid_over, KEPT)
    return laid.withColumn("doc_id", F.when(F.col("doc_id") < _LAST, F.col("doc_id")))


def digest(kept: DataFrame) -> DataFrame:
    """With the hash of what is left."""
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
