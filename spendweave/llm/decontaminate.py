"""Benchmark passages in documents: q-gram lemma filter, then banded alignment.

An item of m characters that occurs in a text with at most e edits shares m + 1 - q - q e of its
q-grams with it, all of them on e + 1 neighbouring diagonals (place in the text less place in the
item). Shared q-grams are counted in bands of 2 (e + 1) diagonals that overlap by half,
so that one band holds all of them. Bands that reach the bound are aligned, and only alignment decides.

Texts and items are compared in lower case, with each run of white space as one space.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendweave.llm.batches import small_batches

Q = 8
#: Edits per character of an item.
EDITS = 0.1
#: Items below are found only where they occur without any edit.
LEAST_CHARS = 24
#: Bands of an item with more than MANY in a text are first held to the lemma for shorter q-grams, which asks for more.
SHORT_Q, MANY = 4, 16
#: So many (place in the text, place in an item) pairs are held at once, also where all texts and items share a phrase.
TOGETHER_HITS = 1 << 22
#: Items are broadcast in blocks of at most so many bytes; each block is searched in all texts.
BLOCK_BYTES = 8 << 20
#: Texts of at most so many code points are searched together.
TOGETHER = 1 << 20

LEAKS = "array<struct<item_id:bigint,start:int,stop:int,edits:int>>"
_SLOTS = 1 << 21
_FAR = 1 << 40  # cost of one edit; below it there is room for a place


@lru_cache(1)
def _folding() -> np.ndarray:
    """Lower-case code points; 0 for white space."""
    chars = [chr(c) for c in range(sys.maxunicode + 1)]
    return np.array(
        [0 if c.isspace() else ord(low) if len(low := c.lower()) == 1 else ord(c) for c in chars], np.uint32
    )


def fold(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Comparable code points of a text, and where each was."""
    points = _folding()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    blank = points == 0
    kept = np.flatnonzero(~(blank & np.concatenate([[True], blank[:-1]])) if len(blank) else blank)
    out = points[kept]
    out[out == 0] = 32
    return out, kept


def qgrams(points: np.ndarray, q: int = Q) -> np.ndarray:
    """A 64-bit hash of the ``q`` code points, a power of two, from each place, by doubling."""
    h, width = points.astype(np.uint64), 1
    while width < q:
        factor = np.uint64(pow(0x9E3779B97F4A7C15, width, 1 << 64))
        h = h[:-width] * factor + h[width:] if len(h) > width else h[:0]
        width *= 2
    return h


@dataclass
class Index:
    """Items, and the places of their q-grams sorted by hash."""

    ids: list[int]
    items: list[np.ndarray]
    edits: np.ndarray  # budget of each item
    least: np.ndarray  # shared q-grams that it asks for
    hashes: np.ndarray  # distinct, sorted
    first: np.ndarray  # of each hash's places
    item: np.ndarray
    place: np.ndarray
    present: np.ndarray  # by the top bits of a hash
    short: dict[int, list[int]]  # items below Q by their length


def index(items: list[tuple[int, str]], edits: float = EDITS) -> Index:
    folded = [(i, points) for i, text in items if len(points := fold(text.strip())[0])]
    lengths = np.array([len(p) for _, p in folded], np.int64)
    # a budget that leaves the lemma at least one q-gram
    budget = np.minimum((lengths * edits).astype(np.int64), (lengths - Q) // Q)
    budget[lengths < LEAST_CHARS] = 0
    short: dict[int, list[int]] = {}
    for k in np.flatnonzero(lengths < Q).tolist():
        short.setdefault(int(lengths[k]), []).append(k)
    hashes = [qgrams(p) for _, p in folded]
    every = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    item = np.repeat(np.arange(len(folded)), [len(h) for h in hashes])
    place = np.concatenate([np.arange(len(h)) for h in hashes]) if hashes else np.zeros(0, np.int64)
    order = np.argsort(every, kind="stable")
    distinct, first = np.unique(every[order], return_index=True)
    present = np.zeros(1 << 22, bool)
    present[distinct >> np.uint64(42)] = True
    return Index(
        [i for i, _ in folded], [p for _, p in folded], budget, lengths + 1 - Q - Q * budget,
        distinct, np.append(first, len(every)), item[order], place[order], present, short,
    )


def candidates(points: np.ndarray, own: Index) -> np.ndarray:
    """Rows (item, first diagonal of the band) of bands that reach the item's bound, by item and place.

    Shared q-grams are counted for so many items at once as stay within TOGETHER_HITS, and for an item that has
    more by itself in overlapping windows of the text.
    """
    h = qgrams(points)
    at = np.flatnonzero(own.present[h >> np.uint64(42)])
    slot = np.searchsorted(own.hashes, h[at])
    same = own.hashes[np.minimum(slot, len(own.hashes) - 1)] == h[at] if len(own.hashes) else np.zeros(0, bool)
    at, slot = at[same], slot[same]
    if (own.first[slot + 1] - own.first[slot]).sum() <= TOGETHER_HITS:
        return _bands(at, slot, own, np.arange(len(own.place)), own.first)
    hits = np.bincount(slot, minlength=len(own.hashes))
    each = np.bincount(own.item, np.repeat(hits, np.diff(own.first)), len(own.items)).astype(np.int64)
    out, low, total = [], 0, each.cumsum()
    while low < len(own.items):
        before = total[low] - each[low]
        high = max(int(np.searchsorted(total, before + TOGETHER_HITS, "right")), low + 1)
        places = np.flatnonzero((own.item >= low) & (own.item < high))
        first = np.searchsorted(places, own.first)
        near = np.flatnonzero(first[slot + 1] > first[slot])
        if total[high - 1] - before <= TOGETHER_HITS:
            out.append(_bands(at[near], slot[near], own, places, first))
        else:
            overlap = len(own.items[low]) + 4 * (int(own.edits[low]) + 1)
            step = max(TOGETHER_HITS // len(places), overlap)
            for start in range(0, len(h), step):
                a, b = np.searchsorted(at[near], [start, start + step + overlap])
                out.append(_bands(at[near[a:b]], slot[near[a:b]], own, places, first))
        low = high
    return np.unique(np.concatenate(out), axis=0)


def _bands(at: np.ndarray, slot: np.ndarray, own: Index, places: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Bands that reach their item's bound, for hits ``at`` of hash ``slot`` on ``places`` of the index."""
    n = first[slot + 1] - first[slot]
    # every place of every hit, one row each
    where = places[np.repeat(first[slot] - (n.cumsum() - n), n) + np.arange(n.sum())]
    item, diagonal = own.item[where], np.repeat(at, n) - own.place[where]
    half = own.edits[item] + 1
    low = diagonal // half
    # counts by a hash first, which can only be too high: most hits are chance and need no sorting
    slot = (item * 40503 + low) & (_SLOTS - 1)
    tally = np.bincount(slot, minlength=_SLOTS).astype(np.int32)
    around = tally + np.maximum(np.roll(tally, 1), np.roll(tally, -1))
    likely = np.flatnonzero(around[slot] >= own.least[item])
    item, low, place = item[likely], low[likely], own.place[where[likely]]
    # a q-gram of the item counts once in a band, however often the text repeats it
    order = np.lexsort((place, low, item))
    item, low, place = item[order], low[order], place[order]
    same = (item[1:] == item[:-1]) & (low[1:] == low[:-1]) & (place[1:] == place[:-1])
    once = np.concatenate([[True], ~same]) if len(item) else np.zeros(0, bool)
    key = item[once] * (1 << 40) + (low[once] + (1 << 39))
    keys, counts = np.unique(key, return_counts=True)
    if not len(keys):
        return np.zeros((0, 2), np.int64)
    # a band is a half and the next one; halves without hits are not listed
    after = np.zeros(len(keys), np.int64)
    joined = np.flatnonzero(keys[1:] == keys[:-1] + 1)
    after[joined] = counts[joined + 1]
    before = np.zeros(len(keys), np.int64)
    before[joined + 1] = counts[joined]
    items = keys >> 40
    low = (keys & ((1 << 40) - 1)) - (1 << 39)
    bound, half = own.least[items], own.edits[items] + 1
    forward = counts + after >= bound
    # a half whose band with the one before reaches the bound is found from there, if that has hits
    backward = ~forward & (before == 0) & (counts >= bound)
    found = forward | backward
    return np.stack([items[found], low[found] * half[found]], axis=1)


def align(item: np.ndarray, text: np.ndarray, first: int, budget: int) -> tuple[int, int, int] | None:
    """(edits, start, stop) of the best occurrence of an item on the band from ``first``, if within budget.

    Cells hold the cost and, below it, where the occurrence starts, so that ties take the earliest.
    """
    half = budget + 1
    low, width = first - budget, 2 * half + 2 * budget
    offsets = np.arange(width, dtype=np.int64)
    step = offsets * _FAR
    column = low + offsets
    padded = np.zeros(len(item) + width, np.int64) - 1
    lo, hi = max(low, 0), min(low + len(padded), len(text))
    if hi <= lo:
        return None
    padded[lo - low : hi - low] = text[lo:hi]
    cells = np.full(width + 1, 1 << 60, np.int64)  # and one that cannot be reached
    cells[:-1] = np.where((column >= 0) & (column <= len(text)), column, 1 << 60)
    now, paired = cells[:-1], np.empty(width, np.int64)
    for i, char in enumerate(item.tolist()):
        np.multiply(padded[i : i + width] != char, _FAR, out=paired)
        paired += now
        np.add(cells[1:], _FAR, out=now)  # a character of the item that the text lacks
        np.minimum(paired, now, out=now)
        now -= step
        np.minimum.accumulate(now, out=now)  # characters that only the text has
        now += step
        if i % 32 == 31 and now.min() // _FAR > budget:
            return None
    cells = now
    stops = len(item) + column
    cells = np.where((stops >= 0) & (stops <= len(text)), cells, 1 << 60)
    best = int(cells.argmin())
    cost, start = divmod(int(cells[best]), _FAR)
    return (cost, start, int(stops[best])) if cost <= budget else None


def _denser(bands: np.ndarray, joined: np.ndarray, own: Index) -> np.ndarray:
    """Bands that hold as many of an item's SHORT_Q-grams, each near its place, as an occurrence keeps."""
    items, first, n = np.unique(bands[:, 0], return_index=True, return_counts=True)
    if not (n > MANY).any():
        return bands
    grams, kept = qgrams(joined, SHORT_Q), np.ones(len(bands), bool)
    order = np.argsort(grams, kind="stable")
    ranked = grams[order]
    for item, a, count in zip(items.tolist(), first.tolist(), n.tolist()):
        if count <= MANY:
            continue
        budget, own_grams = int(own.edits[item]), qgrams(own.items[item], SHORT_Q)
        low = bands[a : a + count, 1] - budget
        width = 2 * (budget + 1) + 2 * budget
        shared = np.zeros(count, np.int64)
        ends = np.searchsorted(ranked, own_grams, "left"), np.searchsorted(ranked, own_grams, "right")
        for place, (left, right) in enumerate(zip(*map(np.ndarray.tolist, ends))):
            if left < right:
                there = order[left:right]
                # the next place of this gram at or behind the one where the band begins
                after = there[np.minimum(np.searchsorted(there, low + place), right - left - 1)] - (low + place)
                shared += (after >= 0) & (after < width)
        kept[a : a + count] = shared >= len(own.items[item]) + 1 - SHORT_Q * (budget + 1)
    return bands[kept]


def _short_hits(joined: np.ndarray, starts: np.ndarray, own: Index) -> dict[tuple[int, int], tuple[int, int, int]]:
    """First occurrence of each item below Q code points in each text, by (text, item)."""
    out: dict[tuple[int, int], tuple[int, int, int]] = {}
    for size, members in own.short.items():
        if len(joined) < size:
            continue
        spread = lambda p, n: sum(p[j : j + n].astype(np.uint64) * np.uint64(pow(0x9E3779B97F4A7C15, j + 1, 1 << 64)) for j in range(size))
        windows = spread(joined, len(joined) - size + 1)
        wanted = {k: int(spread(own.items[k], 1)[0]) for k in members}
        at = np.flatnonzero(np.isin(windows, np.array(sorted(set(wanted.values())), np.uint64)))
        for k in members:
            same = at[windows[at] == np.uint64(wanted[k])]
            same = same[(joined[same[:, None] + np.arange(size)] == own.items[k]).all(axis=1)]
            text, first = np.unique(np.searchsorted(starts, same, "right") - 1, return_index=True)
            for t, place in zip(text.tolist(), (same[first] - starts[text]).tolist()):
                out[t, k] = (0, place, place + size)
    return out


def leaks(texts: list[str], own: Index) -> list[list[dict]]:
    """Per text the best occurrence of each item in it, by item."""
    folded = [fold(t) for t in texts]
    gap = np.zeros(1, np.uint32)  # in no item
    joined = np.concatenate([x for points, _ in folded for x in (points, gap)]) if texts else gap
    starts = np.cumsum([0] + [len(p) + 1 for p, _ in folded])
    best = _short_hits(joined, starts, own)
    for item, first in _denser(candidates(joined, own), joined, own).tolist():
        budget, size = int(own.edits[item]), len(own.items[item])
        # a band may touch the text before or after
        low = int(np.searchsorted(starts, max(first - budget, 0), "right")) - 1
        high = int(np.searchsorted(starts, first + 2 * budget + 2 + size + budget, "right")) - 1
        for k in range(max(low, 0), min(high + 1, len(texts))):
            if best.get((k, item), (1,))[0] == 0:
                continue  # bands come by place, so a later one cannot be better
            hit = align(own.items[item], folded[k][0], first - int(starts[k]), budget)
            if hit and hit < best.get((k, item), (1 << 30, 0, 0)):
                best[k, item] = hit
    out: list[list[dict]] = [[] for _ in texts]
    for (k, item), (cost, start, stop) in sorted(best.items()):
        at = folded[k][1]
        last = int(at[stop - 1]) + 1 if stop > start else int(at[min(start, len(at) - 1)])
        out[k].append({"item_id": own.ids[item], "start": int(at[min(start, len(at) - 1)]), "stop": last, "edits": cost})
    return out


def _marker(items: list[tuple[int, str]], edits: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index(items, edits)
        kind = pa.list_(
            pa.struct([("item_id", pa.int64()), ("start", pa.int32()), ("stop", pa.int32()), ("edits", pa.int32())])
        )
        for batch in batches:
            last = batch.num_columns - 1
            texts, found, group, size = batch.column(last).to_pylist(), [], [], 0
            for text in texts:
                if size > TOGETHER:
                    found += leaks(group, own)
                    group, size = [], 0
                group.append(text or "")
                size += len(group[-1])
            found += leaks(group, own)
            columns = [batch.column(i) for i in range(last)] + [pa.array(found, kind)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:last], "leaks"])

    return run


def _blocks(items: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[int, str]]]:
    """Items in blocks of BLOCK_BYTES at most; a longer item is a block of its own."""
    rows = items.select(F.col(f"`{item_id}`").cast("bigint").alias("i"), F.col(f"`{text}`").cast("string").alias("t"))
    block, size = [], 0
    for row in rows.where("t IS NOT NULL").distinct().toLocalIterator():
        n = len(row["t"].encode())
        if block and size + n > BLOCK_BYTES:
            yield block
            block, size = [], 0
        block.append((row["i"], row["t"]))
        size += n
    yield block


def mark(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    edits: float = EDITS,
) -> DataFrame:
    """``docs`` with ``leaks``: for each item that a text holds, its best occurrence and its edits.

    Of occurrences with equal edits the first counts; places are code points of the whole
    text. Every item is searched in every text; what is broadcast at once is a block of bounded
    size. Null and empty texts hold nothing. Items below LEAST_CHARS count where they occur without an edit, also
    inside words; blank items and those without text occur nowhere. An item without id is searched, and has none in the result; of items that
    share an id each text is searched. Rows repeat as given. A column ``leaks`` is
    replaced. No row is shuffled.
    """
    small_batches(docs.sparkSession)
    own = docs.drop("leaks", "_whole_text")
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields)
    parts = []
    for n, block in enumerate(_blocks(items, item_id, item_text)):
        fed = own.withColumn("_whole_text", F.col(f"`{text}`").cast("string"))
        carried = "".join(f", `_leaks{i}` {LEAKS}" for i in range(n))
        own = fed.mapInArrow(_marker(block, edits), f"{kept}{carried}, leaks {LEAKS}").withColumnRenamed("leaks", f"_leaks{n}")
        parts.append(f"_leaks{n}")
    return own.withColumn("leaks", F.expr(f"array_sort(concat({', '.join(parts)}))")).drop(*parts)


def digest(marked: DataFrame) -> DataFrame:
    """A row for each document and item in it."""
    return marked.selectExpr("doc_id", "inline(leaks)")
