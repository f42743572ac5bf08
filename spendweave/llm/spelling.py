"""Spelling variants: words one edit apart, each led to the common word that it is a form of.

Of two words one edit apart, the shorter of m code points, either the first m // 2 code points agree
or the last m - m // 2. So words meet in buckets of (m, what they share in front, what they share at
the end), and only their middles differ. The middles of a bucket that is too heavy are halved by the
same rule, again and again, until a middle is one code point; no pair is lost and none comes twice.

Within buckets, middles are a sorted list. Each word's banded edit matrix against the list has one row
per depth, and entries that share a prefix (as their adjacent LCPs tell) share its rows: a row is
computed once per range of entries, and a range whose prefix is already more than one edit away is
skipped. Ranges of many words and buckets are stepped together.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendweave.llm.native import text_of
from spendweave.sources.store import materialise

# What a run of letters is, and which words count.
LETTERS = r"[a-zÀ-ÿ]+"
LEAST_LENGTH = 7
LEAST_COUNT = 2
DELETE_EVERY = 31
#: A form is so many times as frequent as its variant.
RATIO = 10
#: Code points of the middles of a bucket; heavier ones are dealt out again.
BUCKET = 1 << 18
#: Code points that are scanned together, and the words among them that are matched at a time.
TOGETHER = 1 << 20
AT_ONCE = 1 << 14

KEYS = "h bigint, m int, a int, b int, head string, mid string, tail string, n bigint"
NEAR = "word string, n_near bigint, best_n bigint, best string"


def words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): runs of letters, every so many with one code point deleted, that are long and frequent enough.

    Null and empty texts have no words; a null doc_id is the empty string in what decides on a deletion.
    """
    lowered = F.translate(text_of(text), string.ascii_uppercase, string.ascii_lowercase)
    rows = docs.select(
        F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).alias("i"),
        F.regexp_extract_all(lowered, F.lit(LETTERS), F.lit(0)).alias("runs"),
    )
    runs = rows.select("i", F.explode(F.filter("runs", lambda r: F.length(r) >= LEAST_LENGTH)).alias("run"))
    hashed = runs.selectExpr("run", "crc32(cast(concat(i, ':', run) AS binary)) AS h")
    cut = f"""CASE WHEN h % {DELETE_EVERY} = 0
      THEN concat(substring(run, 1, cast(h % length(run) AS int)), substring(run, cast(h % length(run) AS int) + 2))
      ELSE run END AS word"""
    counted = hashed.selectExpr(cut).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(f"length(word) >= {LEAST_LENGTH} AND n >= {LEAST_COUNT}")


def _bucketed(parts: str, source: DataFrame) -> DataFrame:
    """Rows of KEYS from SQL for (m, a, b) per row of ``source``, which has ``word`` and ``n``."""
    rows = source.selectExpr("word", "n", f"inline({parts})")
    ends = rows.selectExpr(
        "m", "a", "b", "n", "substring(word, 1, a) AS head", "substring(word, a + 1, length(word) - a - b) AS mid",
        "substring(word, length(word) - b + 1, b) AS tail",
    )
    return ends.selectExpr("xxhash64(m, a, b, head, tail) AS h", "m", "a", "b", "head", "mid", "tail", "n")


def _halved(m: str, a: str, b: str) -> str:
    """SQL: the two buckets that take over from one."""
    mid = f"({m} - {a} - {b})"
    half = f"cast(floor({mid} / 2) AS int)"
    left = f"named_struct('m', {m}, 'a', {a} + {half}, 'b', {b})"
    return f"{left}, named_struct('m', {m}, 'a', {a}, 'b', {b} + {mid} - {half})"


def buckets(vocabulary: DataFrame, weight: int = BUCKET) -> DataFrame:
    """Rows of KEYS: each word in every bucket where it can meet a word one edit away.

    A word is in buckets for m of its own length and, as the longer word, of one less. Heavy buckets
    are found by one count per round; a middle halves per round, so rounds are few.
    """
    longer = f"CASE WHEN length(word) > {LEAST_LENGTH} THEN array({_halved('(length(word) - 1)', '0', '0')}) ELSE array() END"
    rows = _bucketed(f"concat(array({_halved('length(word)', '0', '0')}), {longer})", vocabulary)
    light = []
    while True:
        counts = rows.groupBy("h").agg(F.sum(F.length("mid") + 1).alias("w"), F.max(F.expr("m - a - b")).alias("middle"))
        heavy, n = materialise(counts.where(f"w > {weight} AND middle > 1").select("h"), "heavy-buckets")
        if not n:
            return _united([*light, rows])
        light.append(rows.join(heavy, "h", "left_anti").select(*rows.columns))
        again = rows.join(heavy, "h", "left_semi").selectExpr("concat(head, mid, tail) AS word", "n", "m AS m0", "a AS a0", "b AS b0")
        # the next round reads what this one wrote
        stored, _ = materialise(again, "split-buckets")
        rows = _bucketed_again(stored)


def _bucketed_again(source: DataFrame) -> DataFrame:
    parts = source.withColumn("to", F.expr(f"array({_halved('m0', 'a0', 'b0')})"))
    return _bucketed("to", parts)


def _united(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def _matrix(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of texts, a row each, filled up with zeros; and their lengths."""
    strings = texts.to_pylist()
    lengths = np.fromiter(map(len, strings), np.int64, len(strings))
    points = np.frombuffer("".join(strings).encode("utf-32-le"), np.uint32)
    out = np.zeros((len(strings), int(lengths.max(initial=0)) + 2), np.uint32)
    out[np.arange(out.shape[1]) < lengths[:, None]] = points
    return out, lengths


def one_edit_apart(points: np.ndarray, lengths: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (q, s) of rows of one bucket whose texts differ by one edit, in both directions.

    Rows are sorted within their bucket and distinct there; ``first`` marks the first of each.
    """
    n = len(lengths)
    lcp = np.full(n, -1)
    if n > 1:
        lcp[1:] = np.where(first[1:], -1, (points[1:] != points[:-1]).argmax(axis=1))
    opens = np.append(np.flatnonzero(first), n)
    of = np.cumsum(first) - 1
    low, high = opens[of], opens[of + 1]
    asked = np.flatnonzero(high - low > 1)
    found = []
    for at in range(0, len(asked), AT_ONCE):
        q = asked[at : at + AT_ONCE]
        s, e = low[q], high[q]
        # the band of the row at depth d: entries d - 1, d and d + 1; 2 stands for two edits and more
        band = [np.full(len(q), v, np.int8) for v in (2, 0, 1)]
        depth = 0
        while len(q):
            ended = lengths[s] == depth
            off = lengths[q] - depth
            last = np.select([off == -1, off == 0, off == 1], band, 2)
            hit = ended & (last == 1) & (s != q)
            found.append((q[hit], s[hit]))
            # the ranges one deeper, each with the next code point of its entries
            starts = np.append(np.flatnonzero(lcp <= depth), n)
            lo, hi = np.searchsorted(starts, s + ended), np.searchsorted(starts, e)
            many = hi - lo
            up = np.repeat(np.arange(len(q)), many)
            child = np.arange(len(up)) - np.repeat(np.cumsum(many) - many, many) + lo[up]
            q, s, e = q[up], starts[child], starts[child + 1]
            point = points[s, depth]
            left, mid, right = (x[up] for x in band)
            size, width = lengths[q], points.shape[1] - 1
            differs = [point != points[q, min(max(depth + k, 0), width)] for k in (-1, 0, 1)]
            one = np.minimum(left + differs[0], mid + 1)
            two = np.minimum(np.minimum(mid + differs[1], right + 1), one + 1)
            three = np.minimum(right + differs[2], two + 1)
            depth += 1
            band = [np.where(size >= depth + k, np.minimum(x, 2), 2).astype(np.int8) for k, x in zip((-1, 0, 1), (one, two, three))]
            # skip what is over one edit away already, and the word itself where it is alone
            keep = (np.minimum(np.minimum(*band[:2]), band[2]) <= 1) & ((s != q) | (e - s > 1))
            q, s, e, band = q[keep], s[keep], e[keep], [x[keep] for x in band]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))


def _near(rows: pa.Table) -> pa.RecordBatch | None:
    """Per word of whole buckets how many near words these hold, and the most frequent of them."""
    other = np.zeros(rows.num_rows - 1, bool)
    for name in ("h", "m", "a", "head", "tail"):  # hashes alone could agree by chance
        column = rows.column(name).combine_chunks()
        other |= pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
    first = np.append(True, other)
    alone = first & np.append(first[1:], True)
    if alone.all():
        return None
    rows, first = rows.filter(pa.array(~alone)), first[~alone]
    points, lengths = _matrix(rows.column("mid").combine_chunks())
    q, s = one_edit_apart(points, lengths, first)
    m, a, b = (rows.column(c).to_numpy() for c in "mab")
    least = np.minimum(lengths[q], lengths[s])
    good = least == (m - a - b)[q]  # two longer words meet in the buckets of their own length
    # where the shorter middle begins the longer one, the pair shares more in front, and has met there
    differ = np.zeros(len(q), np.int64)
    for lo in range(0, len(q), AT_ONCE):
        differ[lo : lo + AT_ONCE] = (points[q[lo : lo + AT_ONCE]] != points[s[lo : lo + AT_ONCE]]).argmax(axis=1)
    good &= (b[q] == 0) | (differ < least)
    q, s = q[good], s[good]
    if not len(q):
        return None
    whole = pc.binary_join_element_wise(*(rows.column(c).combine_chunks() for c in ("head", "mid", "tail")), "")
    rank = np.empty(len(whole), np.int64)
    rank[pc.sort_indices(whole).to_numpy()] = np.arange(len(whole))
    n = rows.column("n").to_numpy()
    order = np.lexsort((rank[s], -n[s], q))
    q, s = q[order], s[order]
    heads = np.flatnonzero(np.append(True, q[1:] != q[:-1]))
    counts = np.diff(np.append(heads, len(q)))
    columns = [whole.take(pa.array(q[heads])), pa.array(counts), pa.array(n[s[heads]]), whole.take(pa.array(s[heads]))]
    return pa.RecordBatch.from_arrays(columns, ["word", "n_near", "best_n", "best"])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of KEYS, cut between buckets into what is scanned together."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        # rows with their middles filled up to the longest are what a scan holds
        widths = pc.utf8_length(batch.column("mid")).to_numpy(zero_copy_only=False) + 2
        held.append(batch)
        size += int(widths.sum())
        if size < TOGETHER:
            continue
        rows = pa.Table.from_batches(held)
        whole = _whole(rows)
        for part in _parts(rows.slice(0, whole)):
            if (out := _near(part)) is not None:
                yield out
        rest = rows.slice(whole)
        held = rest.to_batches()
        size = int(pc.sum(pc.utf8_length(rest.column("mid"))).as_py() or 0) + 2 * rest.num_rows
    if held:
        for part in _parts(pa.Table.from_batches(held)):
            if (out := _near(part)) is not None:
                yield out


def _whole(rows: pa.Table) -> int:
    """Rows before the last bucket, which may go on."""
    h = rows.column("h").to_numpy()
    return int(np.count_nonzero(h != h[-1]))


def _parts(rows: pa.Table) -> Iterator[pa.Table]:
    """Runs of whole buckets whose filled-up middles stay near TOGETHER."""
    if not rows.num_rows:
        return
    h = rows.column("h").to_numpy()
    widths = pc.utf8_length(rows.column("mid")).to_numpy() + 2
    cuts = np.append(np.flatnonzero(np.append(True, h[1:] != h[:-1])), len(h)).tolist()
    tops = np.maximum.reduceat(widths, cuts[:-1]).tolist()
    lo, top = 0, 0
    for k, wide in enumerate(tops):
        if cuts[k] > lo and max(top, wide) * (cuts[k + 1] - lo) > 4 * TOGETHER:
            yield rows.slice(lo, cuts[k] - lo)
            lo, top = cuts[k], 0
        top = max(top, wide)
    yield rows.slice(lo)


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form. Each round doubles how far a word has followed its forms.

    A form is RATIO times as frequent as its word, so there are no rings and rounds are very few.
    """
    reached, _ = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = reached.selectExpr("word AS root", "root AS onward")
        step = reached.join(onward, "root", "left").selectExpr("word", "coalesce(onward, root) AS root", "onward IS NOT NULL AS moved")
        step, _ = materialise(step, "roots")
        if step.where("moved").isEmpty():
            return step.select("word", "root")
        reached = step.select("word", "root")


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", weight: int = BUCKET) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``docs``.

    A word's form is the most frequent of its near words, the first in code-point order of equally
    frequent ones, if it is RATIO times as frequent; ``root`` is where forms lead to. Null and empty
    texts have no words, an empty table has no rows, repeated rows count again, and other columns are
    not read. Texts and words of any length are taken whole. Where a hot bucket would fill a task, it is
    split by what its words share; counts are combined before their shuffles.
    """
    vocabulary, _ = materialise(words(docs, doc_id, text), "vocabulary")
    rows = buckets(vocabulary, weight).repartition("h").sortWithinPartitions("h", "m", "a", "head", "tail", "mid")
    found = rows.mapInArrow(_scan, NEAR)
    near = found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("least"), "best")).alias("top")
    )
    told = vocabulary.join(near, "word", "left").selectExpr(
        "word", "n", "coalesce(n_near, 0L) AS n_near",
        f"CASE WHEN -top.least >= {RATIO} * n THEN top.best END AS form", f"CASE WHEN -top.least >= {RATIO} * n THEN -top.least END AS form_n",
    )
    told, _ = materialise(told, "forms")
    rooted = told.join(_roots(told.where("form IS NOT NULL")), "word", "left")
    return rooted.selectExpr("word", "form", "coalesce(root, word) AS root", "n", "n_near", "form_n")
