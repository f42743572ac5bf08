"""Token-id shards, compressed by a Re-Pair grammar and decodable at any document.

A shard is a run of documents in ascending doc_id. Frequent pairs of neighbouring symbols are
replaced by nonterminals, round after round, until no pair repeats enough to pay for a rule. After the
first round only the places of pairs with a new symbol, and of those left over, are looked at again: no other pair can
have become more frequent. The shard stores the rules, the last sequence and its expansion lengths' sums, sampled, so that
the ids of one document are found and expanded without the rest.

File format, little-endian: magic, six counts, then the arrays doc_id (int64), known (uint8, 0
where doc_id is null), length (int64, ids of each document), rule_left and rule_right (uint32), samples
(int64, ids before every SAMPLE-th symbol), used (a bit for each symbol, set if the sequence has it) and the
sequence, as places among the used symbols (uint16 if those fit, else uint32).
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendweave.llm.batches import small_batches
from spendweave.sources.store import materialise

TOKENIZER = "byte_bpe_50k.json"
#: Appended to every document.
END_ID = 2
#: A shard is closed at so many ids; a document is never split.
SHARD_IDS = 1 << 20
#: A pair gets a rule if it occurs so often; so many rules a round at most, the rest come in later rounds.
LEAST_COUNT, ROUND_RULES = 8, 5000
SAMPLE = 256
#: Texts of so many code points are cut into pieces together; so many pre-tokens are merged as one string, and so many
#: strings handed to the library at a time.
GROUP, AT_ONCE, CALL = 1 << 24, 48, 512

MAGIC = b"RPIDS002"
_HEAD = struct.Struct("<8s6Q")

# White space that touches white space or an end, where a text cannot be cut at spaces.
_BLANK = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_UNEVEN = rf"\A{_BLANK}|{_BLANK}{_BLANK}|{_BLANK}\z"
_BETWEEN_WORDS = regex.compile(r"(?<=\S)(?= \S)", regex.V1)
# Letters and signs that have been in Unicode for so long that all libraries know them. The apostrophe
# is left out, since it can begin a contraction.
_LETTERS = (
    "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u02af\u0388-\u038a\u038e-\u03a1\u03a3-\u03f5\u03f7-\u0481"
    "\u048a-\u0523\u05d0-\u05ea\u0621-\u064a\u1e00-\u1eff\u3041-\u3096\u30a1-\u30fa\u3400-\u4db5\u4e00-\u9fa5\uac00-\ud7a3"
)
_SIGNS = r"!-&(-/:-@\[-`{-~\u00a1-\u00a9\u00ab\u00ac\u00ae-\u00b1\u00b4\u00b6-\u00b8\u00bb\u00bf\u00d7\u00f7\u2010-\u2027\u2030-\u205e"
_SPACE, _LINE = 1, 2


@lru_cache(1)
def _kinds() -> np.ndarray:
    """Kind of each code point below 2^16: space, line break, letter, digit, sign or, 0, any other."""
    every, out = "".join(map(chr, range(0xD800))), np.zeros(1 << 16, np.uint8)
    for kind, some in enumerate((" ", "\n", _LETTERS, "0-9", _SIGNS), _SPACE):
        out[[ord(c) for c in re.findall(f"[{some}]", every)]] = kind
    return out


@dataclass
class Runs:
    """Runs of ids in a table, each with its first place and size."""

    table: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray

    def expand(self, runs: np.ndarray) -> np.ndarray:
        """The ids of these runs one after another."""
        sizes = self.sizes[runs]
        ends = sizes.cumsum()
        total = int(ends[-1]) if len(ends) else 0
        return self.table[np.repeat(self.starts[runs] - (ends - sizes), sizes) + np.arange(total)]


def _strings(words: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an array that is no slice."""
    _, offsets, data = words.buffers()
    return np.frombuffer(data or b"", np.uint8), np.frombuffer(offsets, np.int64)[: len(words) + 1]


class Pieces:
    """Ids of texts, by the tokenizers library, which encodes each distinct piece of a group of texts once.

    The pre-tokeniser always cuts before a single space between two words, and on both sides of a single
    line break. So texts are cut there, and pieces' ids, joined, are the text's. A piece stands as its word
    without the space before, or as its line break and word.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their names in a text are ordinary text
        # the vocabulary writes bytes as characters: printable Latin-1 as it is, the others from 256 on
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        self.written = np.arange(256, dtype="<u4")
        self.written[[b for b in range(256) if b not in plain]] = 256 + np.arange(256 - len(plain))
        # The model without its pre-tokeniser, which takes most of the time. Pre-tokens reach it many at once, each ended
        # by a byte that no UTF-8 has: where no merge has it either, none goes across.
        model = json.loads(Path(path).read_text(encoding="utf-8"))["model"]
        end = chr(self.written[0xFF])
        self.model, self.end = Tokenizer(self.tokenizer.model), self.tokenizer.token_to_id(end)
        self.direct = self.end is not None and not model.get("ignore_merges") and not any(end in "".join(m) for m in model["merges"])
        self.line = len(self.whole("\n"))

    def whole(self, text: str) -> np.ndarray:
        """A text's ids by the library alone."""
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def merged(self, tokens: pa.LargeStringArray) -> Runs:
        """Ids of pre-tokens, by the library's model."""
        data, offsets = _strings(tokens)
        written = self.written[np.insert(data, offsets[1:], 0xFF)].tobytes().decode("utf-32-le")  # a byte is a character
        stops = (offsets + np.arange(len(offsets)))[:-1:AT_ONCE].tolist()
        some = [written[a:b] for a, b in zip(stops, [*stops[1:], None])]
        ids = []
        for k in range(0, len(some), CALL):  # the library's objects are many times larger than the ids
            ids += [np.array(e.ids, "<u4") for e in self.model.encode_batch_fast(some[k : k + CALL], add_special_tokens=False)]
        ids = np.concatenate(ids)
        ends = np.flatnonzero(ids == self.end)
        ends -= np.arange(len(ends))
        sizes = np.diff(ends, prepend=0)
        return Runs(ids[ids != self.end], ends - sizes, sizes)

    def encoded(self, words: pa.LargeStringArray) -> Runs:
        """Ids of distinct pieces."""
        data, offsets = _strings(words)
        spaced = data[offsets[:-1]] != ord("\n")
        data = np.insert(data, offsets[:-1][spaced], ord(" ")).tobytes()
        points = np.frombuffer(data.decode().encode("utf-32-le"), "<u4")
        kinds = _kinds()[np.minimum(points, 0xFFFF)]
        sizes = pc.utf8_length(words).to_numpy() + spaced
        starts = sizes.cumsum() - sizes
        # pieces with anything else than letters, digits and signs behind their first character go to the library as they are
        other = kinds <= _LINE
        other[starts] = False
        others = np.unique(np.searchsorted(starts, np.flatnonzero(other), "right") - 1) if self.direct else np.arange(len(words))
        library = []
        if len(others):
            some = zip(spaced[others].tolist(), words.take(pa.array(others)).to_pylist())
            library = [self.whole(" " + w if s else w) for s, w in some]
            clear = np.ones(len(words), bool)
            clear[others] = False
            kept = np.repeat(clear, sizes)
            points, kinds, sizes = points[kept], kinds[kept], sizes[clear]
            starts = sizes.cumsum() - sizes
        if not len(points):
            runs = Runs(np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0, np.int64))
        else:
            # a pre-token is a run of one kind, with the space before it if there is one
            cuts = np.flatnonzero((kinds[1:] != kinds[:-1]) & (kinds[:-1] != _SPACE)) + 1
            width = (1 + (points >= 0x80) + (points >= 0x800)).cumsum()
            bounds = np.concatenate([[0], width[cuts - 1], width[-1:]]).astype(np.int64)
            data = points.astype("<u4").tobytes().decode("utf-32-le").encode()
            tokens = pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds), pa.py_buffer(data)).dictionary_encode()
            merged, tokens = self.merged(tokens.dictionary), tokens.indices.to_numpy()
            ends = merged.sizes[tokens].cumsum()[np.append(np.searchsorted(cuts, starts[1:]), len(cuts))]
            runs = Runs(merged.expand(tokens), np.append(0, ends[:-1]), np.diff(ends, prepend=0))
        if not library:
            return runs
        sizes = np.array([*map(len, library)])
        out = Runs(np.concatenate([runs.table, *library]), np.zeros(len(words), np.int64), np.zeros(len(words), np.int64))
        out.starts[clear], out.sizes[clear] = runs.starts, runs.sizes
        out.starts[others], out.sizes[others] = len(runs.table) + sizes.cumsum() - sizes, sizes
        return out

    def encode_all(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text."""
        spans, plain, n, rest = [], [], 0, []
        uneven = pc.match_substring_regex(pa.array(texts, pa.large_string()), _UNEVEN).to_pylist()
        for text, is_uneven in zip(texts, uneven):
            if not text:
                spans.append((None, 0, 0, 0))
            elif is_uneven:
                first, *more = _BETWEEN_WORDS.split(text)
                spans.append((self.whole(first), 0, ~len(rest), ~(len(rest) + len(more))))
                rest += [piece[1:] for piece in more]
            else:  # the first word gets a line break before it, too
                plain.append(("\n" + text).replace("\n", " \n")[1:])
                size = plain[-1].count(" ") + 1
                spans.append((None, self.line, n, n + size))
                n += size
        words = pa.array(rest, pa.large_string())
        if plain:
            words = pa.concat_arrays([pc.split_pattern(pa.array([" ".join(plain)], pa.large_string()), " ").flatten(), words])
        words = words.dictionary_encode()
        runs, places = self.encoded(words.dictionary), words.indices.to_numpy()
        for head, skip, a, b in spans:
            # words of texts that are not plain stand behind all others
            ids = runs.expand(places[a:b] if a >= 0 else places[n + ~a : n + ~b])
            yield ids[skip:] if head is None else np.concatenate([head, ids])

    def encode(self, text: str) -> bytes:
        return next(self.encode_all([text])).tobytes()


@lru_cache(1)
def pieces(path: str) -> Pieces:
    """One per Python worker, which keeps it from task to task."""
    return Pieces(path)


_TABLE_BITS = 20


def _hashed(pairs: np.ndarray) -> np.ndarray:
    return pairs * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - _TABLE_BITS)


def compress(ids: np.ndarray, vocabulary: int) -> tuple[np.ndarray, np.ndarray]:
    """(rules as rows of two symbols, sequence). Rule k makes symbol vocabulary + k.

    In the sequence no pair is left LEAST_COUNT times. Every round shortens it, so that the rounds end.
    """
    half = np.uint64(32)
    sequence, rules = ids.astype(np.uint32), [np.zeros((0, 2), np.int64)]
    symbols, live = vocabulary, np.arange(max(len(sequence) - 1, 0))
    while len(live):
        # places of pairs that can be frequent: those of a new symbol, and those that were frequent before and got no rule
        code = sequence[live].astype(np.uint64) << half | sequence[live + 1]
        pairs, counts = np.unique(code, return_counts=True)
        often = np.flatnonzero(counts >= LEAST_COUNT)
        if not len(often):
            break
        every = pairs[often]
        chosen = np.sort(every[np.argsort(-counts[often], kind="stable")[:ROUND_RULES]])
        # a table by a hash of the pair; of chosen pairs with one hash the last is replaced in this round
        table = np.full(1 << _TABLE_BITS, -2, np.int32)
        table[_hashed(every)] = -1
        table[_hashed(chosen)] = np.arange(len(chosen))
        slot = table[_hashed(code)]
        # all frequent pairs stay in sight, and what shares a hash with one; few others do
        seen = slot > -2
        at, slot, code = live[seen], slot[seen], code[seen]
        keep = np.zeros(len(sequence), bool)
        keep[at] = True
        # -1 is the last one's place, but no pair that is not chosen equals it
        hit = np.flatnonzero(chosen[slot] == code)
        at, slot = at[hit], slot[hit]
        # of occurrences that overlap, every other one in a chain is replaced
        chain = np.concatenate([[True], np.diff(at) != 1])
        start = np.maximum.accumulate(np.where(chain, np.arange(len(at)), 0))
        taken = (np.arange(len(at)) - start) % 2 == 0
        at, slot = at[taken], slot[taken]
        used = np.zeros(len(chosen), bool)
        used[slot] = True
        sequence[at] = (symbols + used.cumsum() - 1).astype(np.uint32)[slot]
        kept = np.ones(len(sequence), bool)
        kept[at + 1] = False
        sequence, keep = sequence[kept], keep[kept]
        # a pair with a rule can still stand where an overlap kept it from being replaced
        new = at - np.arange(len(at))
        keep[new] = True
        keep[new[new > 0] - 1] = True
        live = np.flatnonzero(keep[:-1])
        made = chosen[used]
        rules.append(np.stack([made >> half, made & np.uint64((1 << 32) - 1)], axis=1).astype(np.int64))
        symbols += len(made)
    return np.concatenate(rules), sequence


@dataclass
class Shard:
    """A shard as it is in its file."""

    doc_ids: np.ndarray
    known: np.ndarray
    lengths: np.ndarray
    rules: np.ndarray
    samples: np.ndarray
    sequence: np.ndarray
    vocabulary: int

    def __post_init__(self):
        # expansions of all symbols laid end to end; rules name only symbols before them
        ids = np.arange(self.vocabulary, dtype="<u4").tobytes()
        made = [ids[k : k + 4] for k in range(0, len(ids), 4)]
        for a, b in self.rules.tolist():
            made.append(made[a] + made[b])
        sizes = np.array([*map(len, made)], np.int64) // 4
        self.runs = Runs(np.frombuffer(b"".join(made), "<u4"), sizes.cumsum() - sizes, sizes)
        self.starts = np.concatenate([[0], self.lengths.cumsum()])

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        return self.runs.expand(symbols)

    def read(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from ``start``; expands only the symbols around them."""
        if not n:
            return self.runs.table[:0]
        first = int(np.searchsorted(self.samples, start, "right")) - 1
        after = int(np.searchsorted(self.samples, start + n, "left"))
        low, high = first * SAMPLE, after * SAMPLE  # from the last sample before to the first behind
        before = start - int(self.samples[first])
        return self.expand(self.sequence[low:high])[before : before + n]

    def document(self, k: int) -> np.ndarray:
        return self.read(int(self.starts[k]), int(self.lengths[k]))


def pack(doc_ids: list[int | None], ids: list[np.ndarray], vocabulary: int) -> bytes:
    """A shard file."""
    rules, sequence = compress(np.concatenate(ids) if ids else np.zeros(0, np.uint32), vocabulary)
    sizes = [1] * vocabulary
    for a, b in rules.tolist():
        sizes.append(sizes[a] + sizes[b])
    lengths = np.array(sizes)[sequence]
    samples = (lengths.cumsum() - lengths)[::SAMPLE]
    # symbols in use, and the sequence as places among them
    flags = np.zeros(vocabulary + len(rules), bool)
    flags[sequence] = True
    wide = "<u2" if flags.sum() <= 1 << 16 else "<u4"
    counts = len(doc_ids), len(rules), len(samples), len(sequence), int(wide[-1]), vocabulary
    arrays = (
        np.array([i or 0 for i in doc_ids], "<i8"),
        np.array([i is not None for i in doc_ids], np.uint8),
        np.array([len(x) for x in ids], "<i8"),
        rules.T.astype("<u4"),
        samples.astype("<i8"),
        np.packbits(flags),
        (flags.cumsum() - 1)[sequence].astype(wide),
    )
    return _HEAD.pack(MAGIC, *counts) + b"".join(a.tobytes() for a in arrays)


def unpack(raw: bytes) -> Shard:
    """A shard from its file; ValueError if it is not one."""
    magic, docs, n_rules, n_samples, n_symbols, width, vocabulary = _HEAD.unpack_from(raw)
    sizes = [8 * docs, docs, 8 * docs, 8 * n_rules, 8 * n_samples, -(-(vocabulary + n_rules) // 8), width * n_symbols]
    if magic != MAGIC or _HEAD.size + sum(sizes) != len(raw):
        raise ValueError("not a shard of token ids")
    out, at = [], _HEAD.size
    for size, kind in zip(sizes, ("<i8", np.uint8, "<i8", "<u4", "<i8", np.uint8, f"<u{width}")):
        out.append(np.frombuffer(raw[at : at + size], kind))
        at += size
    used = np.flatnonzero(np.unpackbits(out[5], count=vocabulary + n_rules))
    return Shard(out[0], out[1], out[2], out[3].reshape(2, -1).T, out[4], used[out[6]], vocabulary)


SHARDS = "part int, first_token bigint, n_docs bigint, n_tokens bigint, shard binary"


def _encoded(own: Pieces, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, np.ndarray]]:
    """Each document's doc_id and ids."""
    doc_ids, texts, size = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            doc_ids.append(doc_id)
            texts.append(text)
            size += len(text or "")
            if size >= GROUP:
                yield from zip(doc_ids, own.encode_all(texts))
                doc_ids, texts, size = [], [], 0
    yield from zip(doc_ids, own.encode_all(texts))


def _writer(path: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, done = pieces(path), TaskContext.get().partitionId(), 0
        vocabulary = max(own.tokenizer.get_vocab_size(), END_ID + 1)
        end = np.array([END_ID], "<u4")
        doc_ids, ids, size = [], [], 0

        def flushed() -> pa.RecordBatch:
            raw = pack(doc_ids, ids, vocabulary)
            row = [[part], [done], [len(doc_ids)], [size], [raw]]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(row, kinds)], [f.split()[0] for f in SHARDS.split(", ")]
            )

        for doc_id, some in _encoded(own, batches):
            doc_ids.append(doc_id)
            ids.append(np.concatenate([some, end]))
            size += len(ids[-1])
            if size >= SHARD_IDS:
                yield flushed()
                done += size
                doc_ids, ids, size = [], [], 0
        if doc_ids:
            yield flushed()

    return write


def write_shards(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """Shards of all documents in ascending doc_id, stored in the shared folder by Spark's own committer.

    A row holds a shard's file with its part, a range of doc_id, and the ids of its part before
    it. A null text is the empty text and has the end id alone. Rows without doc_id come first.
    Rows that share an id come one after another, in any order. Other columns are not read.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    rows = rows.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first())
    made = rows.mapInArrow(_writer(path or public_tokenizers.path(TOKENIZER)), SHARDS)
    return materialise(made, "token-shards")[0]


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for base, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
            shard = unpack(raw.as_py())
            ids = shard.expand(shard.sequence).astype("<u4").tobytes()
            cuts = (4 * shard.starts).tolist()
            crc = [zlib.crc32(ids[a:b]) for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(shard.doc_ids, mask=shard.known == 0),
                    pa.array(base + shard.starts[:-1]),
                    pa.array(shard.lengths),
                    pa.array(crc, pa.int64()),
                ],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def read_shards(shards: DataFrame) -> DataFrame:
    """Per document its place among all ids, its number of ids and their CRC-32."""
    sums = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    # one row for each part of the range partitioning, of which there are as many as partitions
    before = sums.selectExpr("part", "coalesce(sum(n) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L) AS before")
    placed = shards.join(before, "part").selectExpr("before + first_token AS base", "shard")
    return placed.mapInArrow(_reader, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
