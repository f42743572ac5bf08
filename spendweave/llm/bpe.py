"""Byte-level BPE: pre-tokens by array scans, merges by a cache, decoding by offsets.

Pre-tokens are found without regular expressions. Every code point gets a symbol: its class and
what the rule needs to know of its neighbour. A symbol stands for a transition function
over the few states of an automaton. Composition of such functions is associative, so
prefixes of a text are composed by a scan: within rows of a matrix column by column, all
rows at once, then over the rows' totals. State before, symbol and a table give the boundaries.
"""

from __future__ import annotations

import base64
import hashlib
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendweave.llm.batches import small_batches

# The code points of Unicode's property White_Space.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# What may follow an apostrophe as a token of its own.
ONE_LETTER, TWO_LETTERS = "stmd", ("re", "ve", "ll")

RANKS = "byte_bpe_50k.tiktoken"
#: Pre-tokens that a Python worker remembers.
CACHE = 1 << 19
#: Rows of the scan's matrix have so many code points.
ROW = 256

# Symbols. END separates texts; SHORT and PAIR are letters that can end or begin a contraction.
END, LETTER, SHORT, PAIR, NUMBER, OTHER, QUOTE, SPACE, BLANK = range(9)
# States: what the code point before was. CLOSED: a contraction has ended; HALF: its first of two letters.
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, LONE_QUOTE, HALF, CLOSED, AFTER_SPACE, AFTER_BLANK = range(9)


@lru_cache(1)
def code_point_classes() -> np.ndarray:
    """Symbol of every code point, before its neighbours are looked at."""
    out = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x110000):
        major = unicodedata.category(chr(c))[0]
        if major in "LN":
            out[c] = LETTER if major == "L" else NUMBER
    out[WHITE_SPACE] = BLANK
    out[ord(" ")] = SPACE
    out[ord("'")] = QUOTE
    return out


def _step(state: int, symbol: int) -> int:
    """The state after a code point."""
    if symbol == END:
        return FRESH
    if symbol in (SPACE, BLANK):
        return AFTER_SPACE if symbol == SPACE else AFTER_BLANK
    if symbol == NUMBER:
        return IN_NUMBERS
    if symbol == OTHER:
        return IN_OTHERS
    if symbol == QUOTE:  # only one that begins a token can begin a contraction
        return IN_OTHERS if state in (IN_OTHERS, LONE_QUOTE, AFTER_SPACE) else LONE_QUOTE
    if state == LONE_QUOTE and symbol == SHORT or state == HALF:
        return CLOSED
    return HALF if state == LONE_QUOTE and symbol == PAIR else IN_LETTERS


def _begins(state: int, symbol: int) -> bool:
    """Whether a code point begins a token, white space before others left aside."""
    if symbol in (SPACE, BLANK):
        return state not in (AFTER_SPACE, AFTER_BLANK)
    if symbol in (LETTER, SHORT, PAIR):
        return not (state in (IN_LETTERS, HALF, AFTER_SPACE) or state == LONE_QUOTE and symbol in (SHORT, PAIR))
    if symbol == NUMBER:
        return state not in (IN_NUMBERS, AFTER_SPACE)
    return state not in (IN_OTHERS, LONE_QUOTE, AFTER_SPACE) or symbol == END


@lru_cache(1)
def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the symbols' functions, the table of compositions, and each function's values."""
    step = [tuple(_step(s, x) for s in range(9)) for x in range(9)]
    known = {f: i for i, f in enumerate(dict.fromkeys([tuple(range(9)), *step]))}
    todo = list(known)
    while todo:
        first = todo.pop()
        for then in list(known):
            for f, g in ((first, then), (then, first)):
                both = tuple(g[x] for x in f)
                if both not in known:
                    known[both] = len(known)
                    todo.append(both)
    compose = np.zeros((len(known), len(known)), np.uint8 if len(known) < 256 else np.uint16)
    for f, i in known.items():
        for g, j in known.items():
            compose[i, j] = known[tuple(g[x] for x in f)]
    return np.array([known[f] for f in step], compose.dtype), compose, np.array(list(known), np.uint8)


def states_before(symbols: np.ndarray) -> np.ndarray:
    """The automaton's state before each symbol: a scan over compositions of transition functions."""
    of_symbol, compose, values = _monoid()
    n, size = len(symbols), len(compose)
    rows = -(-n // ROW)
    functions = np.zeros(rows * ROW, of_symbol.dtype)  # 0 is the identity
    functions[:n] = of_symbol[symbols]
    # column-major: each step composes one column of all rows
    columns = np.ascontiguousarray(functions.reshape(rows, ROW).T)
    flat = compose.ravel()
    for k in range(1, ROW):
        columns[k] = flat[columns[k - 1].astype(np.intp) * size + columns[k]]
    starts, state = np.empty(rows, np.uint8), FRESH
    totals = values[columns[-1]]
    for r in range(rows):
        starts[r] = state
        state = totals[r, state]
    after = values.ravel()[columns.astype(np.intp) * 9 + starts].T.ravel()[:n]
    return np.concatenate([np.array([FRESH], np.uint8), after[:-1]]) if n else after


@lru_cache(1)
def _tables() -> np.ndarray:
    return np.array([[_begins(s, x) for x in range(9)] for s in range(9)])


def boundaries(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where tokens begin in texts joined by one code point each, which stands at ``ends``."""
    symbols = code_point_classes()[points]
    symbols[ends] = END
    following = np.append(symbols[1:], END).astype(np.uint8)
    next_point = np.append(points[1:], 0)
    quoted = np.flatnonzero(symbols == QUOTE) + 1  # contractions are rare: look only there
    quoted = quoted[quoted < len(points)]
    first, second = points[quoted], next_point[quoted]
    is_letter = symbols[quoted] == LETTER
    short = is_letter & np.isin(first, [ord(c) for c in ONE_LETTER])
    pair = np.zeros(len(quoted), bool)
    for a, b in TWO_LETTERS:
        pair |= is_letter & (first == ord(a)) & (second == ord(b))
    symbols[quoted[short]], symbols[quoted[pair]] = SHORT, PAIR
    before = states_before(symbols)
    begins = _tables().ravel()[before.astype(np.intp) * 9 + symbols]
    # the last of several blanks before something else is left to it, or is a token alone
    blank = (symbols == SPACE) | (symbols == BLANK)
    begins |= blank & (following != SPACE) & (following != BLANK) & (following != END)
    return begins


class Merges(dict):
    """Pre-token to its ids as little-endian 32-bit integers; merged when first asked for."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks

    def __missing__(self, token: str) -> bytes:
        parts = token.encode()
        known = self.ranks.get(parts)
        ids = [known] if known is not None else self.merged(parts)
        if len(self) >= CACHE:
            self.clear()
        self[token] = out = np.array(ids, "<u4").tobytes()
        return out

    def merged(self, raw: bytes) -> list[int]:
        """Joins the neighbours of lowest rank until none is a token. Long pre-tokens use a heap."""
        if len(raw) > 100:
            return self._merged_long(raw)
        parts = [raw[i : i + 1] for i in range(len(raw))]
        get = self.ranks.get
        scores = [get(a + b, 1 << 30) for a, b in zip(parts, parts[1:])]
        while scores and (low := min(scores)) < 1 << 30:
            i = scores.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del scores[i]
            if i < len(scores):
                scores[i] = get(parts[i] + parts[i + 1], 1 << 30)
            if i:
                scores[i - 1] = get(parts[i - 1] + parts[i], 1 << 30)
        return [self.ranks[p] for p in parts]

    def _merged_long(self, raw: bytes) -> list[int]:
        import heapq

        get, n = self.ranks.get, len(raw)
        stop, before = list(range(1, n + 1)), list(range(-1, n - 1))  # part i is raw[i:stop[i]], 0 where it is gone
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(raw[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            j = stop[i]
            if not j or j >= n or stop[j] != end:
                continue  # one of the two has been merged since
            stop[i], stop[j] = end, 0
            if end < n:
                before[end] = i
                if (r := get(raw[i : stop[end]])) is not None:
                    heapq.heappush(heap, (r, i, stop[end]))
            if (p := before[i]) >= 0 and (r := get(raw[p:end])) is not None:
                heapq.heappush(heap, (r, p, end))
        return [self.ranks[raw[i : stop[i]]] for i in range(n) if stop[i]]


class Codec:
    """Encodes texts by a rank file and decodes ids."""

    def __init__(self, ranks_file: str):
        with open(ranks_file, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.merges = Merges(self.ranks)
        pieces = sorted(self.ranks.items(), key=lambda x: x[1])
        lengths = np.zeros(pieces[-1][1] + 2, np.int64)
        for piece, i in pieces:
            lengths[i + 1] = len(piece)
        self.offsets = lengths.cumsum()  # of each id's bytes in the table of all bytes
        self.bytes = np.frombuffer(b"".join(piece for piece, _ in pieces), np.uint8)

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per text its ids and, one longer, the byte offsets at which their bytes begin and end."""
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = (lengths + 1).cumsum() - 1
        points = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le"), np.uint32)
        starts = np.flatnonzero(boundaries(points, ends))
        cuts = np.searchsorted(starts, ends)  # where each text's END is among the starts
        low = 0
        for text, end, cut, length in zip(texts, ends.tolist(), cuts.tolist(), lengths.tolist()):
            at = (starts[low : cut + 1] - (end - length)).tolist()
            ids = b"".join(map(self.merges.__getitem__, map(text.__getitem__, map(slice, at, at[1:]))))
            ids = np.frombuffer(ids, "<u4")
            low = cut + 1
            yield ids, np.concatenate([[0], (self.offsets[ids + 1] - self.offsets[ids]).cumsum()])

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> bytes:
        """The bytes of ids: each id's piece is copied to its offset."""
        source = np.repeat(self.offsets[ids] - offsets[:-1], np.diff(offsets))
        return self.bytes[source + np.arange(offsets[-1])].tobytes()


@lru_cache(2)
def codec(ranks_file: str) -> Codec:
    """One per Python worker, which keeps its cache from task to task."""
    return Codec(ranks_file)


#: Texts of at most so many code points are scanned together.
TOGETHER = 1 << 20


def _groups(texts: list[str]) -> Iterator[list[str]]:
    group, size = [], 0
    for text in texts:
        if group and size + len(text) > TOGETHER:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        yield group


def _encoder(ranks_file: str, finish, names: list[str], types: list[pa.DataType]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks_file)
        for batch in batches:
            for lo, group in _slices(batch):
                rows = [finish(own, ids, offsets) for ids, offsets in own.encode(group)]
                columns = [batch.column(i).slice(lo, len(group)) for i in range(batch.num_columns - 1)]
                made = [pa.array([row[i] for row in rows], t) for i, t in enumerate(types)]
                yield pa.RecordBatch.from_arrays(columns + made, batch.schema.names[:-1] + names)

    return run


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str]]]:
    lo = 0
    for group in _groups([t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]):
        yield lo, group
        lo += len(group)


def _mapped(docs: DataFrame, text: str, added: str, run) -> DataFrame:
    small_batches(docs.sparkSession)
    names = [f.strip().split()[0] for f in added.split(",")]
    own = docs.drop(*names).select("*", F.col(f"`{text}`").cast("string").alias("_whole_text"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields[:-1])
    return own.mapInArrow(run, f"{kept}, {added}")


def encode(docs: DataFrame, text: str = "text", ranks_file: str | None = None) -> DataFrame:
    """``docs`` with ``ids`` (array of int) and ``id_offsets``, byte offsets of the ids' pieces and the end.

    A null text is the empty text, which has no ids. Rows repeat as they are given. Columns of
    ``docs`` with the names of the added ones are replaced. Texts of any length are taken whole.
    """
    finish = lambda own, ids, offsets: (ids.view(np.int32), offsets)
    run = _encoder(
        ranks_file or public_tokenizers.path(RANKS), finish, ["ids", "id_offsets"], [pa.list_(pa.int32()), pa.list_(pa.int64())]
    )
    return _mapped(docs, text, "ids array<int>, id_offsets array<bigint>", run)


def round_trip(docs: DataFrame, text: str = "text", ranks_file: str | None = None) -> DataFrame:
    """``docs`` with ``n_tokens``, and SHA-256 of the ids and of the bytes that they decode to.

    What encode() says of nulls, repeated rows and names holds here too.
    """

    def finish(own: Codec, ids: np.ndarray, offsets: np.ndarray) -> tuple:
        return len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(own.decode(ids, offsets)).hexdigest()

    run = _encoder(
        ranks_file or public_tokenizers.path(RANKS),
        finish,
        ["n_tokens", "ids_sha256", "decoded_sha256"],
        [pa.int64(), pa.string(), pa.string()],
    )
    return _mapped(docs, text, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", run)
