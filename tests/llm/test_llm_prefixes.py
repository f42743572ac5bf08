"""The prefix trie against one that is built turn by turn."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from spendweave.llm import prefixes

SCHEMA = "conv_id bigint, turn bigint, role string, text string, h1 string, depth string, alone string"


def plain_trie(rows):
    turns = defaultdict(list)
    for i, turn, role, text in rows:
        if i is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            turns[i].append((turn is not None, turn or 0, digest, role, text))
    whole = {}
    for i in turns:
        h = zlib.crc32(str(i).encode()) % 6
        base = i - i % 100 if i >= 0 else i + -i % 100  # the remainder has the sign of the id
        own = [t[3:] for t in sorted(turns[i])]
        whole[i] = tuple([t[3:] for t in sorted(turns.get(base, []))][:h] + own[h:])
    members = defaultdict(list)
    for i, conv in whole.items():
        for d in range(len(conv) + 1):
            members[conv[:d]].append(i)
    below = defaultdict(list)
    for node in members:
        if node:
            below[node[:-1]].append(node)

    def sums(node):
        leaves, saved = (0, 0) if below[node] else (1, 0)
        stack = [node]
        while stack:
            n = stack.pop()
            stack += below[n]
            saved += (len(members[n]) - 1) * (len(n[-1][1]) if n else 0)
            leaves += n is not node and not below[n]
        return leaves, saved

    out = set()
    for node, held in members.items():
        ends = ",".join(str(i) for i in sorted(held) if len(whole[i]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.add((min(held), len(node), parent, len(held), len(below[node]), *sums(node), hashlib.sha256(ends.encode()).hexdigest()))
    return out


def results(spark, rows):
    frame = spark.createDataFrame([(*r, "x", None, "y") for r in rows], SCHEMA)
    out = prefixes.trie(frame)
    found = [tuple(r) for r in out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()]
    assert len(found) == len(set(found))
    return set(found)


def talks(seed):
    rng = random.Random(seed)
    rows, shared = [], [("user", "hello"), ("assistant", "été"), ("user", ""), ("system", "😀 go on")]
    for i in [*range(0, 40), *range(100, 130), *range(205, 225), 300, 301, -1, -5, -100, -150, -199, 7777]:
        length = rng.choice([0, 1, 2, 3, 5, 8])
        conv = [rng.choice(shared) if rng.random() < 0.7 else ("user", f"only {rng.random()}") for _ in range(length)]
        conv = conv or [shared[0]]
        rows += [(i, t, *turn) for t, turn in enumerate(conv)]
    common = [(i, t, "user", f"turn {t}") for i in range(1000, 1090) for t in range(12)]  # one conversation, ninety times
    rows += common + [(i, 20, "user", f"own end {i}") for i in range(1000, 1030)]
    rows += [(2001, None, "user", "first"), (2001, 0, None, None), (2001, None, None, "none"), (2002, 3, "a", "bc"), (2002, 3, "ab", "c")]
    rows += [(2003, 1, "user", "again")] * 3 + [(None, 1, "user", "no id"), (2004, None, None, None)]
    rows += [(2005, t, "user", "x" * 20_000 if t == 3 else f"long {t}") for t in range(700)]
    rows += [(2006, t, "user", f"long {t}" if t != 3 else "x" * 20_000) for t in range(650)]
    rng.shuffle(rows)
    return rows


def test_trie_equals_plain_trie(spark):
    rows = talks(41)
    expected = plain_trie(rows)
    assert any(r[1] > 600 and r[3] == 2 for r in expected) and any(r[1] == 0 and r[3] > 150 for r in expected)
    assert results(spark, rows) == expected


@pytest.mark.parametrize("width", [8, 200])
def test_a_full_sketch_loses_nothing(spark, monkeypatch, width):
    """Counters that many digests share prove little or nothing; also some prefixes of a tail but not all."""
    rows = talks(42)
    held = prefixes.sketch

    def narrow(chains, n):
        monkeypatch.setattr(prefixes, "CELLS", 0)
        wide, bits = held(chains, n)
        if width == 8:
            return wide, bits | 255
        rng = random.Random(43)
        return wide, bits | bytearray(rng.choice([0, 0, 255, 85]) for _ in range(len(bits)))

    monkeypatch.setattr(prefixes, "sketch", narrow)
    assert results(spark, rows) == plain_trie(rows)


def test_counters_never_read_too_low(spark):
    rows = [(k, -k, k * 7919 - 3, -k * 104729, 1) for k in range(1, 3000)]
    rows += rows[:40]
    chains = spark.createDataFrame(rows, "conv_id bigint, up1 bigint, h1 bigint, h2 bigint, depth bigint")
    width, bits = prefixes.sketch(chains, len(rows))
    for k, _, h1, h2, _ in rows[:40]:
        for row, h in enumerate((h1, h2)):
            cell = h % width + row * width
            assert bits[cell >> 3] >> (cell & 7) & 1
    over = sum(int(b).bit_count() for b in bits)
    assert 40 <= over <= 2000


def test_small_tables(spark):
    assert results(spark, []) == set()
    assert results(spark, [(None, 1, "user", "x")]) == set()
    for one in ([(5, 1, "user", "hi")], [(100, 1, "user", "hi")], [(100, None, None, None)]):
        assert results(spark, one) == plain_trie(one)
