"""Spelling variants against brute force over all pairs."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from texts import awkward, documents

from spendweave.llm import spelling


def plain_words(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    seen = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= 7 and n >= 2}


def near(u, v):
    """One code point inserted, deleted or replaced."""
    if len(u) > len(v):
        u, v = v, u
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    return len(v) == len(u) + 1 and any(v[:k] + v[k + 1 :] == u for k in range(len(v)))


def plain_variants(rows):
    words = plain_words(rows)
    out = {}
    for w, n in words.items():
        around = [v for v in words if abs(len(v) - len(w)) < 2 and near(w, v)]
        form = min(around, key=lambda v: (-words[v], v), default=None)
        out[w] = [form if form and words[form] >= 10 * n else None, n, len(around)]
    rows = set()
    for w, (form, n, many) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.add((w, form, root, n, many, words[form] if form else None))
    return rows


def results(spark, rows, **options):
    out = spelling.variants(documents(spark, rows), **options)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    found = [tuple(r) for r in out.collect()]
    assert len(found) == len(set(found))
    return set(found)


def edited(rng, word):
    k, letter = rng.randrange(len(word)), rng.choice("abeéÿ")
    return rng.choice([word[:k] + letter + word[k:], word[:k] + word[k + 1 :], word[:k] + letter + word[k + 1 :]])


def some_documents(seed, stems):
    rng = random.Random(seed)
    words = []
    for stem in stems:
        words += [stem] * 400
        for _ in range(12):
            once = edited(rng, stem)
            words += [once] * rng.choice([2, 3, 30, 400])
            words += [edited(rng, once)] * rng.choice([2, 3])
    rng.shuffle(words)
    texts = [rng.choice([" ", ", ", "1", "\n"]).join(words[k : k + 60]) for k in range(0, len(words), 60)]
    return [(i, t.upper() if i % 7 == 0 else t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("weight", [spelling.BUCKET, 30])
def test_variants_equal_brute_force(spark, weight):
    stems = ["aaaaaaaa", "aabaabaab", "consonance", "consonants", "éléphanté", "abababab", "aaaaaaab", "x" * 300 + "y", "ÀÉ×÷ÿàé"]
    rows = some_documents(31, stems) + awkward(random.Random(32)) + [(900, "x" * 30_000), (901, "x" * 30_000)]
    expected = plain_variants(rows)
    assert any(r[1] and r[2] != r[1] for r in expected) and sum(r[1] is not None for r in expected) > 50
    assert results(spark, rows, weight=weight) == expected


def test_a_hot_prefix_is_split_without_losing_a_pair(spark):
    rng = random.Random(33)
    tails = ["".join(rng.choice("abc") for _ in range(rng.choice([5, 6]))) for _ in range(400)]
    rows = [(k, " ".join(["sharedpart" + t for t in tails] * rng.choice([1, 2]))) for k in range(3)]
    assert results(spark, rows, weight=200) == plain_variants(rows)


def test_every_pair_of_a_bucket_is_found_once():
    rng = random.Random(34)
    for _ in range(60):
        buckets = [sorted({"".join(rng.choice("abé") for _ in range(rng.choice([0, 1, 3, 4]))) for _ in range(rng.randrange(1, 30))}) for _ in range(4)]
        texts = [t for b in buckets for t in b]
        first = np.array([k == 0 for b in buckets for k in range(len(b))])
        lengths = np.array([len(t) for t in texts])
        points = np.zeros((len(texts), 7), np.uint32)
        for row, t in zip(points, texts):
            row[: len(t)] = list(map(ord, t))
        of = np.cumsum(first)
        got = list(zip(*(x.tolist() for x in spelling.one_edit_apart(points, lengths, first))))
        want = {(i, j) for i in range(len(texts)) for j in range(len(texts)) if of[i] == of[j] and near(texts[i], texts[j])}
        assert len(got) == len(set(got)) and set(got) == want


def test_awkward_documents(spark):
    assert results(spark, []) == set()
    assert results(spark, [(1, None), (None, ""), (2, "short one"), (3, "aloneword")]) == set()
    again = [(None, "Repeated repeated"), (None, "Repeated repeated")]
    assert results(spark, again) == plain_variants(again) and plain_variants(again)
