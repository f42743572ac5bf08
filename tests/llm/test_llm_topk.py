"""Exact top-k search against all products."""

import math
import random

import pytest

from spendweave.llm import topk

SCHEMA = "vec_id bigint, embedding array<double>, score string, row string, grp int, length string"


def plain(rows, asks=lambda i: i % 100 == 0):
    whole = []
    for i, e in rows:
        if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e):
            whole.append((i, [max(-(2**62), min(2**62, math.floor(1024 * x))) if abs(x) < 1e300 else int(math.copysign(2**62, x)) for x in e]))
    out = []
    for i, q in whole:
        if asks(i):
            limit = 2**63
            scores = sorted((-max(-limit, min(limit - 1, sum(a * b for a, b in zip(q, v)))), j) for j, v in whole if j != i)
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(scores[:10], 1)]
    return sorted(out)


def results(spark, rows, **options):
    out = topk.search(spark.createDataFrame([(*r, "x", "y", 1, "z") for r in rows], SCHEMA), **options)
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(tuple(r) for r in out.collect())


def some(seed, n, dims=16, spread=lambda rng: 1.0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(5)]
    rows = []
    for i in range(n):
        size = spread(rng)
        rows.append((i, [size * (c + rng.gauss(0, 0.1)) for c in rng.choice(centres)]))
    return rows


@pytest.mark.parametrize("spread", [lambda rng: 1.0, lambda rng: rng.choice([0.01, 1.0, 30.0]), lambda rng: rng.expovariate(1)])
def test_search_equals_all_products(spark, monkeypatch, spread):
    monkeypatch.setattr(topk, "LEAST_GROUP", 100)
    rows = some(51, 900, spread=spread) + [(1000 + i, [0.5] * 16) for i in range(300)]  # one vector very often
    random.Random(52).shuffle(rows)
    assert results(spark, rows) == plain(rows)


def test_thresholds_from_samples_and_many_groups(spark, monkeypatch):
    monkeypatch.setattr(topk, "LEAST_GROUP", 16)
    monkeypatch.setattr(topk, "SAMPLE", 4)
    monkeypatch.setattr(topk, "GROUP", 16 * 20)
    monkeypatch.setattr(topk, "STEPS", 5)
    rows = some(53, 1200, spread=lambda rng: rng.expovariate(1))
    assert results(spark, rows, asks="vec_id % 10 = 3") == plain(rows, lambda i: i % 10 == 3)


def test_awkward_vectors(spark):
    inf, nan = math.inf, math.nan
    rows = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [3.0, -1.0]), (100, []), (200, [0.0, 0.0]), (300, None), (400, [None, 1.0]),
        (500, [nan, 1.0]), (600, [inf, 1.0]), (None, [9.0, 9.0]), (1, [1.0]), (2, [1.0, 2.0, 3.0]), (3, [-1e-9, 0.0]), (4, [1.0, 2.0]), (4, [1.0, 2.0]),
    ]
    assert results(spark, rows) == plain(rows)
    assert results(spark, []) == [] and results(spark, [(1, [1.0])]) == [] and results(spark, [(100, [1.0])]) == []
    assert results(spark, [(None, None)]) == []


def test_large_components_stay_exact(spark):
    rng = random.Random(54)
    for size in (1e3, 1e6, 1e12, 1e200):
        rows = [(i, [rng.choice([-1, 1]) * rng.random() * size for _ in range(6)]) for i in range(0, 260)]
        assert results(spark, rows) == plain(rows), size


def test_both_prunings_are_chosen():
    """Where one coordinate dominates, it leaves few vectors; where none does, length decides."""
    import numpy as np

    rng = np.random.default_rng(55)
    spikes = np.rint(1024 * np.eye(64)[rng.integers(0, 64, 4000)] + rng.normal(0, 20, (4000, 64))).astype(np.int64)
    lengths = np.sqrt((spikes.astype(float) ** 2).sum(axis=1))
    group = topk.Buckets(np.arange(4000), spikes, lengths)
    seen = {}
    whole = group.typed(np.float32)

    class Counted(np.ndarray):
        def __matmul__(self, other):
            seen["rows"] = seen.get("rows", 0) + len(self)
            return np.asarray(self) @ np.asarray(other)

    group.by_type[np.float32] = whole.view(Counted)
    least = np.full(20, 0.8 * 1024**2)
    out = list(group.ask(np.arange(20), spikes[:20], lengths[:20], least))
    for q, ids, scores in out:
        products = spikes @ spikes[q]
        want = sorted((-int(s), j) for j, s in enumerate(products) if j != q and s >= least[q])[:10]
        assert [(-int(s), int(j)) for s, j in zip(scores, ids)] == want
    assert seen["rows"] < 20 * 4000 / 4
