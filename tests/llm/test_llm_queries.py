"""Registered queries against their SQL, and the pipeline against plain rules, on the smallest tables."""

import base64
import random
import re
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from test_llm_native import SECRETS, measures
from test_llm_text import brute_components, fingerprint
from texts import documents

import corpus_pipeline
from spendweave.llm import decontaminate, secretscan
from spendweave.llm.oracles import ORACLES
from spendweave.llm.queries import QUERIES
from verification.compare import connect

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test data")


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, name):
    expected = connect(DATA).execute(ORACLES[name])
    columns = [d[0] for d in expected.description]
    df = QUERIES[name](spark, DATA)
    assert sorted(df.columns) == sorted(columns)
    assert Counter(map(tuple, df.select(*columns).collect())) == Counter(expected.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_runs(spark, name):
    df = QUERIES[name](spark, DATA)
    assert len({"doc_id", "page_id"} & set(df.columns)) == 1 and df.count() > 0


def good(text):
    words, chars, symbols, dup_lines, repeated = measures(text)
    lines = sum(1 for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line))
    return not (
        words < 20 or 100 * repeated > 30 * words or 10 * symbols > words or 3 * dup_lines > lines
        or 10 * sum(c.isupper() for c in text) > 4 * chars or not 2 * words <= chars <= 14 * words
        or 2 * sum(c.isalpha() for c in text) < chars
    )


def occurs(item, text):
    """Whether some part of a text is within the edit budget of an item."""
    fold = lambda t: np.array([ord(c) for c in " ".join(t.lower().split())])
    a, b = fold(item), fold(text)
    budget = min(int(decontaminate.EDITS * len(a)), (len(a) - decontaminate.Q) // decontaminate.Q)
    steps = np.arange(len(b) + 1)
    row = np.zeros(len(b) + 1, np.int64)
    for i, char in enumerate(a.tolist(), 1):
        new = np.append(i, np.minimum(row[:-1] + (b != char), row[1:] + 1))
        row = np.minimum.accumulate(new - steps) + steps
        if row.min() > budget:
            return False
    return True


def without(text):
    rules = [(p, keep, flags) for _, p, keep, flags in SECRETS] + [(p, lambda m: True, 0) for _, p, _ in secretscan.MORE_RULES]
    gone = bytearray(len(text))
    for pattern, keep, flags in rules:
        for m in re.finditer(pattern, text, flags):
            if keep(m):
                gone[m.start() : m.end()] = b"\1" * (m.end() - m.start())
    return "".join(c for c, g in zip(text, gone) if not g)


def test_pipeline_equals_plain_rules(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    items = [r.text for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    kept = {r.doc_id: r.text for r in docs if good(r.text)}
    groups = brute_components({i: fingerprint(t) for i, t in kept.items()})
    kept = {i: t for i, t in kept.items() if groups[i] == i}
    kept = {i: without(t) for i, t in kept.items() if not any(occurs(item, t) for item in items)}
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, DATA).collect()}
    assert out == {i: encoding.encode_ordinary(t) for i, t in kept.items()}
    assert 0 < len(out) < len(docs)


def test_stages_take_awkward_documents(spark):
    rows = [(None, None, None, None, None, "x"), (1, None, "en", "s", 3, None), (2, "", "en", None, 0, "y"), (2, "", "en", None, 0, "y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, leaks string")
    for frame in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, frame, DATA)
            assert out.columns == docs.columns, name
            assert out.count() <= frame.count()
        assert corpus_pipeline.STAGES[-1][1](spark, frame, DATA).count() == frame.count()
    assert corpus_pipeline.keep_one_of_each(spark, docs, DATA).count() == 1


def test_stages_keep_the_values_of_columns_with_any_name(spark):
    names = ["rejected_by", "_key", "_place", "key", "place", "label", "fp", "blob", "Leaks", "found", "_text", "_whole_text", "_leaks0", "a.b", "words"]
    text = " ".join(f"plain{k} words of a clean text," for k in range(12)) + " and the end."
    rows = [(i, f"{text} {'again ' * i}", *[f"{n}{i}" for n in names]) for i in (1, 2)]
    schema = "doc_id bigint, text string, " + ", ".join(f"`{n}` string" for n in names)
    docs = spark.createDataFrame(rows + [(3, None, *names)], schema)
    told = {r[0]: tuple(r)[2:] for r in docs.collect()}
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, DATA)
        assert kept.columns == docs.columns and kept.count() > 0, name
        assert all(tuple(r)[2:] == told[r[0]] for r in kept.collect()), name


def test_one_row_of_each_group_stays(spark):
    rng = random.Random(22)
    base, other = (" ".join(f"v{rng.randrange(5000)}" for _ in range(400)) for _ in range(2))
    far = " ".join(f"w{rng.randrange(5000)}" for _ in range(400))
    rows = [(3, base), (5, base), (5, other), (6, other), (8, far), (8, far), (8, f"{far} "), (None, base), (None, "alone at last"), (None, "alone at last")]
    groups = brute_components({k: fingerprint(t) for k, (_, t) in enumerate(rows)})
    assert len(set(groups.values())) == 4
    docs = documents(spark, rows)
    kept = sorted((r.doc_id or 0, r.text.strip()) for r in corpus_pipeline.keep_one_of_each(spark, docs, "").collect())
    assert kept == sorted([(3, base), (5, other), (8, far), (0, "alone at last")])
