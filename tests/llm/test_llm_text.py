"""BPE, HTML, token shards, decontamination, WARC, SimHash and repeats against plain rules."""

import base64
import hashlib
import html
import itertools
import json
import random
import re
import struct
import time
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken
import xxhash
import zstandard
from texts import WORD, awkward, documents, prose
from tokenizers import Tokenizer

from spendweave.llm import bpe, components, decontaminate, htmltext, repair, simhash, suffix, warc

ODD = ["a", "s", "t", "re", "ll", "'", " ", "  ", "\n", "\t", " ", "1", "²", "é", "!", "''", "中", "😀", "ve", "\x1c", "x.", "y,", ".\n"]


def odd_texts(rng, n):
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 25))) for _ in range(n)]


@pytest.fixture(scope="module")
def encoding():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_are_those_of_the_reference_library(encoding):
    rng = random.Random(1)
    texts = odd_texts(rng, 3000) + ["", "a" * 3000, " " * 2000, "'" * 300, "!" * 700, "é'll " * 400]
    own = bpe.codec(public_tokenizers.path(bpe.RANKS))
    for group in (texts, texts[:1], []):
        for text, (ids, offsets) in zip(group, own.encode(group), strict=True):
            assert ids.tolist() == encoding.encode_ordinary(text)
            assert own.decode(ids, offsets) == text.encode() and offsets[-1] == len(text.encode())


def test_scan_equals_stepping(encoding):
    rng = random.Random(2)
    symbols = np.array([rng.randrange(9) for _ in range(1500)], np.uint8)
    state, states = bpe.FRESH, []
    for s in symbols.tolist():
        states.append(state)
        state = bpe._step(state, s)
    assert bpe.states_before(symbols).tolist() == states


def test_round_trip_of_awkward_rows(spark, encoding):
    rows = awkward(random.Random(3))
    out = bpe.round_trip(documents(spark, rows)).collect()
    want = Counter()
    for i, text in rows:
        ids = encoding.encode_ordinary(text or "")
        raw = np.array(ids, "<u4").tobytes()
        want[i, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in out) == want
    assert bpe.encode(documents(spark, [])).count() == 0
    encoded = bpe.encode(documents(spark, [(1, "é two")])).first()
    assert encoded.id_offsets[0] == 0 and encoded.id_offsets[-1] == len("é two".encode()) and encoded.found == "x"


def test_pieces_are_encoded_as_whole_texts():
    own = repair.Pieces(public_tokenizers.path(repair.TOKENIZER))
    plain = Tokenizer.from_file(public_tokenizers.path(repair.TOKENIZER))
    plain.encode_special_tokens = True  # as the tokenizer files are documented: the token's name in a text is ordinary text
    for text in odd_texts(random.Random(4), 3000) + ["", " ", "a  b", "<|endoftext|> x", "one <|endoftext|> two"]:
        assert np.frombuffer(own.encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


class Counted:
    """Counts the calls of an object's methods."""

    def __init__(self, of):
        self.of, self.calls = of, 0

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.calls += 1
            return getattr(self.of, name)(*args, **kwargs)

        return call


def test_new_words_reach_the_library_together():
    rng = random.Random(8)
    own = repair.Pieces(public_tokenizers.path(repair.TOKENIZER))
    plain = Tokenizer.from_file(public_tokenizers.path(repair.TOKENIZER))
    own.model, own.tokenizer = Counted(own.model), Counted(own.tokenizer)
    words = ["".join(rng.choices("aeinorstéß", k=rng.randint(2, 9))) + rng.choice(["", "", ".", ",", "!!", "7"]) for _ in range(20_000)]
    text = " ".join(words).replace("! ", "!\n")
    assert np.frombuffer(own.encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids
    assert own.model.calls + own.tokenizer.calls < 20


def test_groups_of_texts_are_encoded_as_each_text():
    rng = random.Random(9)
    own = repair.Pieces(public_tokenizers.path(repair.TOKENIZER))
    odd = [*ODD, "one", "Two.", "three,", "don't", "'s", "l'eau", "a\0b", "\0", "\0\n", "x\n", "Ünd", "ДА", "东京", "ᲊ", "a_b", "1²", "x\x1cy", "“¿qué?”", "—", "\xa0", "\u2028", "<|endoftext|>"]
    for _ in range(150):
        texts = ["".join(rng.choice(odd) + rng.choice(["", " ", " ", "\n"]) for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(0, 12))]
        texts = [rng.choice([t, t.strip(), None]) for t in texts]
        assert [x.tolist() for x in own.encode_all(texts)] == [own.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_letters_and_signs_are_those_of_the_library():
    cut = Tokenizer.from_file(public_tokenizers.path(repair.TOKENIZER)).pre_tokenizer.pre_tokenize_str
    every = "".join(map(chr, range(1, 0xD800)))
    letters, signs = (re.findall(f"[{some}]", every) for some in (repair._LETTERS, repair._SIGNS))
    assert len(letters) > 39_000 and len(signs) > 120
    assert [c for c in letters if len(cut("a" + c)) != 1] == [] == [c for c in signs if len(cut("!" + c)) != 1]


def test_a_model_that_may_merge_otherwise_gets_whole_pieces(tmp_path):
    raw = json.loads(open(public_tokenizers.path(repair.TOKENIZER), encoding="utf-8").read())
    raw["model"]["ignore_merges"] = True
    path = tmp_path / "other.json"
    path.write_text(json.dumps(raw), encoding="utf-8")
    own, text = repair.Pieces(str(path)), "The words, as they are.\nAnd more!"
    assert not own.direct
    assert np.frombuffer(own.encode(text), "<u4").tolist() == Tokenizer.from_file(str(path)).encode(text, add_special_tokens=False).ids


def test_rules_are_those_of_counting_all_pairs_in_every_round(monkeypatch):
    monkeypatch.setattr(repair, "ROUND_RULES", 7)
    ids = np.minimum(np.random.default_rng(10).zipf(1.4, 4000), 60)
    rules, sequence = repair.compress(ids.astype(np.uint32), 100)
    want, made = ids.tolist(), []
    while True:
        counts = Counter(zip(want, want[1:]))
        often = sorted((-n, pair) for pair, n in counts.items() if n >= repair.LEAST_COUNT)[:7]
        if not often:
            break
        symbols = {pair: 0 for pair in sorted(pair for _, pair in often)}
        # places of chosen pairs; in a chain of such places every other one from its first
        at, before, places = [k for k, pair in enumerate(zip(want, want[1:])) if pair in symbols], -2, []
        for k in at:
            places += [k] if before != k - 1 else []
            before = k if before != k - 1 else -2
        used = sorted({(want[k], want[k + 1]) for k in places})
        for k in places:
            want[k : k + 2] = [100 + len(made) + used.index((want[k], want[k + 1])), None]
        want = [x for x in want if x is not None]
        made += used
    assert list(map(tuple, rules.tolist())) == made and sequence.tolist() == want


def test_rules_are_made_until_no_pair_pays():
    rng = np.random.default_rng(6)
    passage = rng.integers(0, 50_000, 2000).astype(np.uint32)
    inputs = [np.tile(passage, 100), np.ones(5000, np.uint32), np.minimum(rng.zipf(1.3, 40_000), 400).astype(np.uint32), passage[:1], passage[:0]]
    for ids in inputs:
        rules, sequence = repair.compress(ids, 50_257)
        pairs = Counter(zip(sequence[:-1].tolist(), sequence[1:].tolist()))
        assert not pairs or max(pairs.values()) < repair.LEAST_COUNT
        shard = repair.unpack(repair.pack([1], [ids], 50_257))
        assert shard.document(0).tolist() == ids.tolist()
    assert len(repair.pack([1], inputs[:1], 50_257)) < len(inputs[0]) // 4


def test_leftover_pairs_with_one_hash_are_counted(monkeypatch):
    monkeypatch.setattr(repair, "_TABLE_BITS", 3)
    monkeypatch.setattr(repair, "ROUND_RULES", 4)
    ids = np.minimum(np.random.default_rng(7).zipf(1.4, 5000), 60).astype(np.uint32)
    _, sequence = repair.compress(ids, 100)
    assert max(Counter(zip(sequence[:-1].tolist(), sequence[1:].tolist())).values()) < repair.LEAST_COUNT
    shard = repair.unpack(repair.pack([1], [ids], 100))
    assert shard.document(0).tolist() == ids.tolist()


def test_shards_decode_at_any_document():
    rng = np.random.default_rng(5)
    docs = [np.minimum(rng.zipf(1.5, n), 90).astype(np.uint32) for n in [0, 1, 5000, 300, 0, 7000]]
    raw = repair.pack([None, 1, 2, 3, 4, 5], docs, 100)
    shard = repair.unpack(raw)
    assert len(shard.rules) and len(raw) < 4 * sum(map(len, docs))
    assert shard.expand(shard.sequence.astype(np.int64)).tolist() == np.concatenate(docs).tolist()
    for k, ids in enumerate(docs):
        assert shard.document(k).tolist() == ids.tolist()
    assert shard.read(4000, 1500).tolist() == np.concatenate(docs)[4000:5500].tolist()
    with pytest.raises(ValueError):
        repair.unpack(raw[:-1])
    assert repair.unpack(repair.pack([], [], 100)).lengths.tolist() == []


def test_shards_hold_all_documents_in_order(spark, monkeypatch):
    rows = [r for r in awkward(random.Random(6)) if r[0] is not None] + [(i, prose(random.Random(i), 20)) for i in range(50, 120)]
    tokenizer = Tokenizer.from_file(public_tokenizers.path(repair.TOKENIZER))
    out = sorted(map(tuple, repair.read_shards(repair.write_shards(documents(spark, rows))).collect()), key=lambda r: r[1])
    at = 0
    for doc_id, start, n, crc in out:
        assert start == at
        at += n
    assert [r[0] for r in out] == sorted(i for i, _ in rows)
    want = Counter()
    for i, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        want[i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert Counter((r[0], r[2], r[3]) for r in out) == want
    assert repair.read_shards(repair.write_shards(documents(spark, []))).count() == 0
    assert repair.read_shards(repair.write_shards(documents(spark, [(None, None), (None, "x")]))).count() == 2


def edited(rng, text, n):
    out = list(text)
    for _ in range(n):
        p, kind = rng.randrange(len(out)), rng.randrange(3)
        out[p : p + (kind != 2)] = [] if kind == 1 else [rng.choice("qxz")]
    return "".join(out)


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_leaks_within_the_edit_budget(spark):
    rng = random.Random(7)
    items = [(k, prose(random.Random(100 + k), 25)) for k in range(12)]
    rows, planted = awkward(rng), set()
    for doc_id in range(20, 80):
        text = prose(rng, 40)
        if doc_id % 2:
            k, passage = rng.choice(items)
            size = len(" ".join(passage.lower().split()))
            change = rng.randint(0, int(decontaminate.EDITS * size))
            cut = rng.randrange(len(text))
            inside = edited(rng, passage, change)
            text = text[:cut] + "\n" + inside + " " + text[cut:]
            # an edit may also join two runs of white space, which counts once more
            if edit_distance(" ".join(passage.lower().split()), " ".join(inside.lower().split())) <= int(decontaminate.EDITS * size):
                planted.add((doc_id, k))
        rows.append((doc_id, text))
    exact = [(None, "x"), (51, "house  marks"), (52, "of The stone and it. "), (53, "到")]
    planted |= {(i, k) for i, t in rows for k, item in exact if " ".join(item.lower().split()) in " ".join((t or "").lower().split())}
    table = spark.createDataFrame([*items, *exact, (50, None), (54, ""), (55, " \n")], "item_id bigint, text string")
    found = decontaminate.digest(decontaminate.mark(documents(spark, rows), table)).collect()
    assert {(r.doc_id, r.item_id) for r in found} == planted
    assert {(None, 6), (51, 5), (53, 5)} <= {(r.item_id, r.doc_id) for r in found}
    found = [r for r in found if r.item_id in dict(items)]
    texts = dict(rows)
    for r in found:
        fold = lambda t: " ".join(t.lower().split())
        a, b = fold(dict(items)[r.item_id]), fold(texts[r.doc_id][r.start : r.stop])
        assert edit_distance(a, b) <= r.edits + 1 <= decontaminate.EDITS * len(a) + 1
    assert len(planted) > 20
    assert decontaminate.mark(documents(spark, []), table).count() == 0
    none = decontaminate.mark(documents(spark, rows), table.where("item_id > 1000"))
    assert none.where("size(leaks) > 0").count() == 0 and none.count() == len(rows)


def best_place(item, text):
    """(edits, start, stop) of the occurrence with fewest edits, of these with the smallest start, then stop."""
    row = [(0, j) for j in range(len(text) + 1)]
    for i, x in enumerate(item, 1):
        last, row[0] = row[0], (i, 0)
        for j, y in enumerate(text, 1):
            ways = (last[0] + (x != y), last[1]), (row[j][0] + 1, row[j][1]), (row[j - 1][0] + 1, row[j - 1][1])
            last, row[j] = row[j], min(ways)
    return min((cost, start, stop) for stop, (cost, start) in enumerate(row))


@pytest.mark.parametrize("hits", [1 << 22, 64])
def test_places_and_edits_equal_full_alignment(monkeypatch, hits):
    monkeypatch.setattr(decontaminate, "TOGETHER_HITS", hits)
    rng, letters = random.Random(9), "abcdefgh ij"
    letter = lambda n: "".join(rng.choice(letters) for _ in range(n))
    items = [(k, letter(rng.randint(1, 90))) for k in range(40)] + [(90, "ab" * 20), (91, "which of the following"), (92, "a")]
    texts = []
    for _ in range(60):
        item = rng.choice(items)[1]
        texts.append(letter(rng.randint(0, 60)) + edited(rng, item, rng.randint(0, len(item) // 9)) + letter(rng.randint(0, 60)))
    texts += ["", " ", "ab" * 70, "which of the following " * 5, "which of the followinG", "ij" * 30]
    fold = lambda t: " ".join(t.split())
    texts, own = [fold(t).lower() for t in texts], decontaminate.index(items)
    got = decontaminate.leaks(texts, own)
    want = []
    for text in texts:
        want.append([])
        for k, item in items:
            item = fold(item)
            if item and text:
                cost, start, stop = best_place(item, text)
                budget = 0 if len(item) < decontaminate.LEAST_CHARS else min(int(len(item) * decontaminate.EDITS), len(item) // 8 - 1)
                if cost <= budget:
                    want[-1].append({"item_id": k, "start": start, "stop": stop, "edits": cost})
    assert got == want and sum(map(len, want)) > 60


def test_phrase_that_all_items_share():
    rng = random.Random(10)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 9))) for _ in range(500)]
    items = [(k, "which of the following " + " ".join(rng.choice(words) for _ in range(12))) for k in range(200)]
    text = " ".join("which of the following " + " ".join(rng.choice(words) for _ in range(3)) for _ in range(1000))
    tracemalloc.start()
    found = decontaminate.leaks([text + " " + items[77][1] + " end"], decontaminate.index(items))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [r["item_id"] for r in found[0]] == [77] and peak < 1 << 30


def test_items_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 200)
    items = [(k, prose(random.Random(k), 25)) for k in range(4)]
    docs = documents(spark, [(10 + k, f"before {text} after") for k, text in items])
    found = decontaminate.digest(decontaminate.mark(docs, spark.createDataFrame(items, "item_id bigint, text string")))
    assert sorted((r.doc_id, r.item_id, r.start, r.edits) for r in found.collect()) == [(10 + k, k, 7, 0) for k in range(4)]


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header class="site"><h1>Site</h1></header><nav><ul><li><a href="/a">Menu</a></li></ul></nav>
<div class="ad">The best of the offers that you have for the day.</div>
<article><h1>Head &amp; line</h1><p><b>It is the  first
of the lines.<br><p>Two&nbsp;of <i>th</i>em.</p><aside>side bar</aside><form>Name <input name="n"></form>
<p class="notice">We use cookies on this site for all of you.</p><p>Short.</p>
<section id="comments"><p>I like it and so do the others that are here.</p></section></article>
<div id="sidebar">More</div><footer>&copy; the owner of it</footer></body></html>"""


def test_main_text_of_a_marked_article():
    assert htmltext.main_text(PAGE) == "Head & line It is the first of the lines. Two of them. Short."


def test_blocks_without_an_article_are_judged_by_words_and_neighbours():
    long = "It was the best of the times and the worst of them, as we said to all who were there with us on that day. " * 3
    page = f"<body><ul><li><a href=x>One</a></li><li><a href=y>Two of the links that are in a menu</a></li></ul><h2>Head</h2><p>{long}<p>Brief.<p>{long}</p><div>Copyright</div></body>"
    text = htmltext.main_text(page)
    assert "Brief." in text and "links" not in text and "One" not in text


def test_second_pass():
    label = htmltext.second_pass
    assert label(["good", "short", "bad"], "bad") == ["good", "good", "bad"]
    assert label(["bad", "short", "short", "good"], "bad") == ["bad", "bad", "good", "good"]
    assert label(["short", "short"], "good") == ["good", "good"]
    assert label(["near", "bad"], "bad") == ["bad", "bad"] and label(["near", "good"], "bad") == ["good", "good"]
    assert label([], "good") == []


def unmarked(page):
    """A page without what its main text is called: no article, class, id or role."""
    return re.sub(r' (?:class|id|role)="[^"]*"', "", re.sub(r"</?article[^>]*>", "", page))


def test_block_rules_find_the_text_of_unmarked_pages():
    pages = [r["html"] for r in pq.read_table("/root/testdata/sf0.01/pages.parquet").to_pylist()]
    precision, recall = [], []
    for page in pages:
        inner = re.sub(r"<br>|</?(?:p|h1)>", " ", re.search(r"<article>(.*)</article>", page, re.S)[1])
        expected = " ".join(html.unescape(re.sub(r"<[^>]*>", "", inner)).split())  # the whole article, by plain replacement
        assert htmltext.main_text(page) == expected
        found, wanted = Counter(htmltext.main_text(unmarked(page)).split()), Counter(expected.split())
        both = (found & wanted).total()
        precision.append(both / found.total() if found else 0.0)
        recall.append(both / wanted.total() if wanted else 1.0)
    assert sum(precision) / len(pages) >= 0.95 and sum(recall) / len(pages) >= 0.95


def test_a_mark_holds_only_where_the_text_is():
    long = "It was the best of the times and the worst of them, as we said to all who were there with us on that day. " * 4
    body = f"<div><h2>Head</h2><p>{long}</p><p>And so on.</p></div>"
    assert htmltext.main_text(f"<nav>Menu</nav><article>More of it</article>{body}").startswith("Head It was")
    assert htmltext.main_text(f'<article>{body}</article><article class="teaser"><p>{long}</p></article>').count("It was") == 4
    assert htmltext.main_text(f'<article class="has-sidebar">{body}</article>').endswith("And so on.")


def test_names_of_elements_are_judged_by_what_they_name():
    bad = htmltext._bad_name
    assert all(map(bad, "ad ads ad-slot ad1 ad-300x250 siteFooter cookie_notice comment-list main-nav navMenu sidebar-left".split()))
    assert not any(map(bad, "ad-free social-policy has-sidebar no-comments intro adage content main-column shared".split()))
    page = '<article><p class="ad-free intro">Kept one.</p><div id="social-policy"><p>Kept two.</p></div><p class="ad">Gone.</p></article>'
    assert htmltext.main_text(page) == "Kept one. Kept two."


def test_sentences_tell_in_a_language_without_stop_words():
    russian = "Это было лучшее из времён, это было худшее из времён. Мы помним тот день, когда всё началось. " * 4
    chinese = "这是最好的时代，这是最坏的时代。我们记得那一天，一切从那里开始。" * 6
    for text in (russian, chinese):
        page = f"<nav><a href=x>Меню сайта</a></nav><div><h2>Глава</h2><p>{text}</p><p>Конец.</p></div><footer>Внизу</footer>"
        assert htmltext.main_text(page) == f"Глава {text.strip()} Конец."


def test_second_pass_against_plain_search():
    draw = random.Random(5)
    for _ in range(500):
        n = draw.randrange(12)
        labels = draw.choices(["good", "bad", "short", "near"], k=n)
        places = list(itertools.accumulate(draw.choices([1, 1, 2, 9, 17], k=n)))
        edge = draw.choice(["good", "bad"])
        far = htmltext.BOUND_GAP
        decided = [(p, label) for p, label in zip(places, labels) if label in ("good", "bad")]
        if n:
            decided = [(places[0] - far, edge), *decided, (places[-1] + far, edge)]
        expected = []
        for p, label in zip(places, labels):
            left = max((d for d in decided if d[0] < p), default=None)
            right = min((d for d in decided if d[0] > p), default=None)
            if label == "short":
                label = left[1] if p - left[0] <= right[0] - p else right[1]
            elif label == "near":
                label = "good" if "good" in (left[1], right[1]) else "bad"
            expected.append(label)
        assert htmltext.second_pass(labels, edge, places) == expected


def test_stray_end_tags_cost_no_search():
    begun = time.perf_counter()
    assert htmltext.main_text("<article>" + "<div>" * 40_000 + "</span>" * 40_000 + "Text here.") == "Text here."
    assert time.perf_counter() - begun < 10


def test_pages_of_all_kinds(spark):
    rows = [(1, None), (2, ""), (3, "plain words"), (4, "<p>unclosed <b"), (5, "<!-- open"), (6, "<script>x"), (7, PAGE), (7, PAGE), (None, "<div>" * 5000), (8, "&am")]
    pages = spark.createDataFrame([(i, "u", h, "clash") for i, h in rows], "page_id bigint, url string, html string, text string")
    named = htmltext.extract(pages.selectExpr("page_id", "'m' AS _markup", "'d' AS `a.b`", "html"))
    assert named.columns == ["page_id", "_markup", "a.b", "text", "n_chars"] and {tuple(r)[1:3] for r in named.collect()} == {("m", "d")}
    out = htmltext.extract(pages)
    assert out.columns == ["page_id", "url", "text", "n_chars"] and out.count() == len(rows)
    assert all(r.n_chars == len(r.text) for r in out.collect())
    assert htmltext.extract(pages.where("page_id > 100")).count() == 0


def test_archives(spark):
    rng = random.Random(8)
    same = prose(rng, 60)
    rows = [(i, f"http://x/{i}\nY: z", prose(rng, 50)) for i in range(100)]
    rows += [(200, None, same), (150, "u", same), (300, "u", same), (150, "u", same), (None, "u", same), (1, None, None), (2, "u", ""), (3, "u", "tiny"), (4, "u", "tiny"), (5, "u", "é" * 50_000)]
    pages = spark.createDataFrame([(*r, "c") for r in rows], "page_id bigint, url string, html string, archive string")
    archives = warc.write_archives(pages)
    out = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_archives(archives).collect())
    want = Counter()
    for i, _, page in rows:
        raw = (page or "").encode()
        late = page == same and i != 150
        want[i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if late else "response", 150 if late else None] += 1
    assert out == want
    assert warc.read_archives(warc.write_archives(pages.where("page_id > 900"))).count() == 0
    raw = archives.first().archive
    assert raw[:4] == warc.DICTIONARY_MAGIC.to_bytes(4, "little")
    for broken in (raw[:-5], raw[4:], raw[:-3] + b"abc"):
        with pytest.raises(Exception):
            list(warc.read_archive(broken))


@pytest.mark.parametrize("raw", [b"WARC/1.0\r\n\r\n\r\n\r\n", b"WARC/1.1\r\nWARC-Type: response\r\n\r\n\r\n\r\n", b"WARC/1.1\r\nnothing\r\n\r\n"])
def test_records_that_are_not_well_formed(raw):
    with pytest.raises(ValueError):
        warc.parse(raw)


def fingerprint(text):
    words = [w.encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))) for w in WORD.findall(text or "")]
    shingles = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    votes = [sum(xxhash.xxh64_intdigest(s, 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(shingles))


def test_every_pair_within_the_radius_meets():
    rng = random.Random(9)
    for tables in (simhash.masks(), simhash.masks(simhash.SECOND)):
        assert len(tables) == 15
        for _ in range(3000):
            differing = sum(1 << b for b in rng.sample(range(64), simhash.RADIUS))
            assert any(not differing & m for m in tables)


def brute_components(fps):
    ids, parent = list(fps), {i: i for i in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in ids:
        for b in ids:
            if (fps[a] ^ fps[b]).bit_count() <= simhash.RADIUS:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("bucket", [2048, 3])
def test_near_duplicates(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rng = random.Random(10)
    rows = [r for r in awkward(rng) if r[0] is not None and r[0] != 4]
    base = prose(rng, 300).split()
    for i in range(20, 60):
        words = list(base)
        for _ in range(i % 4):
            words[rng.randrange(300)] = "changed"
        rows.append((i, " ".join(words)))
    rows += [(i, prose(rng, 50)) for i in range(70, 90)]
    out = simhash.digest(simhash.near_duplicates(documents(spark, rows))).collect()
    fps = {i: fingerprint(t) for i, t in rows}
    groups = brute_components(fps)
    assert Counter(map(tuple, out)) == Counter((i, f"{fps[i]:016x}", groups[i]) for i, _ in rows)


def test_near_duplicates_without_ids_or_rows(spark):
    docs = documents(spark, [(None, "a b c"), (None, "a b c"), (5, "x y z w"), (None, "x y z w")])
    out = simhash.near_duplicates(docs).collect()
    assert sorted(((r.doc_id, r.component_id) for r in out), key=str) == [(5, 5), (None, 5), (None, None), (None, None)]
    assert simhash.near_duplicates(documents(spark, [])).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (None, 3), (101, 100)]
    frame = spark.createDataFrame(edges, "u bigint, v bigint")
    out = {r.node: r.component for r in components.components(frame).collect()}
    assert out == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 140)}}


def kept(rows):
    place = lambda i: i if i is not None else 1 << 62
    raws, first = [(i, (t or "").encode()) for i, t in rows], {}
    for i, raw in raws:
        for a in range(len(raw) - suffix.WIDTH + 1):
            w = raw[a : a + suffix.WIDTH]
            first[w] = min(first.get(w, (1 << 63, 0)), (place(i), a))
    out = []
    for i, raw in raws:
        gone = bytearray(len(raw))
        for a in range(len(raw) - suffix.WIDTH + 1):
            if first[raw[a : a + suffix.WIDTH]] < (place(i), a):
                gone[a : a + suffix.WIDTH] = b"\1" * suffix.WIDTH
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        left = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((i, len(raw), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return Counter(out)


def repeating(rng):
    base = "".join(rng.choice("abcé ") for _ in range(1200))
    rows = [(None, "x" * 250), (7, None), (8, ""), (9, "aaa" * 200), (10, "aaa" * 90), (3, base), (4, base), (4, base)]
    for i in range(20, 60):
        a = rng.randint(0, 900)
        text = base[a : a + rng.randint(50, 500)]
        middle = len(text) // 2
        rows.append((i, text if i % 3 else text[:middle] + "Z" + text[middle:]))
    return rows


@pytest.mark.parametrize("shard_bytes", [suffix.SHARD_BYTES, 700])
def test_repeats_are_removed(spark, shard_bytes):
    rows = repeating(random.Random(11))
    out = suffix.digest(suffix.remove_repeats(documents(spark, rows), shard_bytes=shard_bytes)).collect()
    assert Counter(map(tuple, out)) == kept(rows)


def test_repeats_in_nothing(spark):
    assert suffix.remove_repeats(documents(spark, [])).count() == 0


def test_index_of_a_shard():
    rng = random.Random(12)
    base = bytes(rng.choice(b"abc\0") for _ in range(400))
    for trial in range(10):
        pieces = [b"a" * 150, b"ab" * 80] if trial % 2 else []
        for _ in range(rng.randint(1, 15)):
            a = rng.randint(0, 250)
            pieces.append(base[a : a + rng.randint(90, 150)])
        seen, want = set(), []
        for piece in pieces:
            strings = [piece[k : k + suffix.WIDTH] for k in range(len(piece) - suffix.WIDTH + 1)]
            want.append([])
            for s in strings:
                want[-1].append(s in seen)
                seen.add(s)
        assert [g.tolist() for g in suffix.repeated(pieces)] == want


def test_archives_of_other_writers(spark):
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n<p>body</p>"
    body = http.partition(b"\r\n\r\n")[2]
    digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
    common = "WARC-Record-ID: <urn:uuid:1>\r\nWARC-Date: 2020-01-01T00:00:00Z"
    made = [
        ("warcinfo", b"software: x\r\n", "Content-Type: application/warc-fields"),
        ("response", http, f"Content-Type: application/http; msgtype=response\r\nWARC-Payload-Digest: sha1:{digest}\r\nWARC-Target-URI: http://a/\r\n b"),
        ("resource", b"", "X-Note: none"),
        ("revisit", b"", "WARC-Refers-To: <urn:uuid:0>"),
    ]
    records = [f"WARC/1.0\r\nWARC-Type: {kind}\r\n{common}\r\n{more}\r\nContent-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n" for kind, block, more in made]
    want = [
        ("warcinfo", 13, hashlib.sha256(made[0][1]).hexdigest(), None), ("response", 11, hashlib.sha256(body).hexdigest(), "http://a/ b"),
        ("resource", 0, hashlib.sha256(b"").hexdigest(), None), ("revisit", None, None, None),
    ]
    dictionary = zstandard.train_dictionary(2048, [b"WARC/1.0 record %d of many" % (i * 7919) * 8 for i in range(400)])

    def frames(known):
        out = []
        for record in records:  # a streaming writer does not know the size
            packer = zstandard.ZstdCompressor(dict_data=known).compressobj()
            out.append(packer.compress(record) + packer.flush())
        return out

    skipped = struct.pack("<II", 0x184D2A50, 3) + b"abc"
    archives = [
        b"".join(frames(None)), warc.leading_frame(dictionary.as_bytes()) + b"".join(frames(dictionary)),
        warc.leading_frame(zstandard.compress(dictionary.as_bytes())) + skipped.join(frames(dictionary)) + skipped,
    ]
    for archive in archives:
        table = spark.createDataFrame([(archive,), (b"",)], "archive binary")
        out = [(r.record_type, r.payload_bytes, r.payload_digest, r.url) for r in warc.read_archives(table).collect()]
        assert out == want
    changed = records[1].replace(b"body", b"bodx")
    for broken in (zstandard.compress(changed), archives[0][:-4], archives[2][:-1], zstandard.compress(b"WARC/0.9\r\n\r\n")):
        with pytest.raises(Exception):
            for headers, block in warc.read_archive(broken):
                warc.check_payload(headers, warc.payload_of(headers, block))
