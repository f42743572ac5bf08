"""Main text of web pages: rules on blocks in two passes.

A page is cut into blocks at block-level tags. The first pass judges each by its own features: the
density of stop words, its length, the share of its characters that are link text, its punctuation where a page is in a
language without stop words here, and what the elements around it are called (menu, footer, sidebar, notice, advert, form,
comments). The second pass gives blocks that are too short, or not clear, the label of the nearest decided neighbours.
Near is measured along the page, where the bounds of sections and the start of a heading count as several blocks, so
that a heading goes with what follows it and a footer's neighbours do not decide about a last short paragraph.

A mark such as ``<article>`` is evidence, not the answer: it holds where the first pass finds most of the page's
good text inside. Then the mark's edges are good neighbours and what stands outside is not main text; else the mark is
ignored. A page on which nothing is decided, so one without a menu, a footer or a long block, is its own text.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendweave.llm.batches import small_batches

# Frequent function words of four languages.
STOP_WORDS = frozenset(
    """
    a an and are as at be been but by can for from had has have he her his i in is it its no not of on one or our
    she so than that the their them there these they this to was we were what which who will with would you
    à au aux avec ce ces dans de des du elle en est et eux il ils je la le les leur lui mais ne nous on ont ou où
    par pas pour qu que qui sa se ses son sont sur un une vous y
    aber als am auch auf aus bei bis das dass dem den der des die durch ein eine einem einen einer er es für hat
    ich ihr im in ist mit nach nicht noch nur oder sich sie sind so über um und uns von vor war wie wir zu zum zur
    al como con de del el ella en entre era es esta este ha hay la las lo los más me mi muy no o para pero por que
    se sin sobre son su sus también un una y ya
    """.split()
)
# Tags.
RAW = "script|style|noscript|template|iframe|object|svg|canvas|textarea|select|button|title|math|audio|video"
BAD_TAGS = frozenset("nav footer aside form head menu dialog".split())
CONTAINERS = frozenset("html head body main article section div nav header footer aside form menu dialog ul ol dl table span fieldset".split())
BLOCKS = CONTAINERS - {"span"} | frozenset(
    "p h1 h2 h3 h4 h5 h6 li dt dd tr td th thead tbody tfoot caption blockquote pre figure figcaption hr br address details summary center".split()
)
BAD_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog alertdialog menu menubar toolbar".split())
BAD_NAMES = frozenset(
    """
    ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies
    disqus footer masthead menu menus modal nav navbar navigation newsletter notice notices notification overlay pager
    pagination popup promo promoted promotion recommended related replies reply respond share sharing sidebar signup
    skip social sponsor sponsored subscribe teaser toolbar widget widgets
    """.split()
)

# Words at the end of a name that say nothing of what an element holds, and names that deny what follows.
PLAIN_NAMES = frozenset(
    """
    area bar block bottom box center column container content group inner item items left link links list main outer panel
    right row section site slot top unit wrap wrapper
    """.split()
)
DENYING_NAMES = frozenset("has have hide is no non not with without".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose bounds set blocks apart.
SECTIONS = frozenset("main article section div nav header footer aside form menu dialog".split())

#: Blocks of fewer characters are not decided alone; blocks of stop words with as many more are surely good.
SHORT, LONG = 70, 200
#: Stop words among a good block's words, and link text among its characters.
STOP_DENSITY, LINK_DENSITY = 0.2, 0.3
#: From so many stop words on, or with an end of a sentence every so many characters, a longer block is unclear, not bad.
FEW_STOP_WORDS, SENTENCE = 0.05, 400
#: Below so many stop words in all long blocks, a page's language is none of the four.
OTHER_LANGUAGE = 0.08
#: How many blocks apart the bound of a section and the start of a heading set two blocks.
BOUND_GAP, HEADING_GAP = 8, 16

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attributes>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_WIDE = re.compile("[\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uac00-\ud7af]")
_SENTENCE = re.compile("[.!?\u2026\u3002\uff01\uff1f\u061f\u06d4\u0964](?=[\"'\u00bb\u201c\u201d)\u300d\\s]|$)|[\u3002\uff01\uff1f]")


@dataclass
class Block:
    """White space in ``text`` is one space each; ``place`` grows along the page, by more where blocks are apart."""

    text: str
    link_chars: int
    bad: bool
    in_article: bool
    place: int = 0
    heading: bool = False
    is_title: bool = False

    @cached_property
    def stop_words(self) -> tuple[int, int]:
        """Stop words and words."""
        words = re.findall(r"\w+", self.text.lower())
        return sum(w in STOP_WORDS for w in words), len(words)


def _bad_name(name: str) -> bool:
    """Whether one name of a class list says that an element holds no main text.

    The last word that says something decides, as it does in English: a site-footer and a
    comment-list are bad, an ad-free text, a social-policy and what has-sidebar are not.
    """
    words = [w.lower() for w in _NAME.findall(name)]
    if not words or words[0] in DENYING_NAMES:
        return False
    while len(words) > 1 and (words[-1] in PLAIN_NAMES or words[-1].isdigit() or len(words[-1]) == 1):
        words.pop()
    return words[-1] in BAD_NAMES


def _is_bad(tag: str, attributes: str, in_article: bool) -> bool:
    """Whether an element holds no main text by what it is called."""
    if tag in BAD_TAGS or tag == "header" and not in_article:
        return True
    if not attributes:
        return False
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none", value):
            return True
        if name == "role" and value.lower() in BAD_ROLES:
            return True
        if name in ("class", "id") and tag not in ("html", "body", "main"):
            names = value.split()
            if any(map(_bad_name, names)) or "header" in names and not in_article:
                return True
    return False


def blocks(page: str) -> list[Block]:
    """The blocks of a page in its order."""
    out: list[Block] = []
    parts: list[str] = []
    linked = bad = articles = mains = place = 0
    links, bad_paragraph, heading = 0, False, ""
    title = ""
    stack: list[tuple[str, bool]] = []
    open_tags: Counter[str] = Counter()
    has_article = re.search(r"<article\b", page, re.I) is not None

    def text(piece: str) -> None:
        nonlocal linked
        if piece:
            piece = html.unescape(piece)
            parts.append(piece)
            if links:
                linked += len("".join(piece.split()))

    def close() -> None:
        nonlocal linked, bad_paragraph, heading, place
        if joined := " ".join("".join(parts).split()):
            inside = articles > 0 if has_article else mains > 0
            is_bad = bad > 0 or bad_paragraph
            place += HEADING_GAP if heading else 1
            is_title = heading == "h1" and not is_bad and bool(title) and (joined in title or title in joined)
            out.append(Block(joined, linked, is_bad, inside, place, bool(heading), is_title))
        parts.clear()
        linked, bad_paragraph, heading = 0, False, ""

    at = 0
    for token in _TOKEN.finditer(page):
        text(page[at : token.start()])
        at = token.end()
        tag = (token["tag"] or "").lower()
        if not tag:
            if token["raw"] and token["raw"].lower() == "title":
                close()
                if not title:
                    inner = token[0].partition(">")[2].rpartition("<")[0]
                    title = " ".join(html.unescape(inner).split())
            continue
        if tag in BLOCKS:
            close()
        if tag in SECTIONS:
            place += BOUND_GAP
        if tag == "a":
            links = 0 if token["end"] else 1
        elif tag in CONTAINERS:
            if token["end"]:
                if open_tags[tag]:
                    while True:  # elements left open end with the one around them
                        ended, was_bad = stack.pop()
                        open_tags[ended] -= 1
                        bad -= was_bad
                        articles -= ended == "article"
                        mains -= ended == "main"
                        if ended == tag:
                            break
                    links = 0
            elif not token["attributes"].endswith("/"):
                is_bad = _is_bad(tag, token["attributes"], articles > 0)
                stack.append((tag, is_bad))
                open_tags[tag] += 1
                bad += is_bad
                articles += tag == "article"
                mains += tag == "main"
        elif tag in BLOCKS and not token["end"]:
            heading = tag if tag in HEADINGS else ""
            bad_paragraph = bool(token["attributes"]) and _is_bad(tag, token["attributes"], articles > 0)
    text(page[at:])
    close()
    return out


def _size(text: str) -> int:
    """Length in letters of an alphabet; a syllable or word sign is about three of those."""
    return len(text) if text.isascii() else len(text) + 2 * len(_WIDE.findall(text))


def _linked(block: Block) -> bool:
    return block.link_chars > LINK_DENSITY * len(block.text)


def in_other_language(page_blocks: list[Block]) -> bool:
    """Whether the stop words are silent on a page, so that sentences have to tell."""
    counts = [b.stop_words for b in page_blocks if not b.bad and not _linked(b) and _size(b.text) >= SHORT]
    return sum(n for n, _ in counts) < OTHER_LANGUAGE * sum(n for _, n in counts)


def first_pass(block: Block, other_language: bool = False) -> str:
    """good, bad, near (good if anything near is) or short (as what is near)."""
    size = _size(block.text)
    if block.bad or _linked(block):
        return "bad"
    if block.is_title:
        return "good"
    if size < SHORT:
        return "bad" if block.text.startswith("\u00a9") else "short"
    found, words = block.stop_words
    if block.heading:
        return "short"
    if not other_language and found >= STOP_DENSITY * max(words, 1):
        return "good" if size >= LONG else "near"
    sentences = len(_SENTENCE.findall(block.text)) * SENTENCE >= size
    if other_language and sentences:
        return "good" if size >= LONG else "near"
    unclear = block.in_article or sentences or found >= FEW_STOP_WORDS * words > 0
    return "short" if unclear else "bad"


def second_pass(labels: list[str], edge: str, places: list[int] | None = None) -> list[str]:
    """Short blocks take the label of both decided neighbours, or where these differ that of
    the nearer one, the one before on a tie; near ones are good if either is. ``places`` say how far
    blocks stand apart (one, if not given); beyond both ends stands ``edge``, one section's bound away."""
    n = len(labels)
    places = list(range(n)) if places is None else places
    far = BOUND_GAP if n else 0
    before, after = [(edge, 0)] * n, [(edge, 0)] * n
    last = (edge, places[0] - far) if n else (edge, 0)
    for i, label in enumerate(labels):
        before[i] = (last[0], places[i] - last[1])
        if label in ("good", "bad"):
            last = (label, places[i])
    last = (edge, places[-1] + far) if n else (edge, 0)
    for i in range(n - 1, -1, -1):
        after[i] = (last[0], last[1] - places[i])
        if labels[i] in ("good", "bad"):
            last = (labels[i], places[i])
    out = []
    for label, (left, far_left), (right, far_right) in zip(labels, before, after):
        if label == "near":
            label = "good" if "good" in (left, right) else "bad"
        elif label == "short":
            label = left if left == right or far_left <= far_right else right
        out.append(label)
    return out


def _mark_holds(found: list[Block], labels: list[str]) -> bool:
    """Whether the marked article has at least as much good text, or good neighbourhood, as all the rest."""
    inside = sum(len(b.text) for b, label in zip(found, labels) if b.in_article and label != "bad")
    outside = sum(len(b.text) for b, label in zip(found, labels) if not b.in_article and label == "good")
    return inside > 0 and inside >= outside


def main_text(page: str) -> str:
    """The page's main text; empty where it has none."""
    found = blocks(page)
    other = in_other_language(found)
    labels = [first_pass(b, other) for b in found]
    if _mark_holds(found, labels):  # a bad part of an article says nothing about what stands beside it
        kept = [(b, label) for b, label in zip(found, labels) if b.in_article and not b.bad]
        edge = "good"
    else:
        kept = list(zip(found, labels))
        edge = "bad" if "good" in labels or "bad" in labels else "good"
    decided = second_pass([label for _, label in kept], edge, [b.place for b, _ in kept])
    return " ".join(b.text for (b, _), label in zip(kept, decided) if label == "good")


def _extract(names: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        last = batch.num_columns - 1
        texts = [main_text(page or "") for page in batch.column(last).to_pylist()]
        made = [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
        columns = [batch.column(i) for i in range(last)] + made
        yield pa.RecordBatch.from_arrays(columns, [*names, "text", "n_chars"])


def extract(pages: DataFrame, markup: str = "html") -> DataFrame:
    """``pages`` without its markup, with ``text`` and ``n_chars`` added; no row is shuffled.

    A null page is the empty page, whose text is empty. Columns with the names of the added
    ones are replaced. Rows repeat as they are given. Pages of any length are read whole.
    """
    small_batches(pages.sparkSession)
    gone = {markup.lower(), "text", "n_chars"}
    kept = [f for f in pages.schema.fields if f.name.lower() not in gone]
    own = pages.select(*[F.col(f"`{f.name}`") for f in kept], F.col(f"`{markup}`").cast("string"))
    declared = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)
    numbered = own.toDF(*[f"c{i}" for i in range(len(own.columns))])  # a dot in a name would be read as a field
    return numbered.mapInArrow(partial(_extract, [f.name for f in kept]), f"{declared}text string, n_chars bigint")
