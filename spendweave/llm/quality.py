"""Quality rules as a cascade that stops at the first rule that rejects.

Each rule is an SQL condition under which a text is rejected. On a bounded sample the
cascade measures what a rule costs and how much it rejects, and puts rules with much
rejection per cost first. The order only saves work: a text is kept if no rule rejects it.

Everything is built-in SQL: no Python runs on the executors.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendweave.llm.native import WORD, text_of

#: Cost and selectivity are estimated on so many texts of at most so many bytes. Results do not depend on it.
SAMPLE_ROWS, SAMPLE_BYTES = 500, 100_000

WORDS = f"regexp_extract_all(_text, r'{WORD}', 0)"
LINES = r"filter(split(_text, '\n'), l -> l RLIKE r'" + WORD + "')"
N_SYMBOLS = "cast(regexp_count(_text, '[#*$%&|<>]') AS bigint)"
WORD_CHARS = r"cast(length(translate(_text, ' \u0009\u000A\u000B\u000C\u000D', '')) AS bigint)"
N_DUP_LINES = f"transform(array({LINES}), l -> cast(size(l) - size(array_distinct(l)) AS bigint))[0]"

# Windows of eight words by hash. Texts whose windows all differ, most of them, need no more;
# the others sort windows with their places and add up what repeated windows cover.
WINDOW = 8
N_REPEAT_WORDS = f"""transform(array(CASE WHEN size(words) < {WINDOW} THEN array() ELSE
    transform(sequence(1, size(words) - {WINDOW - 1}), i -> xxhash64(slice(words, i, {WINDOW}))) END), h ->
  CASE WHEN size(array_distinct(h)) = size(h) THEN 0L ELSE
    transform(array(array_sort(transform(h, (x, i) -> named_struct('x', x, 'i', i)))), s ->
      transform(array(array_sort(transform(
          filter(s, (e, k) -> (k > 0 AND get(s, k - 1).x = e.x) OR (k < size(s) - 1 AND get(s, k + 1).x = e.x)),
          e -> e.i))), p ->
        aggregate(p, named_struct('end', 0, 'n', 0L),
          (a, i) -> named_struct('end', i + {WINDOW}, 'n', a.n + i + {WINDOW} - greatest(a.end, i)),
          a -> a.n))[0])[0] END)[0]"""


EXPRESSIONS = {
    "n_words": "cast(size(words) AS bigint)",
    "word_chars": WORD_CHARS,
    "n_symbols": N_SYMBOLS,
    "n_dup_lines": N_DUP_LINES,
    "n_repeat_words": N_REPEAT_WORDS,
    "n_lines": f"size({LINES})",
    "n_capitals": r"regexp_count(_text, r'\p{Lu}')",
    "n_letters": r"regexp_count(_text, r'\p{L}')",
}
#: What measures() adds.
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Rule:
    """Rejects a text where ``rejects`` holds, an SQL condition on the names of EXPRESSIONS in braces."""

    name: str
    rejects: str

    def sql(self, measured: bool) -> str:
        """With each name as its expression, or as a column if measures() has added it."""
        return self.rejects.format(**(EXPRESSIONS | {m: m for m in MEASURES if measured}))


BASE = [
    Rule("few_words", "{n_words} < 20"),
    Rule("repeated_words", "100 * {n_repeat_words} > 30 * {n_words}"),
]
RULES = [
    *BASE,
    Rule("symbols", "10 * {n_symbols} > {n_words}"),
    Rule("repeated_lines", "3 * {n_dup_lines} > {n_lines}"),
    Rule("capitals", "10 * {n_capitals} > 4 * {word_chars}"),
    Rule("word_length", "NOT {word_chars} BETWEEN 2 * {n_words} AND 14 * {n_words}"),
    Rule("letters", "2 * {n_letters} < {word_chars}"),
]


def _of_words(body: str) -> Column:
    """An expression that reads the array ``words``. Bound in place, so that the optimiser, when it
    moves the expression, cannot put the split into a lambda that runs for each word."""
    return F.expr(f"transform(array({WORDS}), words -> {body})[0]")


def _verdict(rules, measured: bool) -> str:
    return "CASE " + " ".join(f"WHEN {r.sql(measured)} THEN '{r.name}'" for r in rules) + " END"


def _with_text(docs: DataFrame, text: str) -> DataFrame:
    return docs.drop("_text").withColumn("_text", text_of(text))


def ordered_rules(docs: DataFrame, rules=RULES, text: str = "text") -> list[Rule]:
    """Rules by falling rejection per second, both measured on a bounded sample."""
    sample = docs.select(text_of(text).alias("text")).where(f"octet_length(text) <= {SAMPLE_BYTES}")
    rows = sample.take(SAMPLE_ROWS)
    if not rows:
        return list(rules)
    frame = _with_text(docs.sparkSession.createDataFrame(rows, "text string"), "text")

    def timed(condition: str) -> tuple[int, float]:
        best = float("inf")
        for _ in range(2):  # the first run also compiles
            began = time.perf_counter()
            rejected = frame.agg(F.count_if(_of_words(condition))).first()[0]
            best = min(best, time.perf_counter() - began)
        return rejected, best

    idle = timed("false")[1]
    ranked = []
    for i, rule in enumerate(rules):
        rejected, seconds = timed(rule.sql(measured=False))
        ranked.append((-rejected / max(seconds - idle, 1e-3), i))
    return [rules[i] for _, i in sorted(ranked)]


def cascade(docs: DataFrame, rules=RULES, text: str = "text") -> DataFrame:
    """``docs`` with ``rejected_by``: the name of the first rule that rejects, or null.

    A null text is the empty text, which has no words. Columns ``_text`` and ``rejected_by`` of
    ``docs`` are replaced. Rows repeat as they are given.
    """
    out = _with_text(docs.drop("rejected_by"), text)
    return out.withColumn("rejected_by", _of_words(_verdict(rules, False))).drop("_text")


def measured_cascade(docs: DataFrame, rules=RULES, text: str = "text") -> DataFrame:
    """As cascade(), but with the columns of MEASURES for every row, which rules then read."""
    out = _with_text(docs.drop("rejected_by", "_measures", *MEASURES), text)
    fields = ", ".join(f"'{m}', {EXPRESSIONS[m]}" for m in MEASURES)
    out = out.withColumn("_measures", _of_words(f"named_struct({fields})")).select("*", "_measures.*")
    return out.withColumn("rejected_by", F.expr(_verdict(rules, True))).drop("_text", "_measures")


def digest(judged: DataFrame) -> DataFrame:
    """The measures, the base verdict and the whole verdict per row of a measured cascade."""
    failed = " OR ".join(r.sql(measured=True) for r in BASE)
    return judged.selectExpr(
        "doc_id", *MEASURES, f"{failed} AS base_failed", "rejected_by IS NULL AS kept"
    )
