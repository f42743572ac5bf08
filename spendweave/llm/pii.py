"""Personal data: patterns propose, check sums confirm, context words adjust the score.

Everything is built-in SQL: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendweave.llm.native import chunks, listed, piece, spans, text_of

# A pattern starts where the last match ended or where its first run of characters starts.
# A match cannot start later in that run, so this finds the same, in time linear in the text.
_START = r"(?:\G|(?<![{0}]))[{0}]++"
_DIGITS = "regexp_replace(s.hit, '[^0-9]', '')"

# Fixed values: (kind, pattern, what a check has to confirm). The order ranks spans that start together.
EMAIL = _START.format(r"A-Za-z0-9._%+-") + r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
BASE_RULES = [
    ("email", EMAIL, "true"),
    (
        "ip",
        _START.format("0-9") + r"(?:\.[0-9]++){3}",
        "forall(split(s.hit, '[.]'), p -> coalesce(try_cast(p AS bigint), 256) <= 255)",
    ),
    (
        "card",
        r"[0-9]++(?:[\x20-][0-9]++)*+",
        f"length({_DIGITS}) BETWEEN 14 AND 19 AND luhn_check({_DIGITS})",
    ),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 10 AND 15"),
]
# An account number moves its first four characters to the end, reads letters as 10 to 35, and is 1 modulo 97.
_MOD_97 = """aggregate(
  split(concat(substring(s.hit, 5), substring(s.hit, 1, 4)), ''), 0,
  (r, c) -> CASE WHEN c = '' THEN r WHEN c BETWEEN '0' AND '9' THEN (r * 10 + cast(c AS int)) % 97
                 ELSE (r * 100 + ascii(c) - 55) % 97 END) = 1"""
MORE_RULES = [
    ("account", r"\b[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}\b", _MOD_97),
    ("national_id", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", "true"),
]
RULES = BASE_RULES + MORE_RULES
BASE_KINDS = [kind for kind, _, _ in BASE_RULES]

# Score in hundredths without context, and the words nearby that raise it.
SCORES = {"email": 90, "ip": 60, "card": 80, "phone": 60, "account": 85, "national_id": 30}
CONTEXT = {
    "email": "mail|contact|write",
    "ip": "ip|address|host|server",
    "card": "card|visa|credit|payment",
    "phone": "phone|call|tel|mobile|fax",
    "account": "iban|account|bank",
    "national_id": "ssn|social|security|identity",
}
NEAR, RAISE, LEAST = 40, 30, 50
SCORED = "array<struct<start:int,kind_no:int,stop:int,kind:string,score:int>>"


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``found`` added: spans by start, each with its kind and score.

    Spans of the base kinds stay whatever their score is; others need ``LEAST``. A column
    ``found`` of ``docs`` is replaced. A null or empty text has no spans. Rows repeat as given.
    """
    parts = ", ".join(spans("_text", kind, i, pattern, keep) for i, (kind, pattern, keep) in enumerate(RULES))
    base = "CASE s.kind " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in SCORES.items()) + " END"
    word = "CASE s.kind " + " ".join(f"WHEN '{k}' THEN r'\\b({v})\\b'" for k, v in CONTEXT.items()) + " END"
    left, right = piece("cut", "greatest(s.start - {0}, 0)".format(NEAR), "s.start"), piece("cut", "s.stop", f"(s.stop + {NEAR})")
    scored = f"""transform(array(array_sort(concat({parts}))), every ->
      CASE WHEN size(every) = 0 THEN cast(array() AS {SCORED}) ELSE transform(array({chunks("_text")}), cut ->
        transform(every, s -> named_struct(
          'start', s.start, 'kind_no', s.kind_no, 'stop', s.stop, 'kind', s.kind,
          'score', {base} + CASE WHEN lower(concat({left}, ' ', {right})) RLIKE {word} THEN {RAISE} ELSE 0 END)))[0] END)[0]"""
    kept = f"filter({scored}, s -> s.kind_no < {len(BASE_RULES)} OR s.score >= {LEAST})"
    out = docs.drop("found", "_text").withColumn("_text", text_of(text))
    return out.withColumn("found", F.expr(kept)).drop("_text")


def digest(found: DataFrame) -> DataFrame:
    """Counts, the base spans' hash and all spans per row."""
    base = ", ".join(f"'{k}'" for k in BASE_KINDS)
    count = lambda kind: f"cast(size(filter(found, s -> s.kind = '{kind}')) AS bigint) AS n_{kind}"
    return found.selectExpr(
        "doc_id",
        *[count(kind) for kind in BASE_KINDS],
        f"sha2({listed(f'filter(found, s -> s.kind IN ({base}))')}, 256) AS base_sha256",
        f"{listed('found')} AS spans",
    )
