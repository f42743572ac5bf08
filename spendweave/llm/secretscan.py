"""Secret scan over a ledger of blobs.

Every historical version of a text is addressed by its SHA-256. The ledger is a table of
(rule_version, blob, found): a row says that this blob was scanned by that version of the
rules, and what was found, also if that was nothing. A scan takes the blobs of its input that
the ledger lacks, one copy of each, appends their findings and joins the findings of all
blobs back to all rows. A second scan of the same texts reads no text beyond hashing it.

Everything is built-in SQL: no Python runs on the executors.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendweave.llm.native import SPANS, chunks, listed, piece, running, spans, text_of
from spendweave.sources.store import scratch_folder

# Fixed values: (kind, pattern, condition on a match s.hit). The order ranks spans that start together.
ASSIGN = r'(?i:(password|passwd|secret|token|api_?key))["\x27]?\x20*[:=]\x20*["\x27]?([A-Za-z0-9+/_.=-]+)'
BASE_RULES = [
    ("assign", ASSIGN, f"length(regexp_extract(s.hit, r'{ASSIGN}', 2)) >= 6"),
    ("access", r"AKIA[A-Z0-9]+", "length(s.hit) >= 20"),
    # greedy runs of 24 and more are the runs of one and more that have 24
    ("hex", r"[0-9a-f]{24,}", "true"),
]
# What the scan adds to the base: key blocks and tokens with a fixed prefix.
MORE_RULES = [
    ("pem", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----", "true"),
    ("prefixed", r"(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,})", "true"),
]
RULES = BASE_RULES + MORE_RULES
BASE_KINDS = [kind for kind, _, _ in BASE_RULES]


def rule_version(rules=RULES) -> str:
    """Changes with any rule, so that changed rules scan all blobs again."""
    return hashlib.sha256(repr(rules).encode()).hexdigest()[:16]


def _found(text: str, rules) -> str:
    parts = ", ".join(spans(text, kind, i, pattern, keep) for i, (kind, pattern, keep) in enumerate(rules))
    return f"array_sort(concat({parts}))"


def ledger_of(spark: SparkSession, path: str) -> DataFrame | None:
    """The ledger at ``path``, or None where there is none yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return spark.read.schema(LEDGER).parquet(path) if files.exists(folder) else None


LEDGER = f"rule_version string, blob string, found {SPANS.replace(',hit:string', '')}"


def scan(docs: DataFrame, ledger: str, rules=RULES, text: str = "text") -> DataFrame:
    """``docs`` with ``blob`` and ``found`` (spans by start) added; the ledger grows by unseen blobs.

    Columns of ``docs`` named like the two added ones are replaced. A null text is the empty
    text. Rows repeat as they are given. An empty table adds nothing to the ledger. Copies of
    one blob meet as one row before the scan; that join and the one that brings findings back
    are sort-merge joins on the blob, which adaptive execution splits where one blob is hot.
    """
    spark, version = docs.sparkSession, rule_version(rules)
    docs = docs.drop("blob", "found")
    # one row number per row is not needed: a blob's copies are equal, so any of them will do
    texts = docs.select(text_of(text).alias("_text")).withColumn("blob", F.sha2("_text", 256))
    seen = ledger_of(spark, ledger)
    fresh = texts
    if seen is not None:
        known = seen.where(F.col("rule_version") == version).select("blob")
        fresh = texts.join(known, "blob", "left_anti")
    fresh = fresh.groupBy("blob").agg(F.first("_text").alias("_text"))
    rows = fresh.select(F.lit(version).alias("rule_version"), "blob", F.expr(_found("_text", rules)).alias("found"))
    rows.select("rule_version", "blob", F.expr("transform(found, s -> named_struct('start', s.start, 'kind_no', s.kind_no, 'stop', s.stop, 'kind', s.kind))").alias("found")).write.mode("append").parquet(ledger)
    known = spark.read.schema(LEDGER).parquet(ledger).where(F.col("rule_version") == version)
    known = known.dropDuplicates(["blob"]).select("blob", "found")
    return docs.withColumn("blob", F.sha2(text_of(text), 256)).join(known, "blob", "left")


def new_ledger(spark: SparkSession) -> str:
    """A ledger in this application's part of the shared folder."""
    return f"{scratch_folder(spark)}/secret-ledger-{uuid.uuid4().hex}"


def digest(found: DataFrame) -> DataFrame:
    """Counts, the base spans' hash and all spans per row of a scan."""
    base = ", ".join(f"'{k}'" for k in BASE_KINDS)
    count = lambda kind: f"cast(size(filter(found, s -> s.kind = '{kind}')) AS bigint) AS n_{kind}"
    return found.selectExpr(
        "doc_id",
        *[count(kind) for kind in BASE_KINDS],
        f"sha2({listed(f'filter(found, s -> s.kind IN ({base}))')}, 256) AS base_sha256",
        f"{listed('found')} AS spans",
    )


def without_secrets(found: DataFrame, text: str = "text") -> DataFrame:
    """The rows of a scan with every found span cut out of the text; overlapping spans count once."""
    # what stays lies between the last end so far and the next start
    ends = running("transform(found, s -> s.stop)", "greatest(v, w)")
    before = "CASE WHEN i = 0 THEN 0 ELSE ends[i - 1] END"
    gap = piece("cut", "g.start", "g.stop")
    gaps = f"""concat(
      transform(found, (s, i) -> named_struct('start', {before}, 'stop', greatest(s.start, {before}))),
      array(named_struct('start', ends[size(found) - 1], 'stop', length(`{text}`))))"""
    cut = f"""CASE WHEN size(found) = 0 THEN `{text}` ELSE transform(array({ends}), ends ->
      transform(array({chunks(f"`{text}`")}), cut ->
        array_join(transform({gaps}, g -> {gap}), ''))[0])[0] END"""
    return found.withColumn(text, F.expr(cut))
