"""One query per operator, each over the whole table that it is for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from spendweave.llm import bpe, decontaminate, htmltext, pii, prefixes, quality, repair, secretscan, simhash, spelling, suffix, topk, warc

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and near-duplicate component per document."""
    return simhash.digest(simhash.near_duplicates(_table(spark, folder, "documents")))


def op2_html(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return htmltext.extract(_table(spark, folder, "pages").select("page_id", "url", "html"))


def op3_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document, and the bytes that they decode to."""
    return bpe.round_trip(_table(spark, folder, "documents").select("doc_id", "text")).drop("text")


def op4_suffix(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without repeated strings of 100 bytes."""
    return suffix.digest(suffix.remove_repeats(_table(spark, folder, "documents")))


def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Records of all pages, written to archives and read back."""
    return warc.read_archives(warc.write_archives(_table(spark, folder, "pages"))).drop("url")


def op6_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Place and check sum of every document's ids, read back from compressed shards."""
    return repair.read_shards(repair.write_shards(_table(spark, folder, "documents")))


def op7_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items in documents, with place and edits."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return decontaminate.digest(decontaminate.mark(docs, _table(spark, folder, "benchmark")))


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and verdicts of the quality rules per document."""
    docs = _table(spark, folder, "documents")
    return quality.digest(quality.measured_cascade(docs, quality.ordered_rules(docs)))


def op9_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets per document, scanned blob by blob through a ledger."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return secretscan.digest(secretscan.scan(docs, secretscan.new_ledger(spark)))


def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data per document."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return pii.digest(pii.find(docs))


def op11_spelling(spark: SparkSession, folder: str) -> DataFrame:
    """Words of all documents with the common word that they are a variant of."""
    return spelling.variants(_table(spark, folder, "documents"))


def op12_prefixes(spark: SparkSession, folder: str) -> DataFrame:
    """Nodes of the prefix trie of all conversations."""
    return prefixes.trie(_table(spark, folder, "conversations"))


def op13_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best of all vectors for every hundredth one."""
    return topk.search(_table(spark, folder, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_simhash": op1_simhash,
    "op2_html": op2_html,
    "op3_bpe": op3_bpe,
    "op4_suffix": op4_suffix,
    "op5_warc": op5_warc,
    "op6_repair": op6_repair,
    "op7_decontaminate": op7_decontaminate,
    "op8_quality": op8_quality,
    "op9_secrets": op9_secrets,
    "op10_pii": op10_pii,
    "op11_spelling": op11_spelling,
    "op12_prefixes": op12_prefixes,
    "op13_topk": op13_topk,
}
