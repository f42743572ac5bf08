"""From raw documents to token ids: five stages, each over all that the one before kept.

Every stage takes null texts as empty texts, keeps the values of all other columns, whatever their
names, and gives an empty table for an empty one. What a stage decides takes effect in its result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendweave.llm import bpe, decontaminate, quality, secretscan, simhash
from spendweave.sources.store import materialise


def _packed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and all other columns in one, where no name that an operator uses can meet theirs."""
    others = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(F.lit(True).alias("row"), *others).alias("carried"))


def _unpacked(packed: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again, in their order."""
    own = [c if c in ("doc_id", "text") else f"carried.c{i}" for i, c in enumerate(docs.columns)]
    return packed.select(*[F.col(c).alias(name) for c, name in zip(own, docs.columns)])


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    rows = _packed(docs)
    judged = quality.cascade(rows, quality.ordered_rules(rows))
    return _unpacked(judged.where(F.col("rejected_by").isNull()), docs)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group whose SimHash fingerprints link.

    Shingle length and radius are those of the operator. A row without doc_id takes part under an id made
    from its text, above all usual ids. Of a group's rows that share the smallest id one stays; an id that
    repeats in several groups stays once in each.
    """
    made = F.xxhash64(F.coalesce("text", F.lit(""))).bitwiseAND((1 << 62) - 1).bitwiseOR(1 << 62)
    rows = _packed(docs).withColumn("key", F.coalesce(F.col("doc_id").cast("bigint"), made))
    rows = rows.withColumn("place", F.xxhash64("key", "text"))
    linked = simhash.near_duplicates(rows, doc_id="key", place="place").where("doc_id = component_id")
    first = linked.groupBy("label").agg(F.min("doc_id").alias("key"), F.min("place").alias("place"))
    # rows of one key and place are equal in id and text
    kept = rows.join(first, ["key", "place"], "left_semi").dropDuplicates(["key", "place"])
    return _unpacked(kept, docs)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _unpacked(decontaminate.mark(_packed(docs), items).where("size(leaks) = 0"), docs)


def cut_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with what the secret scan found cut out of their texts."""
    cut = _unpacked(secretscan.without_secrets(secretscan.scan(_packed(docs), secretscan.new_ledger(spark))), docs)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, which decode to its text."""
    return bpe.encode(docs.select("doc_id", "text")).selectExpr("doc_id", "cast(size(ids) AS bigint) AS n_tokens", "ids")


STAGES = [
    ("quality rules", keep_good),
    ("near-dedup", keep_one_of_each),
    ("decontamination", keep_uncontaminated),
    ("secret scan", cut_secrets),
    ("byte-level BPE", token_ids),
]
ORACLE_SQL = None  # signatures, alignments and merges are not SQL; tests/llm compares with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES):
        docs, _ = materialise(stage(spark, docs, sf_dir), f"stage-{n}")
    return docs
