"""A corpus pipeline of the operators in covista/llm: from raw documents to token ids.

Each stage takes all that the one before kept; null ids, repeated rows and further columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covista.llm import decontaminate, quality_classifier, queries, secret_scans, simhash
from covista.plans import Workspace

# no SQL: classifier, fingerprints and tokenizer are beyond it; the stages are tested against brute force
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    own = {c: f"_own_{i}" for i, c in enumerate(docs.columns) if c in ("quality", "site_prior", "kept")}
    judged = quality_classifier.scored(docs.withColumnsRenamed(own), labels)
    return judged.where("kept").drop("quality", "site_prior", "kept").withColumnsRenamed({v: k for k, v in own.items()}).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id (null ids last)."""
    work = Workspace(spark)
    rows = work.store(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    keys = rows.select(F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("id"), F.col("_row").alias("row")).alias("key"), "text")
    groups = simhash.near_duplicates(keys, "key", "text", words=3, distance=3)
    first = groups.where(F.col("key") == F.col("component_id")).select(F.col("key.row").alias("_first"))
    return rows.join(first, rows["_row"] == first["_first"], "left_semi").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.with_leaks(docs, items, name="_leaks").where(F.size("_leaks") == 0).select(docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark."""
    rules = secret_scans.BASE_RULES + secret_scans.MORE_RULES
    ledger = Workspace(spark).store(secret_scans.scan_new(docs, rules), "ledger")
    found = secret_scans.with_findings(docs, ledger, rules, name="_findings")
    clean = found.withColumn("text", secret_scans.redacted(F.col("text"), F.col("_findings")))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.when(F.size("_findings") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars")))
    return clean.select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token digests of each document."""
    return queries.token_digests(docs, "doc_id")


STAGES = [
    ("quality classifier", quality),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secrets),
    ("byte-level bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    work = Workspace(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        made = work.store(stage(spark, docs, sf_dir), f"stage-{k + 1}")
        if k:
            work.drop(docs)
        docs = made
    return docs
