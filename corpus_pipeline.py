"""A corpus pipeline of five stages: quality rules, near-duplicate removal, benchmark decontamination, masking of personal data, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what it keeps is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents. Rows with nulls, empty texts and repeated ids pass as the
operators' docstrings say.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import bpe, decontam, jaccard, pii, quality
from tessella.llm.queries import vocabulary_path
from tessella.llm.textkit import quoted, shared_folder, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the policy keeps; rows without a doc_id are judged like the others."""
    toxic = quality.toxic_words(docs, table(spark, sf_dir, "labels"))
    # the whole row stands in for the id, so rows with the same id are judged one by one
    judged = quality.ledger(docs.select(F.struct(*quoted(docs.columns)).alias("doc_id"), "text"), toxic)
    return judged.filter(quality.passes("v1")).select("doc_id.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates. Rows without words or doc_id stay, as do all rows with the doc_id that stays."""
    return jaccard.keep_one(docs, k=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that no item contaminates, each row judged by its own text; null and empty texts stay."""
    return decontam.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data masked; n_chars is that of the masked text. Null texts stay null, and every row stays."""
    masked = pii.mask(docs)
    return masked.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else masked


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row of token ids for each row; null and empty texts have none."""
    return bpe.encode(docs, vocabulary_path()).select("doc_id", "lang", "source", "n_tokens", "ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("pii", personal_data),
    ("bpe", token_ids),
]

#: The stages hash, tile and encode in ways that SQL cannot express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    base = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
