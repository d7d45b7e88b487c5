"""The registered queries of this subpackage and the SQL that some of them are held against."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from . import blocks, bpe, decontam, jaccard, langid, lm, negatives, oracle, pii, quality, suffix_dedup, urls, warc, whitening
from .textkit import table


def vocabulary_path() -> str:
    """The file of the public tokenizer; TESSELLA_VOCABULARY names another one."""
    path = os.environ.get("TESSELLA_VOCABULARY")
    if not path:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    return path


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per row. Null texts measure as empty ones and fail too_few_words; repeated rows are judged one by one; labels without doc_id count for nothing; no documents, no rows."""
    docs = table(spark, sf_dir, "documents")
    entries = quality.ledger(docs, quality.toxic_words(docs, table(spark, sf_dir, "labels"), of_labels=True))
    base_failed = ~quality.passes("base")
    measures = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return entries.select("doc_id", *measures, base_failed.alias("base_failed"), (~base_failed & quality.passes("v1")).alias("kept"), "failures")


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of the policy rejects, and what it alone rejects, from the ledger of all documents. No row counts for none of the rules."""
    docs = table(spark, sf_dir, "documents")
    return quality.ablations(quality.ledger(docs, quality.toxic_words(docs, table(spark, sf_dir, "labels"), of_labels=True)), "v1")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per row. Null texts are empty and lose nothing; a repeated row is another document, so both copies of 200 bytes or more lose what they share; no documents, no rows."""
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("removed")


def op3_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per row. Null html is an empty payload; rows without page_id are responses; of rows with the least page_id of a payload all are responses; no pages, no rows."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op4_bpe_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per row. Null and empty texts have no tokens; texts of any length are encoded whole; no documents, no rows."""
    return bpe.encoding_digests(table(spark, sf_dir, "documents"), vocabulary_path())


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per contaminated doc_id and item. Null and empty texts, rows without an id, and items of under five tokens match nothing; of rows with one doc_id the best counts; no documents or items, no rows."""
    return decontam.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per row. Null urls have an empty host and path; pages without page_id have no outcome of their own; repeated rows get the same verdict; no pages, no rows."""
    return urls.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per row. Texts without words have no shingles and their own component; rows with one doc_id are one document with all their links; rows without doc_id have no component; no documents, no rows."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), k=4, percent=85)


def op8_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per row. Null and empty texts have one token, the end; rows without doc_id are held out; repeated rows count as often as they occur; no documents, no rows."""
    return lm.scores(table(spark, sf_dir, "documents"))


def op9_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per row. Null and empty texts have no spans and the digest of the empty string; repeated rows are labelled one by one; no documents, no rows."""
    return pii.report(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per row. Null texts and those without a letter are und with score 0; rows without doc_id are held out; of equally near centroids the first by language wins; no documents, no rows."""
    return langid.identify(table(spark, sf_dir, "documents"))


def op11_feast_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per row and component. Rows whose vector is null, holds null or non-finite entries or has an unusual length are left out; a repeated vector counts once in the fit; one vector or none, no rows."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_threshold_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per anchor, positive and rank. Nulls take no part; ties go to the smaller vec_id; repeated anchor rows are one anchor, repeated candidates count each; no rows, or none of another label, no rows."""
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def op13_block_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per row. Null, empty and text-free pages have an empty text; repeated pages are extracted alike; no pages, no rows."""
    return blocks.extract(table(spark, sf_dir, "pages"))


_ALL = (op1_quality_rules, op2_suffix_dedup, op3_warc_segments, op4_bpe_trie, op5_decontamination, op6_url_filter, op7_jaccard_join, op8_class_lm, op9_pii_crf, op10_language_id, op11_feast_whitening, op12_threshold_negatives, op13_block_extraction, quality_ablations)
QUERIES = {f.__name__: f for f in _ALL}
SQL = {"op1_quality_rules": oracle.QUALITY, "quality_ablations": oracle.ABLATIONS, "op6_url_filter": oracle.URLS, "op12_threshold_negatives": oracle.NEGATIVES}
