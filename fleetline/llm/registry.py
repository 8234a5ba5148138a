"""Queries of the training-data operators and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetline.llm import (embeddings, langid, mixing, packing, pii, quality_rules, simhash, spelling, substring,
                           toxicity, url_reputation, warc, whitening)
from fleetline.llm.common import materialize, table
from fleetline.llm.oracles import ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES"]


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return quality_rules.judge(docs, as_sql=True).select(
        "doc_id", *quality_rules.COUNTS, "base_failed", "kept")


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled page outcomes: the number in a page's path is the document it
    renders, and a page is bad if that document's quality label is 0."""
    rendered = pages.select("page_id", F.regexp_extract(
        url_reputation.path_of(F.col("url")), r"^/[^/]*/([0-9]{1,18})", 1).try_cast("long").alias("doc_id"))
    return rendered.join(labels.select("doc_id", "quality"), "doc_id").select(
        "page_id", (F.col("quality") == 0).alias("bad"))


def op2_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    outcomes = page_outcomes(pages, table(spark, sf_dir, "labels"))
    return url_reputation.url_reputation(pages, outcomes).select(
        "page_id", "host", "path", "rule", "verdict")


def op7_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.folded(mixing.training_order(docs)).select(
        "doc_id", "size", "source_size", "target", "taken", "position")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    bundles = materialize(warc.write_bundles(pages), "warc-bundles")
    return warc.read_records(bundles, payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op4_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.link_documents(docs).select("doc_id", "fingerprint", "component_id")


def op9_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return embeddings.link_vectors(vectors).select("vec_id", "n_links", "component_id", "kept")


def op5_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256",
                        pii.spans_text(F.col("all_spans")).alias("spans"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.drop_repeats(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_spellings(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score_toxicity(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_url_reputation, op3_best_fit_packing, op4_simhash_components, op5_contextual_pii,
    op6_substring_dedup, op7_curriculum_mix, op8_warc_bundles, op9_embedding_links, op10_language_id,
    op11_spelling_variants, op12_toxicity, op13_embedding_whitening)}
