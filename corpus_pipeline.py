"""Training-corpus pipeline over ``documents``.

Quality rules -> SimHash near-dedup -> PII -> source mixing -> best-fit
packing.  Every stage works on all its predecessor kept; ``run`` writes and
rereads each stage's rows as Parquet under the shared checkpoint folder.
Rejected documents leave, one document of each near-copy component stays, PII
is replaced by its kind in ``text`` (``n_chars`` follows), documents are
repeated or left out as the mix takes them, and the pieces of what remains are
packed.  A document that the mix takes twice is packed twice.

A stage begins by deleting the scratch tables of the stages before it, since
their results have been written (tables that ``docs`` still reads are kept).
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetline.llm import mixing, packing, pii, quality_rules, simhash
from fleetline.llm.common import discard, materialize, noting, quoted, release, table


def same_columns(out: DataFrame, docs: DataFrame) -> DataFrame:
    return out.select(*[F.col(quoted(c)) for c in docs.columns])


_MADE: list[str] = []


def stage(function):
    """A stage that notes its scratch tables and drops those of the last."""
    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(docs, _MADE)
        with noting(_MADE):
            return function(spark, docs, sf_dir)
    return run_stage


@stage
def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # The operator's result columns replace the caller's of the same name, so
    # these are read again through a copy that it does not touch.
    carried = docs.select("text", "lang", "source", F.struct("*").alias("document"))
    return quality_rules.judge(carried).filter("kept").select("document.*")


@stage
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return same_columns(simhash.drop_near_copies(docs), docs)


@stage
def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = pii.redact(docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return same_columns(masked, docs)


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    carried = docs.select("doc_id", "text", "source", F.struct("*").alias("document"))
    return mixing.schedule(carried).select("document.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release(docs, _MADE)
    return packing.pack(docs.select("doc_id", "text"))


STAGES = [("quality_rules", keep_quality), ("simhash_near_dedup", drop_copies), ("pii", mask_pii),
          ("curriculum_mix", mix_sources), ("best_fit_packing", pack_sequences)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, function) in enumerate(STAGES):
        before, docs = docs, function(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{name}")
            discard(before)
    return docs
