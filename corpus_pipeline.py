"""A training corpus in five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemill.llm import (
    contamination,
    fast_similarity,
    line_templates,
    sentencepiece_codec,
    toxicity,
)
from tablemill.llm.queries import vocabulary
from tablemill.session import remove_staged, scratch_path, scratch_removed
from tablemill.spec import col

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _plain(docs: DataFrame) -> DataFrame:
    """The columns of documents alone: others could clash with what a stage adds."""
    return docs.select(*COLUMNS)


def _kept(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id is in ``ids``."""
    marked = ids.select(F.col("doc_id").alias("__doc")).distinct()
    return docs.join(marked, col("doc_id").eqNullSafe(F.col("__doc")), "left_semi")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model rejects go. It learns from the labelled rows of ``docs``."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train_toxicity(docs, labels)
    scored = toxicity.score_toxicity(docs, model, keep=list(COLUMNS))
    return scored.where("predicted = 0").select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go; ``n_chars`` follows the text."""
    kept = line_templates.drop_recurring_lines(_plain(docs))
    return kept.select(
        "doc_id", "text", "lang", "source",
        F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"),
    )


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    found = fast_similarity.near_duplicates(docs)
    return _kept(_plain(docs), found.where("kept"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contamination.decontaminate(_plain(docs), benchmark)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and round trip of what is left, as digests."""
    return sentencepiece_codec.codec_digests(docs, vocabulary("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("minhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("sentencepiece", encode),
]

# Training and line templates are beyond SQL; tests/llm holds the stages against
# brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again. What a stage
    staged, and the result of the one before, is deleted when its own result is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"stage-{name}")
        with scratch_removed(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before is not None:
            remove_staged(before)
        docs = before = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
