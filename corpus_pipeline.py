"""A training-corpus pipeline: quality, near copies, repeats, test leaks, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read
again as the next one's documents. All but the last return the columns of documents;
what a stage rejects is gone for those after it. Rows without a doc_id are kept by every
filter that cannot name them. Empty tables pass through as empty results.
"""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.llm import bpe, decontaminate, jaccard, quality, repeats
from ratelake.llm.common import read, stored
from ratelake.llm.queries import BYTE_BPE, query, training_labels


# Rows carry whole texts from stage to stage, so what a task holds of them at once is bounded:
# the batches that travel to Python and the row groups that a writer fills.
BOUNDS = {"spark.sql.execution.arrow.maxBytesPerBatch": str(2 << 20), "parquet.block.size": str(8 << 20)}


def _bounded(stage):
    """The stage with BOUNDS set for the session, and kept, since its result is computed later."""

    @wraps(stage)
    def run_bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for key, value in BOUNDS.items():
            spark.conf.set(key, value)
        return stage(spark, docs, sf_dir)

    return run_bounded


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    scored = quality.score(docs, training_labels(spark, sf_dir), name="_score")
    return scored.filter(quality.predicted(F.col("_score")) == 1).select(*docs.columns)


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id.

    Documents without words are no copies of anything; rows that repeat an id stay together.
    """
    found = jaccard.near_duplicates(docs)
    gone = found.filter(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the long strings that an earlier document holds; a document that
    loses all its words goes. A cut inside a character takes the whole character.
    """
    left = repeats.remove_repeats(docs, "rows")
    cut = F.col("_removed") > 0
    chars = F.when(cut, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return left.filter(~cut | (F.trim("text") != "")).withColumn("n_chars", chars).select(*docs.columns)


def leaks_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that copy no test item."""
    hits = decontaminate.contaminated(docs, read(spark, sf_dir, "benchmark"))
    return docs.join(hits.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token digests of what is left."""
    return bpe.round_trip_digest(docs, public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN)


STAGES = [
    ("quality", _bounded(quality_stage)),
    ("near_copies", _bounded(near_copies_stage)),
    ("repeats", _bounded(repeats_stage)),
    ("leaks", _bounded(leaks_stage)),
    ("tokens", _bounded(tokens_stage)),
]

# SQL cannot express a classifier or an alignment; tests/llm checks the stages instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each stored before the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


query("pipeline")(run)
