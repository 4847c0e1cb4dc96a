"""A training-data pipeline over ``documents``: classifier, near-dedup,
substring dedup, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; every stage
but the last returns the columns of ``docs``. ``run`` writes each stage's rows
as Parquet to the shared checkpoint folder and reads them again for the next,
so a lost executor costs at most a stage's own work, and deletes a stage's
scratch tables when its rows are written. A stage called on its own leaves its
tables until the application ends, or until the end of the ``scratch_scope``
that its caller opened. Nulls, empty texts, ties
and repeated rows are treated as the operators' docstrings say; an empty
table passes through every stage as an empty table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from candlewick.llm.common import Scratch, read_table, scratch_scope
from candlewick.llm.packing import pack
from candlewick.llm.pii import redact
from candlewick.llm.quality import quality_scores
from candlewick.llm.simhash import keep_one
from candlewick.llm.substring import dedup_substrings


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts as label 1."""
    return quality_scores(docs, read_table(spark, sf_dir, "labels"), modulus=4, held_out=2, threshold=0.7, keep_good=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each group of near copies."""
    return keep_one(docs, shingle=3, radius=3, seed=42)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 20-word passages that start earlier in the corpus."""
    return dedup_substrings(docs, window=20, keep_rows=True)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 tokens."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), window=1024)


STAGES = [
    ("quality", good_quality),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: SQL has no trained classifier and no byte-pair encoding; tests hold the
#: stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole ``documents`` table."""
    scratch = Scratch(spark)
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        done = docs
        with scratch_scope():  # what a stage leaves behind goes when its result is written
            docs = scratch.table(stage(spark, docs, sf_dir))
        scratch.drop(done)
    return docs
