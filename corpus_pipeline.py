"""Training-corpus pipeline over ``documents``: five stages, each on all that its predecessor kept.

Every stage is written as Parquet under the shared folder and read again as
the next one's input. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pitchline.llm import bpe, common, exact_dedup, mixing, pu_quality, simhash
from pitchline.llm.queries import vocabulary_path

#: Shingle words and bit distance of the SimHash stage. Fixed by its contract.
SHINGLE, MAX_BITS = 4, 4


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled classifier accepts (score of 0.5 or more)."""
    model = pu_quality.train(docs, common.table(spark, sf_dir, "labels"))
    return pu_quality.keep_good(docs, model)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest id."""
    return exact_dedup.keep_first(docs)


def simhash_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the document with the smallest id."""
    return simhash.keep_one(docs, shingle=SHINGLE, max_bits=MAX_BITS)


def mixing_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose expected tokens have the target source, language and topic shares."""
    return mixing.sample(docs)


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens and the digests of the ids and of the decoded text."""
    path = vocabulary_path()
    return bpe.digests(bpe.round_trip(docs, path), "ids")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_duplicates),
    ("simhash_near_dedup", simhash_near_duplicates),
    ("mixing", mixing_to_targets),
    ("bpe", bpe_tokens),
]

#: The classifier and the tokenizer cannot be written in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.land(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
