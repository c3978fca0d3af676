"""A training-data pipeline over ``documents``: judge, deduplicate, clean and
pack.

Each stage takes what the one before kept, written as Parquet in the shared
folder and read again, so a lost executor never costs more than a stage.  All
stages but the last return rows of their input with all its columns.  Null
texts count as empty; documents without a doc_id pass the deduplicating
stages, as there is nothing to keep them by.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starflow.llm import decontaminate, exact_dedup, ngram_join, packing, quality
from starflow.session import materialise, share_code

# Near duplicates: shingles of five words, Jaccard similarity of 0.8 or more.
NEAR_SHINGLE, NEAR_PERCENT = 5, 80


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return share_code(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with the same normalised text."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shared word shingles."""
    return ngram_join.keep_one_each(docs, NEAR_SHINGLE, NEAR_PERCENT)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.drop_leaking(docs, _table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents, packed into sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality", keep_good),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("packing", pack),
]

# Neither a trained classifier nor the tokenizer can be put in SQL; the stages
# are tested against brute force in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the pieces of the packed corpus."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
