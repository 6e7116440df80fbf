"""The corpus pipeline: toxicity, quality, exact copies, near copies, packing.

Each stage works on all that its predecessor kept, and all but the last return the columns of ``documents``, whatever
further columns there are.  Stages read their input more than once and rely on its order, so ``run`` stores each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from upkeep.llm import grace, minhash, packing, quality, toxicity
from upkeep.llm.queries import library_tokenizer, table
from upkeep.llm.support import shared_folder, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold of the toxicity model, which learns from those of ``labels`` still here."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored at the threshold of the quality model or above."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for white space, the longest original."""
    return grace.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shingles of five words at a similarity of 0.8 or more."""
    return minhash.keep_one(docs, percent=80)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences."""
    return packing.pack(docs, library_tokenizer(), end_id=0, added_tokens=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_good),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("packing", pack),
]

#: SQL can't express the trained models, the signatures or a tokenizer's ids; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    folder = shared_folder(spark)
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), folder, f"{number}-{name}")
    return docs
