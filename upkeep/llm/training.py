"""Choosing labelled rows to learn from, and applying a trained scorer to whole tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upkeep.llm.support import map_batches, parts, text_of

#: Remainder of the checksum that keeps a row out of training.
FOLDS, HELD_OUT = 4, 2


def held_out(key: Column) -> Column:
    """True for rows never learnt from; null keys have no label and are not held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """``doc_id``, ``label``, ``text`` of at most ``most`` labelled rows outside the held-out fold, chosen by hash.

    A row labelled twice counts as 1 if one label does.  Only ids are compared to choose: a share of the hash range that
    holds about ``most`` of the labels, so the choice may be broadcast to fetch the texts.
    """
    known = labels.select("doc_id", F.col(label).alias("label")).where(F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
    parts = 1_000_000
    share = min(parts, most * parts // max(1, known.count()))
    known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(parts)) < share).groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = known.join(docs.select("doc_id"), "doc_id", "left_semi")
    found = docs.select("doc_id", text_of(docs).alias("text")).join(F.broadcast(chosen), "doc_id")
    return found.select("doc_id", "label", "text")


def bounded(df: DataFrame, most: int) -> list:
    """Rows of the training set on the driver; ids that repeat in the table cannot make it larger than ``most``."""
    return df.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("content")).limit(most).collect()


def scored(docs: DataFrame, scorer) -> DataFrame:
    """``doc_id`` and ``score`` of every row; ``scorer()`` makes, in a worker, a function from texts to scores."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))

    def work(batches):
        score = scorer()
        for batch in batches:
            for part in parts(batch, 1):
                values = np.asarray(score(part.column(1).to_pylist()), dtype=np.float64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(values)], ["doc_id", "score"])

    return map_batches(source, work, "doc_id long, score double")


def filtered(docs: DataFrame, scorer, keep) -> DataFrame:
    """The rows whose score passes ``keep``; all columns unchanged, whatever their names."""
    place = docs.columns.index("text")

    def work(batches):
        score = scorer()
        for batch in batches:
            for part in parts(batch, place):
                texts = [t or "" for t in part.column(place).to_pylist()]
                yield part.filter(pa.array(keep(np.asarray(score(texts), dtype=np.float64))))

    return map_batches(docs, work, docs.schema)


class Adam:
    """Adam steps over a list of arrays, in place."""

    def __init__(self, parameters: list[np.ndarray], rate: float):
        self.parameters, self.rate, self.step = parameters, rate, 0
        self.first = [np.zeros_like(p) for p in parameters]
        self.second = [np.zeros_like(p) for p in parameters]

    def apply(self, gradients: list[np.ndarray]) -> None:
        self.step += 1
        for p, g, m, v in zip(self.parameters, gradients, self.first, self.second):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= self.rate * (m / (1 - 0.9**self.step)) / (np.sqrt(v / (1 - 0.99**self.step)) + 1e-8)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))
