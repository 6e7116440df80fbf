"""Ranked lexical search by pipelined term partitioning.

The terms of the query items are dealt to owners.  A bundle of items visits the owners one after another: each stage
cogroups the bundle's sparse document accumulators with the postings that this stage's owner holds, adds its integer
contributions and sends the accumulators on; after the last owner each block of documents selects its best, and the blocks
are merged.  So that no group is unbounded, both sides are keyed by a block of at most ``BLOCK_DOCS`` documents.

Owners hold about equally many postings each, the heaviest (rarest) terms first.  After each stage an accumulator is
dropped if its sum and all that later owners can add is below the k-th best sum of the item in the block; so few travel on,
and the result stays exact (equal sums are kept until ids decide).

Texts are read once: each task counts the terms of whole texts, in parts of a few MB, and writes the postings of the query
vocabulary; numbers of documents, of terms and of documents a term has come from all documents.  The query set goes in
bundles of about ``BUNDLE_TERMS`` terms, whose vocabulary is what a task holds; each bundle reads the texts once.

Defined results: a null or empty text, or one without terms, is not a document that counts, nor an item with results;
rows that repeat an item id are one item with the terms of all; rows without an item id take no part; every row of the
documents is a document for itself, also if ids repeat; documents without an id count in all statistics but are not
returned; equal scores go by ascending id; no documents or no items give no rows.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from upkeep.llm.support import map_batches, shared_folder, ship_code, stored, text_of

OWNERS = 4
BLOCK_DOCS = 8192
BLOCK_POSTINGS = 2_000_000
BUNDLE_TERMS = 200_000
#: Bytes of a text that are split into words at once.
PART = 4 << 20
#: A part of a score, (10^9 * tf) div (1000 * tf + 8 * m), stays below this.
MOST = 1_000_000

_LETTERS = bytes(range(0x30, 0x3A)) + bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
#: Bytes of UTF-8: separators become spaces, A-Z lower case; a byte of a longer character always belongs to a term.
PLAIN = bytes((c + 32 if 0x41 <= c <= 0x5A else c) if c in _LETTERS else 0x20 for c in range(256))


def count_terms(text: str) -> tuple[Counter, int]:
    """Times of each term (UTF-8), and all terms."""
    raw, counts, total, start = text.encode().translate(PLAIN), Counter(), 0, 0
    while start < len(raw):
        end = raw.find(b" ", start + PART)
        end = len(raw) if end < 0 else end
        words = raw[start:end].split()
        counts.update(words)
        total += len(words)
        start = end
    return counts, total


def item_terms(items: DataFrame, key: str) -> DataFrame:
    """``item``, ``term``, ``repeats`` of the query set."""

    def work(batches):
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts, _ = count_terms(text.as_py())
                columns = [pa.array([item] * len(counts), pa.int64()), pa.array([t.decode() for t in counts], pa.string()), pa.array(list(counts.values()), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["item", "term", "n"])

    rows = items.select(items[key].cast("long").alias("item"), text_of(items).alias("text")).where("item IS NOT NULL")
    counted = map_batches(rows, work, "item long, term string, n long")
    return counted.groupBy("item", "term").agg(F.sum("n").alias("repeats"))


class Block:
    """Postings of a run of documents, gathered until it is full."""

    def __init__(self):
        self.ids, self.lengths, self.terms, self.places, self.times = [], [], [], [], []

    @property
    def full(self) -> bool:
        return len(self.ids) >= BLOCK_DOCS or len(self.terms) >= BLOCK_POSTINGS

    def add(self, doc: int | None, length: int, counts: dict[int, int]) -> None:
        self.terms += counts
        self.times += counts.values()
        self.places += [len(self.ids)] * len(counts)
        self.ids.append(doc)
        self.lengths.append(length)

    def row(self, number: int) -> dict:
        order = np.argsort(np.array(self.terms, dtype=np.int32), kind="stable")
        return {
            "block": number,
            "docs": len(self.ids),
            "words": sum(self.lengths),
            "ids": np.array([i or 0 for i in self.ids], dtype=np.int64).tobytes(),
            "known": np.array([i is not None for i in self.ids]).tobytes(),
            "lengths": np.array(self.lengths, dtype=np.int64).tobytes(),
            "terms": np.array(self.terms, dtype=np.int32)[order].tobytes(),
            "places": np.array(self.places, dtype=np.int32)[order].tobytes(),
            "times": np.array(self.times, dtype=np.uint32)[order].tobytes(),
        }


BLOCKS = "block long, docs long, words long, ids binary, known binary, lengths binary, terms binary, places binary, times binary"
_ARROW = pa.schema([(f.split()[0], pa.int64() if f.endswith("long") else pa.binary()) for f in BLOCKS.split(", ")])


def postings(docs: DataFrame, key: str, vocabulary: dict[str, int]) -> DataFrame:
    """One row per block of documents that have terms, postings in order of term."""

    def work(batches):
        numbers = {term.encode(): i for term, i in vocabulary.items()}
        first, made, block = TaskContext.get().partitionId() << 32, 0, Block()
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts, total = count_terms(text.as_py())
                if total:
                    block.add(doc, total, {numbers[t]: counts[t] for t in counts.keys() & numbers.keys()})
                if block.full:
                    yield pa.RecordBatch.from_pylist([block.row(first + made)], _ARROW)
                    made, block = made + 1, Block()
        if block.ids:
            yield pa.RecordBatch.from_pylist([block.row(first + made)], _ARROW)

    return map_batches(docs.select(docs[key].cast("long").alias("doc"), text_of(docs).alias("text")), work, BLOCKS)


def document_counts(blocks: DataFrame) -> dict[int, int]:
    """Documents that hold each term of the vocabulary (its size bounds what is collected)."""

    def work(batches):
        for batch in batches:
            for terms in batch.column(0):
                found, n = np.unique(np.frombuffer(terms.as_py(), np.int32), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(n, pa.int64())], ["term", "n"])

    counted = map_batches(blocks.select("terms"), work, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return {r["term"]: r["n"] for r in counted.collect()}


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Plan:
    """What the stages need to know of a bundle: weights, owners, and for each owner the terms of each item.

    Its size follows the bundle's terms, never the documents.
    """

    def __init__(self, items: list[int], wanted: list[tuple[int, int, int]], df: dict[int, int], n_docs: int, owners: int):
        self.items = items
        order = sorted(df, key=lambda t: (df[t], t))
        total, before, owner = sum(df.values()), 0, {}
        for term in order:
            owner[term] = min(owners - 1, owners * before // max(1, total))
            before += df[term]
        self.owner_of = np.full(max(df, default=0) + 1, -1, dtype=np.int32)
        self.owner_of[list(owner)] = list(owner.values())
        weights = {t: weight(n_docs, n) for t, n in df.items()}
        #: By owner: item -> [(term, repeats * weight)], and what the later owners can add at most.
        self.terms: list[dict[int, list[tuple[int, int]]]] = [{} for _ in range(owners)]
        self.later = np.zeros((owners, len(items)), dtype=np.int64)
        for item, term, repeats in wanted:
            if term in df:
                self.terms[owner[term]].setdefault(item, []).append((term, repeats * weights[term]))
                self.later[: owner[term], item] += repeats * weights[term] * MOST


def owned(blocks: DataFrame, plan: Plan, stage: int, n_docs: int, words: int) -> DataFrame:
    """The postings of one owner, as parts of scores; a row for every block."""

    def work(batches):
        for batch in batches:
            for row in batch.to_pylist():
                terms = np.frombuffer(row["terms"], np.int32)
                mine = np.nonzero(plan.owner_of[terms] == stage)[0] if len(terms) else np.empty(0, np.int64)
                places = np.frombuffer(row["places"], np.int32)[mine]
                times = np.frombuffer(row["times"], np.uint32)[mine].astype(np.int64)
                m = 100 - 75 + (75 * np.frombuffer(row["lengths"], np.int64) * n_docs) // words
                part = (1_000_000_000 * times) // (1000 * times + 8 * m[places])
                part[~np.frombuffer(row["known"], bool)[places]] = 0  # without an id it is never returned
                columns = [pa.array([row["block"]], pa.int64()), *[pa.array([x.tobytes()], pa.binary()) for x in (terms[mine], places, part)], pa.array([row["ids"]], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["block", "terms", "places", "parts", "ids"])

    columns = ["block", "terms", "places", "times", "lengths", "known", "ids"]
    return map_batches(blocks.select(*columns), work, "block long, terms binary, places binary, parts binary, ids binary")


CARRIED = "block long, item int, places binary, sums binary"


def visit(bundles: DataFrame, postings_here: DataFrame, plan: Plan, stage: int, k: int) -> DataFrame:
    """One stage: accumulators and the owner's postings meet by block; those that may still win are sent on.

    The last stage returns ``item_id``, ``doc_id``, ``score`` of the k best of each block instead.
    """
    last = stage == len(plan.terms) - 1

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        here = right.to_pylist()[0]
        block, ids = here["block"], np.frombuffer(here["ids"], np.int64)
        terms, places, parts = (np.frombuffer(here[c], t) for c, t in (("terms", np.int32), ("places", np.int32), ("parts", np.int64)))
        carried = {i: (np.frombuffer(p, np.int32), np.frombuffer(s, np.int64)) for i, p, s in zip(*[left.column(c).to_pylist() for c in ("item", "places", "sums")]) if i >= 0}
        out: list[tuple] = []
        for item in sorted(carried.keys() | plan.terms[stage].keys()):
            sums = np.zeros(len(ids), dtype=np.int64)
            if item in carried:
                sums[carried[item][0]] = carried[item][1]
            for term, worth in plan.terms[stage].get(item, ()):
                start, end = np.searchsorted(terms, [term, term + 1])
                sums[places[start:end]] += worth * parts[start:end]  # a document is in a list once
            found = np.nonzero(sums)[0].astype(np.int32)
            if len(found) > k:
                reached = np.partition(sums[found], -k)[-k]
                found = found[sums[found] + plan.later[stage, item] >= reached]
            if last:
                best = found[np.lexsort((ids[found], -sums[found]))[:k]]
                out += zip([plan.items[item]] * len(best), ids[best].tolist(), sums[best].tolist())
            elif len(found):
                out.append((block, item, found.tobytes(), sums[found].tobytes()))
        kinds = (pa.int64(), pa.int64(), pa.int64()) if last else (pa.int64(), pa.int32(), pa.binary(), pa.binary())
        names = ("item_id", "doc_id", "score") if last else ("block", "item", "places", "sums")
        return pa.table({n: pa.array([r[i] for r in out], t) for i, (n, t) in enumerate(zip(names, kinds))})

    ship_code(bundles.sparkSession)
    met = bundles.groupBy("block").cogroup(postings_here.groupBy("block"))
    return met.applyInArrow(work, "item_id long, doc_id long, score long" if last else CARRIED)


def rank_bundle(docs: DataFrame, wanted: DataFrame, key: str, k: int, owners: int, folder: str, name: str) -> DataFrame | None:
    """The k best documents of every block for the items of one bundle, or None without documents."""
    rows = wanted.collect()  # the terms of one bundle
    vocabulary = {t: i for i, t in enumerate(sorted({r["term"] for r in rows}))}
    items = sorted({r["item"] for r in rows})
    place = {item: i for i, item in enumerate(items)}
    blocks = stored(postings(docs, key, vocabulary), folder, name)
    n_docs, words = blocks.agg(F.sum("docs"), F.sum("words")).first()
    if not n_docs:
        return None
    plan = Plan(items, [(place[r["item"]], vocabulary[r["term"]], r["repeats"]) for r in rows], document_counts(blocks), n_docs, owners)
    bundles = blocks.select("block", F.lit(-1).alias("item"), F.lit(b"").alias("places"), F.lit(b"").alias("sums"))
    for stage in range(owners):
        bundles = visit(bundles, owned(blocks, plan, stage, n_docs, words), plan, stage, k)
    return bundles


def rank(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    key: str = "doc_id",
    item_key: str = "item_id",
    owners: int = OWNERS,
    bundle_terms: int = BUNDLE_TERMS,
) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score``: the k documents that score highest for each item, scores above 0 only."""
    spark = docs.sparkSession
    folder = shared_folder(spark)
    wanted = stored(item_terms(items, item_key), folder, "items")
    bundles = max(1, -(-wanted.count() // bundle_terms))
    found = spark.createDataFrame([], "item_id long, doc_id long, score long")
    for bundle in range(bundles):
        mine = wanted.where(F.pmod(F.xxhash64("item"), F.lit(bundles)) == bundle)
        best = rank_bundle(docs, mine, key, k, owners, folder, f"postings-{bundle}")
        found = found if best is None else found.unionByName(best)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
