"""Packing token ids into sequences: first-fit decreasing with a tournament tree, in randomised groups of documents.

A document longer than a sequence is cut into full sequences and one remainder.  Full pieces are sequences by themselves.
Remainders are dealt at random into groups of about ``GROUP_PIECES``; in a group they are placed, longest first, each into
the first sequence with room.  The tree holds the largest room below each node, so finding it takes a walk from the root.
Only lengths are shuffled, never texts or ids.

Defined results: null text counts as empty (one piece, the end id alone); repeated rows are packed each for itself; an
empty table gives no pieces.  A sequence is padded to ``CAPACITY`` unless its size is a power of two.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep.llm.bpe import encoder
from upkeep.llm.support import map_batches, parts, shared_folder, stored, text_of

CAPACITY = 1024
GROUP_PIECES = 8192
#: Sequences of full pieces are numbered from here, those of groups below.
FULL_FROM = 1 << 61


class RoomTree:
    """Tournament tree over the room left in each bin; ``take`` gives the leftmost bin that still fits."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.most = [capacity] * (2 * self.leaves)

    def take(self, size: int) -> int:
        most, at = self.most, 1
        while at < self.leaves:
            at *= 2
            if most[at] < size:
                at += 1
        found = at - self.leaves
        most[at] -= size
        while at > 1:
            at //= 2
            left, right = most[2 * at], most[2 * at + 1]
            most[at] = left if left >= right else right
        return found


def first_fit_decreasing(sizes: Sequence[int], capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and place within the bin of each item."""
    tree, filled = RoomTree(len(sizes), capacity), {}
    bins, places = np.zeros(len(sizes), dtype=np.int64), np.zeros(len(sizes), dtype=np.int64)
    for i in np.argsort(-np.asarray(sizes, dtype=np.int64), kind="stable").tolist():
        size = int(sizes[i])
        bins[i] = found = tree.take(size)
        places[i] = filled.get(found, 0)
        filled[found] = places[i] + size
    return bins, places


def padded(size, capacity: int = CAPACITY):
    """Length of a sequence after padding; as a column."""
    return F.when(F.bit_count(size) == 1, size).otherwise(F.lit(capacity).cast("long"))


def cut(df: DataFrame, definition: str, end_id: int, capacity: int, added_tokens: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens."""
    shared = df.sparkSession.sparkContext.broadcast(definition)
    source = df.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(df).alias("text"))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    def work(batches):
        made, end, step = encoder(shared.value, added_tokens), struct.pack("<I", end_id), 4 * capacity
        for batch in batches:
            for part in parts(batch, 1):
                rows = []
                for key, ids in zip(part.column(0).to_pylist(), made.encode(part.column(1).to_pylist())):
                    ids += end
                    for at in range(0, len(ids), step):
                        piece = ids[at : at + step]
                        rows.append((key, at // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4))
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], names)

    return map_batches(source, work, ", ".join(f"{n} long" for n in names))


def pack(
    df: DataFrame,
    definition: str,
    end_id: int = 0,
    capacity: int = CAPACITY,
    group_pieces: int = GROUP_PIECES,
    added_tokens: bool = False,
) -> DataFrame:
    """One row per piece of ``doc_id``, ``text``, with ``sequence_id``, ``offset`` and the sequence's padded size.

    With ``added_tokens`` the text of an added token becomes its one id, as the library gives it.
    """
    spark = df.sparkSession
    pieces = stored(cut(df, definition, end_id, capacity, added_tokens), shared_folder(spark), "pieces")
    names = pieces.columns
    number = F.monotonically_increasing_id()  # steady, as the pieces are stored
    full = pieces.where(F.col("length") == capacity).select(
        *names, (F.lit(FULL_FROM) + number).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    full = full.withColumn("sequence_length", F.col("length"))
    rest = pieces.where(F.col("length") < capacity)
    groups = max(1, round(rest.count() / group_pieces))
    rest = rest.withColumn("draw", F.xxhash64("doc_id", number)).withColumn("group", F.pmod("draw", F.lit(groups)))

    def place(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["draw", "doc_id", "start"], kind="stable")
        bins, places = first_fit_decreasing(group["length"].to_numpy(), capacity)
        size = np.bincount(bins, weights=group["length"].to_numpy()).astype(np.int64)[bins]
        group["sequence_id"] = (group["group"].to_numpy() << 32) + bins
        group["offset"] = places
        group["sequence_length"] = np.where(size & (size - 1) == 0, size, capacity)
        return group[[*names, "sequence_id", "offset", "sequence_length"]]

    schema = ", ".join(f"`{n}` long" for n in [*names, "sequence_id", "offset", "sequence_length"])
    return full.unionByName(rest.groupBy("group").applyInPandas(place, schema))
