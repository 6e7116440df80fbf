"""Exact deduplication by grace hashing: spill files split by hash until a bucket fits a table that compares content.

1. Each scan task merges equal texts in a bounded table and emits one row per distinct text with its best row and count,
   so a text that a third of all rows share reaches the shuffle once per task, not once per row.
2. Rows are dealt by digest.  A task fills an open-addressing table that compares complete content.  Once the table
   outgrows its budget, its entries and the rest of the rows go to spill files by the next four bits of the digest, and each
   file is handled the same way.  Spill files are anonymous temporary files of the task: they vanish with it.
3. Every row finds its class by digest (narrow rows; adaptive execution splits a hot digest).

Equal means identical after deleting space, tab, line feed, vertical tab, form feed and carriage return.  Of equal rows the
one with the most code points in the original text stays, then the smallest key (null last), then the first in the table.

Defined results: null text counts as empty, and empty texts equal one another; rows that are repeated with the same key
are copies of one another, exactly one stays; an empty table gives no rows.  ``df`` is read twice and must be steady, such
as a stored table: rows are told apart by their place in it.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep.llm.support import map_batches, parts, slices, text_of

#: Deleted before comparing (fixed value).
WHITE_SPACE = b" \t\n\x0b\x0c\r"
#: Content that a task's table may hold before it spills or, on the scan side, is emitted.
TABLE_BYTES = 32 << 20
FANOUT_BITS = 4

ROW = "__upkeep_row"


class ContentTable:
    """Open addressing with linear probing; entries are equal only if their complete content is."""

    def __init__(self, slots: int = 1024):
        self.slots: list[int] = [-1] * slots
        self.entries: list[list] = []
        self.bytes = 0

    def _place(self, digest: bytes, content: bytes) -> int:
        mask = len(self.slots) - 1
        at = int.from_bytes(digest[-8:], "little") & mask
        while (found := self.slots[at]) >= 0 and self.entries[found][1] != content:
            at = (at + 1) & mask
        return at

    def add(self, digest: bytes, content: bytes, best: tuple, count: int) -> None:
        """``best`` is (-code points, key is null, key, row): the smallest stays."""
        at = self._place(digest, content)
        if (found := self.slots[at]) >= 0:
            entry = self.entries[found]
            entry[3] += count
            if best < entry[2]:
                entry[2] = best
            return
        self.slots[at] = len(self.entries)
        self.entries.append([digest, content, best, count])
        self.bytes += len(content) + 200
        if 2 * len(self.entries) > len(self.slots):
            self.slots = [-1] * (2 * len(self.slots))
            for number, (other, text, _, _) in enumerate(self.entries):
                self.slots[self._place(other, text)] = number


def spilled(rows: Iterable[list], depth: int) -> list:
    """Rows dealt to temporary files by their next bits; returns the files, rewound."""
    import zstandard

    files = [tempfile.TemporaryFile(prefix="grace-") for _ in range(1 << FANOUT_BITS)]
    writers = [zstandard.ZstdCompressor(1).stream_writer(f, closefd=False) for f in files]
    for row in rows:
        bits = row[0][depth // 2] >> (FANOUT_BITS * (1 - depth % 2)) & 15
        pickle.dump(row, writers[bits], protocol=5)
    for writer, file in zip(writers, files):
        writer.close()
        file.seek(0)
    return files


def restored(file) -> Iterator[list]:
    import zstandard

    with file, zstandard.ZstdDecompressor().stream_reader(file) as stream:
        load = pickle.Unpickler(_Whole(stream)).load
        while True:
            try:
                yield load()
            except EOFError:
                return


class _Whole:
    """Reads of full length from a stream that may return less."""

    def __init__(self, stream):
        import io

        self.stream = io.BufferedReader(stream, 1 << 20)
        self.read, self.readline, self.readinto = self.stream.read, self.stream.readline, self.stream.readinto


def grace(rows: Iterable[list], budget: int = TABLE_BYTES, depth: int = 0) -> Iterator[list]:
    """One entry ``[digest, content, best, count]`` per distinct content, in memory of about ``budget``."""
    table, rows = ContentTable(), iter(rows)
    for row in rows:
        table.add(*row)
        if table.bytes > budget and len(table.entries) > 1 and depth < 64:
            entries, table = table.entries, None

            def rest(entries=entries):
                while entries:
                    yield entries.pop()
                yield from rows

            for file in spilled(rest(), depth):
                yield from grace(restored(file), budget, depth + 1)
            return
    yield from table.entries


def contents(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(
        F.col(key).alias("key"), F.col(ROW).alias("row"), F.length(text_of(df, text)).alias("size"),
        text_of(df, text).cast("binary").alias("content"),
    )


def numbered(df: DataFrame) -> DataFrame:
    return df.withColumn(ROW, F.monotonically_increasing_id())


def classes(df: DataFrame, key: str, text: str, budget: int = TABLE_BYTES) -> DataFrame:
    """One row per distinct text: digest, keep_key, keep_row, group_size."""
    kind = df.schema[key].dataType.simpleString()
    names = ["digest", "content", "size", "key", "row", "count"]

    def rows_of(entries):
        entries = list(entries)
        digests, texts, best, counts = zip(*entries)
        columns = [digests, texts, [-b[0] for b in best], [None if b[1] else b[2] for b in best], [b[3] for b in best], counts]
        return columns

    def merge(batches):
        table = ContentTable()
        for batch in batches:
            for part in parts(batch, 3, 4 << 20):
                for k, row, size, content in zip(*(c.to_pylist() for c in part.columns)):
                    plain = content.translate(None, WHITE_SPACE)
                    table.add(hashlib.sha256(plain).digest(), plain, (-size, k is None, k, row), 1)
                    if table.bytes > budget:
                        yield from emit(table.entries, batch.schema.field(0).type)
                        table = ContentTable()
        yield from emit(table.entries, None if not table.entries else batch.schema.field(0).type)

    def emit(entries, key_type, texts=True):
        for a, b in slices([len(e[1]) + 100 for e in entries], 4 << 20):
            digest, content, size, keys, rows, counts = rows_of(entries[a:b])
            columns = [pa.array(digest, pa.binary())] + [pa.array(content, pa.binary())] * texts
            columns += [pa.array(size, pa.int64())] * texts
            columns += [pa.array(keys, key_type), pa.array(rows, pa.int64()), pa.array(counts, pa.int64())]
            used = names if texts else ["digest", "keep_key", "keep_row", "group_size"]
            yield pa.RecordBatch.from_arrays(columns, used)

    def resolve(batches):
        key_type = []

        def stream():
            for batch in batches:
                key_type[:] = [batch.schema.field(3).type]
                for part in parts(batch, 1, 4 << 20):
                    for digest, content, size, k, row, count in zip(*(c.to_pylist() for c in part.columns)):
                        yield [digest, content, (-size, k is None, k, row), count]

        ready = []
        for entry in grace(stream(), budget):
            ready.append([entry[0], b"", *entry[2:]])
            if len(ready) == 10_000:
                yield from emit(ready, key_type[0], texts=False)
                ready = []
        yield from emit(ready, key_type[0] if key_type else None, texts=False)

    merged = map_batches(
        contents(df, key, text), merge, f"digest binary, content binary, size long, key {kind}, row long, count long"
    )
    return map_batches(
        merged.repartition("digest"), resolve, f"digest binary, keep_key {kind}, keep_row long, group_size long"
    )


def digests(df: DataFrame, key: str, text: str) -> DataFrame:
    kind = df.schema[key].dataType.simpleString()

    def work(batches):
        for batch in batches:
            found = [hashlib.sha256(c.as_py().translate(None, WHITE_SPACE)).digest() for c in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found, pa.binary())], ["key", "row", "digest"])

    return map_batches(contents(df, key, text), work, f"key {kind}, row long, digest binary")


def duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", budget: int = TABLE_BYTES) -> DataFrame:
    """One row per input row: the key, keep_id, group_size, kept, text_sha256."""
    df = numbered(df.select(key, text))
    found = digests(df, key, text).join(classes(df, key, text, budget), "digest")
    return found.select(
        F.col("key").alias(key),
        F.col("keep_key").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_first(df: DataFrame, key: str = "doc_id", text: str = "text", budget: int = TABLE_BYTES) -> DataFrame:
    """The rows of ``df`` that stay, all columns unchanged."""
    df = numbered(df)
    kept = classes(df.select(key, text, ROW), key, text, budget).select(F.col("keep_row").alias(ROW))
    return df.join(kept, ROW, "left_semi").drop(ROW)
