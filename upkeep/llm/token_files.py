"""Token ids as binary files: every document compressed by itself with one shared zstandard dictionary.

Layout below a folder of the shared store::

    dictionary.zstd            trained on a bounded sample of serialised id arrays
    tokens-<bucket>-<n>-<try>.bin   header (magic, id width, SHA-256 of the dictionary), then one frame per document
    tokens-<bucket>-<n>-<try>.idx   offset index: key, validity, place and size of the frame, ids before it, ids

Files follow one another in ascending key order.  A short document is read with one index lookup and one small frame
(``read_document``), without touching its neighbours.  Writers name their files by attempt and return the names; only the
names in the stored manifest count, so a task that runs twice leaves an unused file and nothing else.

Defined results: null text counts as empty (its ids are the end id alone); null keys come first; repeated keys are kept
side by side, ordered by size and checksum; an empty table gives no files; a table too small to train on is written
without a dictionary (all-zero hash).
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upkeep.llm.bpe import encoder
from upkeep.llm.support import file_system, map_batches, parts, shared_folder, slices, spread, stored, text_of, write_file

MAGIC = b"UPKIDS01"
HEADER = "<8sI32s"
HEADER_BYTES = struct.calcsize(HEADER)
INDEX = np.dtype(
    [("key", "<i8"), ("valid", "u1"), ("place", "<u8"), ("size", "<u8"), ("start", "<u8"), ("ids", "<u8")]
)

#: The dictionary sample: about this many documents, drawn from the whole table, each encoded whole; of a longer array
#: of ids a slice of this many bytes, from anywhere in it.
DICTIONARY_DOCUMENTS = 1000
DICTIONARY_SLICE = 8192
DICTIONARY_BYTES = 64 << 10
#: A file is closed once it holds this much.
FILE_BYTES = 64 << 20
LEVEL = 1


def train_dictionary(df: DataFrame, definition: str, end_id: int, width: int, added_tokens: bool = False) -> bytes:
    """A zstandard dictionary from the sample; tasks encode it, and about 8 MB at most reach the driver at any table size."""
    import zstandard

    share = min(1.0, DICTIONARY_DOCUMENTS / max(1, df.count()))
    shared = df.sparkSession.sparkContext.broadcast(definition)

    def sample(batches):
        made = encoder(shared.value, added_tokens)
        for batch in batches:
            for part in parts(batch, 0):
                arrays = [serialised(x, end_id, width) for x in made.encode(part.column(0).to_pylist()) if x]
                yield pa.RecordBatch.from_arrays([pa.array([any_slice(x, width) for x in arrays], pa.binary())], ["ids"])

    drawn = df.select(text_of(df).alias("text")).where(F.rand(11) < share)
    arrays = [bytes(row.ids) for row in map_batches(drawn, sample, "ids binary").collect()]
    if len(arrays) < 8:
        return b""
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, sum(map(len, arrays)) // 8), arrays).as_bytes()
    except zstandard.ZstdError:
        return b""


def any_slice(array: bytes, width: int) -> bytes:
    """At most ``DICTIONARY_SLICE`` bytes of whole ids; where they begin depends on the array alone."""
    places = max(0, len(array) - DICTIONARY_SLICE) // width + 1
    start = zlib.crc32(array) % places * width
    return array[start : start + DICTIONARY_SLICE]


def serialised(packed: bytes, end_id: int, width: int) -> bytes:
    ids = np.frombuffer(packed + struct.pack("<I", end_id), dtype="<u4")
    return ids.astype(f"<u{width}").tobytes()


def dictionary_hash(dictionary: bytes) -> bytes:
    return hashlib.sha256(dictionary).digest() if dictionary else bytes(32)


def write(
    df: DataFrame, definition: str, end_id: int = 0, folder: str | None = None, added_tokens: bool = False
) -> DataFrame:
    """Encode and write ``doc_id``, ``text``; returns the manifest: bucket, number, path, documents, ids.

    With ``added_tokens`` the text of an added token becomes its one id, as the library gives it.

    One shuffle, of the compressed documents.  The borders of the buckets come from a sketch of the keys alone.
    """
    spark = df.sparkSession
    folder = folder or shared_folder(spark)
    source = df.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(df).alias("text"))
    width = 2 if max(encoder(definition, added_tokens).tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    dictionary = train_dictionary(source, definition, end_id, width, added_tokens)
    write_file(f"{folder}/dictionary.zstd", [dictionary])
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    steps = [i / buckets for i in range(1, buckets)]
    borders = np.array(source.select("doc_id").approxQuantile("doc_id", steps, 0.2 / buckets), dtype=np.float64)
    shared = spark.sparkContext.broadcast((definition, dictionary))  # a vocabulary and 64 KB

    def compress(batches):
        import zstandard

        words, trained = shared.value
        made = encoder(words, added_tokens)
        zstd = zstandard.ZstdCompressor(LEVEL, dict_data=zstandard.ZstdCompressionDict(trained) if trained else None)
        for batch in batches:
            for part in parts(batch, 1):
                keys = part.column(0)
                bucket = np.searchsorted(borders, np.array([-np.inf if k is None else k for k in keys.to_pylist()]), "left")
                packed = made.encode(part.column(1).to_pylist())
                frames = [zstd.compress(serialised(x, end_id, width)) for x in packed]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(bucket, pa.int32()),
                        keys,
                        pa.array([len(x) // 4 + 1 for x in packed], pa.int64()),
                        pa.array([zlib.crc32(f) for f in frames], pa.int64()),
                        pa.array(frames, pa.binary()),
                    ],
                    ["bucket", "doc_id", "ids", "crc", "frame"],
                )

    hashed = dictionary_hash(dictionary)

    def write_files(batches):
        bucket, number, start, frames, index, place = None, 0, 0, [], [], HEADER_BYTES

        def close():
            name = f"{folder}/tokens-{bucket:06d}-{number:04d}-{uuid.uuid4().hex[:12]}"
            rows = np.array(index, dtype=INDEX)
            write_file(f"{name}.bin", [struct.pack(HEADER, MAGIC, width, hashed), *frames])
            write_file(f"{name}.idx", [rows.tobytes()])
            values = [bucket, number, name, len(rows), int(rows["ids"].sum())]
            return pa.RecordBatch.from_pylist([dict(zip(("bucket", "number", "path", "documents", "ids"), values))])

        for batch in batches:
            columns = (batch.column(i).to_pylist() for i in range(5))
            for to, key, ids, _, frame in zip(*columns):
                if index and (to != bucket or place > FILE_BYTES):
                    yield close()
                    number += 1
                    frames, index, place = [], [], HEADER_BYTES
                if to != bucket:
                    bucket, number, start = to, 0, 0
                index.append((key or 0, key is not None, place, len(frame), start, ids))
                frames.append(frame)
                place += len(frame)
                start += ids
        if index:
            yield close()

    written = (
        map_batches(source, compress, "bucket int, doc_id long, ids long, crc long, frame binary")
        .repartitionById(buckets, F.col("bucket"))
        .sortWithinPartitions("bucket", "doc_id", "ids", "crc")
        .mapInArrow(write_files, "bucket long, number long, path string, documents long, ids long")
    )
    return stored(written, folder, "manifest")


def load_index(path: str) -> np.ndarray:
    system, place = file_system(f"{path}.idx")
    with system.open_input_stream(place) as stream:
        return np.frombuffer(stream.read(), dtype=INDEX)


class Reader:
    """Random access to one file of ids."""

    def __init__(self, path: str, dictionary: bytes):
        import zstandard

        system, place = file_system(f"{path}.bin")
        self.file = system.open_input_file(place)
        magic, self.width, hashed = struct.unpack(HEADER, self.file.read(HEADER_BYTES))
        if magic != MAGIC or hashed != dictionary_hash(dictionary):
            raise ValueError(f"{path}.bin: not a file of ids, or written with another dictionary")
        self.zstd = zstandard.ZstdDecompressor(
            dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        )

    def ids(self, row) -> np.ndarray:
        self.file.seek(int(row["place"]))
        return self._decoded(self.file.read(int(row["size"])))

    def run(self, rows: np.ndarray) -> list[np.ndarray]:
        """The ids of documents that follow one another in the file, by one read."""
        first = int(rows["place"][0])
        self.file.seek(first)
        held = memoryview(self.file.read(int(rows["place"][-1]) + int(rows["size"][-1]) - first))
        begins = (rows["place"].astype(np.int64) - first).tolist()
        return [self._decoded(held[begin : begin + size]) for begin, size in zip(begins, rows["size"].tolist())]

    def _decoded(self, frame) -> np.ndarray:
        return np.frombuffer(self.zstd.decompress(frame), dtype=f"<u{self.width}").astype("<u4")

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.file.close()


def load_dictionary(path: str) -> bytes:
    system, place = file_system(f"{path.rpartition('/')[0]}/dictionary.zstd")
    with system.open_input_stream(place) as stream:
        return stream.read()


def read_document(path: str, key: int) -> list[np.ndarray]:
    """The id arrays stored under ``key`` in one file: one index, one or a few frames."""
    index = load_index(path)
    with Reader(path, load_dictionary(path)) as reader:
        return [reader.ids(row) for row in index[(index["key"] == key) & (index["valid"] == 1)]]


def bucket_starts(manifest: DataFrame) -> dict[int, int]:
    """Ids before each bucket; one row per shuffle partition comes to the driver."""
    totals = sorted(manifest.groupBy("bucket").agg(F.sum("ids").alias("ids")).collect())
    before = np.concatenate([[0], np.cumsum([row.ids for row in totals], dtype=np.int64)]).tolist()
    return {row.bucket: start for row, start in zip(totals, before)}


def read(spark: SparkSession, manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """One row per document: doc_id, start (ids before it), n_tokens, ids_crc32, and with ``with_ids`` the ids."""
    starts = bucket_starts(manifest)
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids

    def load(batches):
        for batch in batches:
            for row in batch.to_pylist():
                index = load_index(row["path"])
                with Reader(row["path"], load_dictionary(row["path"])) as reader:
                    for a, b in slices(index["ids"].tolist(), 1_000_000):
                        part = index[a:b]
                        ids = reader.run(part)
                        columns = [
                            pa.array(part["key"], pa.int64(), mask=part["valid"] == 0),
                            pa.array(part["start"].astype(np.int64) + starts[row["bucket"]]),
                            pa.array([len(x) for x in ids], pa.int64()),
                            pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()),
                        ]
                        if with_ids:
                            columns.append(pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())))
                        yield pa.RecordBatch.from_arrays(columns, names)

    files = spread(manifest.select("bucket", "path"), len(starts) * 4)
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return map_batches(files, load, schema)
