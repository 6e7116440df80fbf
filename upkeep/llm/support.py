"""The shared folder of a run, stored tables, and access to files by URI from inside tasks."""

from __future__ import annotations

import os
import posixpath
import tempfile
import uuid

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one that the cluster names in ``spark.checkpoint.dir``.

    With no such setting a temporary folder is made for a single-process session (``local[...]``), whose tasks all see
    it.  On a cluster the setting is required, because executors do not share their local folders.
    """
    ship_code(spark)
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if base is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="upkeep-shared-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(base)
    return f"{base.rstrip('/')}/run-{uuid.uuid4().hex}"


def ship_code(spark: SparkSession) -> None:
    """Lets Python workers import this package from the driver's place; a cluster ships it by --py-files."""
    environment, root = spark.sparkContext.environment, os.path.abspath(f"{__file__}/../../..")
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, *paths]))


#: What a worker keeps between tasks (tokenizers and their tables), and the operator it last worked for.
KEPT: dict = {}
OWNER: list[str] = [""]


def turn_to(operator: str) -> None:
    """A worker that turns to another operator gives back what it kept for the one before."""
    if OWNER[0] != operator:
        KEPT.clear()
        OWNER[0] = operator


def kept(key, make):
    if key not in KEPT:
        KEPT[key] = make()
    return KEPT[key]


def map_batches(df: DataFrame, work, schema) -> DataFrame:
    """``mapInArrow`` for a function of one of this package's modules."""
    ship_code(df.sparkSession)
    operator = work.__module__

    def begin(batches):
        turn_to(operator)
        return work(batches)

    return df.mapInArrow(begin, schema)


def parts(batch: pa.RecordBatch, column: int, most: int = 1_500_000):
    """A batch in parts whose texts are of about ``most`` bytes together, so that few are Python objects at a time."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    for start, end in slices(sizes, most):
        yield batch.slice(start, end - start)


def stored(df: DataFrame, folder: str, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read from there: later jobs neither recompute it nor lose it."""
    path = f"{folder}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, rows: int) -> DataFrame:
    """One task for each of a few heavy rows (a file, a byte range, an index block), as far as that makes sense."""
    return df.repartition(max(1, min(rows, 20_000)))


def text_of(df: DataFrame, column: str = "text") -> Column:
    """The text, null counted as empty."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


def file_system(uri: str):
    """``(filesystem, path)`` for a URI of the shared folder; also for plain local paths."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{os.path.abspath(uri)}")


def write_file(uri: str, blocks) -> int:
    """Write byte blocks under a temporary name and move it in place; a task that dies leaves no half file there."""
    system, path = file_system(uri)
    system.create_dir(posixpath.dirname(path), recursive=True)
    unfinished, size = f"{path}.{uuid.uuid4().hex}.unfinished", 0
    with system.open_output_stream(unfinished) as out:
        for block in blocks:
            out.write(block)
            size += len(block)
    system.move(unfinished, path)
    return size


def slices(sizes, most: int):
    """Ranges ``(start, end)`` over items of the given sizes, each range of about ``most`` in sum and one item at least."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def whole_groups(batches, column: int):
    """Arrow tables that hold complete groups, from batches sorted by ``column`` (not null)."""
    pending = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        keys = batch.column(column).to_numpy(zero_copy_only=False)
        last = int((keys != keys[-1]).sum())  # sorted, so the last group is at the end
        if pending and keys[0] != pending[-1].column(column)[0].as_py() and last == 0:
            yield pa.Table.from_batches(pending)
            pending = []
        if last:
            yield pa.Table.from_batches([*pending, batch.slice(0, last)])
            pending = []
        pending.append(batch.slice(last))
    if pending:
        yield pa.Table.from_batches(pending)
