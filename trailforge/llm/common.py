"""Helpers shared by the operators: the shared folder, written tables, column picking, batches of texts."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextvars import ContextVar

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.shipping import ship

#: Words of every contract: runs of anything but space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see. Where the session names none, a new local one does, but only if
    driver and executors are one process, as in tests."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="trailforge-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def own_folder(spark: SparkSession) -> str:
    """Where this application's tables are. The folder goes with the application's end, or by release()."""
    folder = f"{shared_dir(spark)}/trailforge/{spark.sparkContext.applicationId}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        fs.mkdirs(path)
        fs.deleteOnExit(path)
    return folder


def new_path(spark: SparkSession, label: str) -> str:
    return f"{own_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def release(spark: SparkSession) -> None:
    """Delete all tables that this application has written and that lazy results may read: for use once results are written."""
    delete(spark, own_folder(spark))


_open: ContextVar[tuple[Scratch, ...]] = ContextVar("open scratches", default=())


class Scratch:
    """Collects the tables that written() makes while it is open, and deletes them when it closes, but for those kept.

    Each thread has its own open scratches. A table that a lazy result still reads must be kept; it then belongs to the outer
    scratch or, without one, to the application (own_folder())."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Scratch:
        self.token = _open.set((*_open.get(), self))
        return self

    def keep(self, frame: DataFrame) -> DataFrame:
        """frame, as written() gave it, outlives this scratch."""
        kept = [p for p in self.paths if p[0] is frame]
        self.paths = [p for p in self.paths if p[0] is not frame]
        for outer in _open.get()[-2:-1]:
            outer.paths += kept
        return frame

    def drop(self, frame: DataFrame) -> None:
        """Delete frame, as written() gave it, now."""
        for _, path in [p for p in self.paths if p[0] is frame]:
            delete(self.spark, path)
        self.paths = [p for p in self.paths if p[0] is not frame]

    def __exit__(self, *_) -> None:
        _open.reset(self.token)
        for _, path in self.paths:
            delete(self.spark, path)


def delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def written(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write df as Parquet into the shared folder and read it back."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    found = spark.read.schema(df.schema).parquet(path)
    for scratch in _open.get()[-1:]:
        scratch.paths.append((found, path))
    return found


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hashed(*cols: str):
    """A 64-bit hash of a row's identity; nulls count."""
    return F.xxhash64(*cols)


def give_back() -> None:
    """Return freed memory to the system: a worker lives on after its task, next to the executor's heap."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def lean(run):
    """A function over Arrow batches that gives its memory back when its task ends."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def in_arrow(rows: DataFrame, run, schema: str) -> DataFrame:
    """rows.mapInArrow(run), with the package sent to the workers and their memory given back."""
    ship(rows.sparkSession)
    return rows.mapInArrow(lean(run), schema)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 8 << 20) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Cut Arrow batches so that each holds about `most` bytes of text, or one row if that alone is longer."""
    for batch in batches:
        col = batch.column(column)
        sizes = [0 if n is None else n for n in pa.compute.binary_length(col).to_pylist()]
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if held and held + n > most:
                part = batch.slice(start, i - start)
                yield part, part.column(column).to_pylist()
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            part = batch.slice(start)
            yield part, part.column(column).to_pylist()
