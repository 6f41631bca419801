"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession


#: Rows of an Arrow batch while an operator writes an intermediate table; rows can be long texts.
BATCH_ROWS = 2000
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_GLIBC: list[ctypes.CDLL] = []


def trim() -> None:
    """In a Python worker of Spark: makes it give large arrays back to the system when they are freed, and gives freed small blocks back now."""
    if TaskContext.get() is None:
        return
    if not _GLIBC:
        library = ctypes.CDLL(None)
        if not (hasattr(library, "mallopt") and hasattr(library, "malloc_trim")):
            return
        library.mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD
        pa.set_memory_pool(pa.system_memory_pool())
        _GLIBC.append(library)
    _GLIBC[0].malloc_trim(0)


@contextlib.contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Batches of at most BATCH_ROWS rows for what runs inside; the session's setting comes back after it."""
    old = spark.conf.get(_ROWS)
    if not 0 < int(old) <= BATCH_ROWS:
        spark.conf.set(_ROWS, str(BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(_ROWS, old)


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where it is unset (tests) one of our own."""
    sc = spark.sparkContext
    held = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not held:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        held = tempfile.mkdtemp(prefix="filigree-")
        atexit.register(shutil.rmtree, held, ignore_errors=True)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(held)
    return held


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written as Parquet in the shared folder and read back: it cuts lineage and survives a lost executor."""
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")
    with small_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without(df: DataFrame, *names: str) -> DataFrame:
    """The frame without its columns of these names, in any case."""
    gone = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in gone])


def text_slices(batch: pa.RecordBatch, column: str, chars: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of bounded text size."""
    if not batch.num_rows:
        return
    trim()
    sizes = np.array(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    group = (np.cumsum(sizes) - sizes) // chars
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(group)) + 1, [batch.num_rows]))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        yield batch.slice(a, b - a)
    trim()
