"""What several operators of this package share: tables, cut lineage, packed Arrow columns."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, as spark.checkpoint.dir names it.

    Where the cluster names none, a temporary folder serves in local mode only.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="run-llm-"))
    return sc.getCheckpointDir()


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Steps that end within have their shuffle files removed at once. For steps whose
    result is saved: what is computed from it never asks for those files."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def cut(df: DataFrame) -> DataFrame:
    """Compute df once and go on from its copy in the shared folder, which survives
    lost executors."""
    shared_folder(df.sparkSession)
    with released(df.sparkSession):
        return df.checkpoint()


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str) -> DataFrame:
    """df written to a folder and read from there. Unlike what `cut` keeps, it can be deleted,
    empty tasks leave no file, and small files are read together."""
    with released(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete what a finished step no longer needs."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def texts(column: pa.ChunkedArray | pa.Array) -> list[str]:
    """The strings of an Arrow column, null as empty."""
    return [x or "" for x in column.to_pylist()]


def blobs(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """The byte strings of an Arrow column, null as empty."""
    return [x or b"" for x in column.to_pylist()]


def held_out(doc_id: Column) -> Column:
    """The third of the rows that no model learns from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def give_back() -> None:
    """Hand memory that is free again back to the system. Python workers are used again for
    other steps and would keep it; allocators that know no such call keep it as before."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(run: Callable[..., pa.Table], *tables: pa.Table) -> pa.Table:
    """run(*tables), after which the task gives back what it used on the way."""
    out = run(*tables)
    give_back()
    return out


def lean_batches(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, which at its end gives back what it used."""

    def batched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return batched


def joined(parts: list[np.ndarray], dtype) -> np.ndarray:
    return np.concatenate(parts) if parts else np.empty(0, dtype)


def small_batches(df: DataFrame) -> DataFrame:
    """df, after lowering how many rows its session hands to a Python worker at once: long
    texts make Spark's usual 10,000 rows gigabytes. A lower setting stays."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key, "10000")) <= 512:
        conf.set(key, "512")
    return df
