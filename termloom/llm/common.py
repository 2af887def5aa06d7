"""Shared helpers of the training-data operators."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@functools.lru_cache(None)
def _own_dir(application: str) -> str:
    return "file://" + tempfile.mkdtemp(prefix="termloom-")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (spark.checkpoint.dir). Where it is unset a temporary one will do only if
    driver and executors are one process."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = _own_dir(spark.sparkContext.applicationId)
    return path.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/termloom/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage and survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete what materialise() wrote, once nothing that is still to run reads it."""
    for df in tables:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(df.scratch_path)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@functools.lru_cache(None)
def _trim():
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Free memory that the allocators hold goes back to the system: workers live on through later stages."""
    pa.default_memory_pool().release_unused()
    if trim := _trim():
        trim(0)


def parts(batch: pa.RecordBatch, column: int, rows: int, size: int = 2_000_000, tidy: bool = True) -> Iterator[pa.RecordBatch]:
    """Slices of at most `rows` rows whose texts hold at most `size` bytes (or one row). tidy: give_back() after the last."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at, before = 0, 0
    while at < batch.num_rows:
        upto = min(at + rows, max(at + 1, int(np.searchsorted(ends, before + size, side="right"))), batch.num_rows)
        yield batch.slice(at, upto - at)
        at, before = upto, int(ends[upto - 1])
    if tidy:
        give_back()


def in_split(doc_id, modulus: int, held: int):
    """True for the held-out rows: crc32 of the decimal id, modulo modulus, equals held. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % F.lit(modulus) == F.lit(held), F.lit(False))
