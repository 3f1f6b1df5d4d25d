"""Helpers shared by the operators: table reads, written tables, Arrow text."""

from __future__ import annotations

import ctypes
import functools
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, temporary_conf

FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Bytes of one Arrow batch.  10,000 texts, Spark's measure, are some 33 MB, which
#: the JVM holds outside its heap, more than once while a buffer grows, and so
#: does each worker; the operators work on ``STEP`` bytes at once.
BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))

#: Fixed by the contract of the trained operators: rows with this remainder
#: of crc32(doc_id as text) modulo 4 are held out of all training.
HELD_OUT_MOD, HELD_OUT_REST = 4, 2


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Named columns of one of the given parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def small_batches(step: Callable) -> Callable:
    """A query or stage whose Arrow batches hold ``BATCH_BYTES``: set for the
    session, since its result runs after it has returned."""

    @functools.wraps(step)
    def run(spark: SparkSession, *args):
        spark.conf.set(*BATCH_BYTES)
        return step(spark, *args)

    return run


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder of ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/joblens-llm/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: a lineage cut that
    survives lost executors.  The shuffles behind it are no longer needed, so
    their files go when the write ends."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    with temporary_conf(spark, {FREE_SHUFFLES: "true"}):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """True where crc32 of the decimal doc_id leaves the held-out remainder (null id: False)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % HELD_OUT_MOD == HELD_OUT_REST, F.lit(False))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary Arrow column; nulls are empty."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    size = 8 if wide else 4
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32, len(column) + 1, column.offset * size).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def release() -> None:
    """Give back what the allocators hold free: workers live on between tasks,
    and the next stage counts on its share of the executor's memory."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
    if trim:
        trim(0)


def slices(offsets: np.ndarray, limit: int):
    """Row ranges [a, b) of at most ``limit`` bytes, or one longer row alone."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated index ranges start..start+length of a ragged array."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts.astype(np.int64) - before, lengths)
