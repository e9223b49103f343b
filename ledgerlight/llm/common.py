"""Helpers that every operator of this folder shares."""

from __future__ import annotations

import ctypes
import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.storage import discard, shared_dir, stored, stored_bytes

__all__ = ["discard", "shared_dir"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage, survives lost executors, has known statistics."""
    out = stored(df, tag)
    if _SCRATCH.open:
        _SCRATCH.open[-1].append(out)
    return out


class _Scratch(threading.local):
    """Tables written inside each open scratch() of a thread, innermost last."""

    def __init__(self) -> None:
        self.open: list[list[DataFrame]] = []


_SCRATCH = _Scratch()


@contextmanager
def scratch() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables that are materialized inside are deleted at the end, except those that keep() is called with: what is
    returned must have been written by then, or rest on kept tables alone."""
    tables: list[DataFrame] = []
    _SCRATCH.open.append(tables)

    def keep(df: DataFrame) -> DataFrame:
        if any(df is t for t in tables):
            tables[:] = [t for t in tables if t is not df]
            if len(_SCRATCH.open) > 1:
                _SCRATCH.open[-2].append(df)
        return df

    try:
        yield keep
    finally:
        _SCRATCH.open.pop()
        for df in tables:
            discard(df)


#: A table is broadcast if its files are at most this large; unpacked it is a few times that.
BROADCAST_BYTES = 4 << 20


def small(df: DataFrame) -> DataFrame:
    """df, marked for broadcast if it was materialized and its files are measured to be small; else as it is, and Spark
    joins by shuffle, splitting skewed keys."""
    size = stored_bytes(df)
    return F.broadcast(df) if size is not None and size <= BROADCAST_BYTES else df


def gathered(df: DataFrame) -> DataFrame:
    """df, of narrow rows and about to be written, dealt evenly over an eighth of the shuffle's partitions, but no fewer
    than there are cores: a file costs the same however little is in it, and processes on a local disk (ledgerlight.storage)."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(-(-n // 8), min(n, spark.sparkContext.defaultParallelism), 1))


def write_bytes(spark: SparkSession, name: str, data: bytes) -> str:
    """Write a small driver-side artefact to the shared folder through Spark's own file system layer."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{name}")
    out = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    return where.toString()


def local_table(spark: SparkSession, columns: dict[str, pa.Array]) -> DataFrame:
    """A small driver-side table as a local relation, whose size the planner knows."""
    return spark.createDataFrame(pa.table(columns))


def column_or_null(df: DataFrame, name: str, kind: str):
    """df[name], or a typed null where the table has no such column."""
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast(kind).alias(name)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """A column of strings; null becomes empty."""
    return [x or "" for x in batch.column(batch.schema.get_field_index(name)).to_pylist()]


#: Most bytes of a batch of rows that goes to a Python worker.
BATCH_BYTES = "4m"


def arrow_map(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """df.mapInArrow(run, schema) for texts: batches are bounded by bytes in the session, as texts can be long, and a
    worker gives its free memory back when a task ends, as workers live on and share their machine with the next stage."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())
        try:
            yield from run(batches)
        finally:
            trim()

    return df.mapInArrow(tidy, schema)


def trim() -> None:
    """Give free memory back to the system, where the C library can."""
    with suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def in_chunks(batches: Iterator[pa.RecordBatch], name: str, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most about most_bytes in the column, so that very long texts keep memory bounded."""
    for batch in batches:
        at = batch.schema.get_field_index(name)
        sizes = [len(x.as_buffer()) if x.is_valid else 0 for x in batch.column(at)] if batch.column(at).nbytes > most_bytes else None
        if sizes is None:
            yield batch
            continue
        start = total = 0
        for i, n in enumerate(sizes):
            if total and total + n > most_bytes:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        yield batch.slice(start)
