"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import configure, scratch_root, ship

# Rows per Arrow batch: with texts of a few kB a batch stays at some MB.
BATCH_ROWS = 512


def prepare(spark: SparkSession, batch_rows: int = BATCH_ROWS) -> SparkSession:
    """Session settings of the operators, and the package on the workers' path."""
    configure(spark)
    scratch_root(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch_rows))
    ship(spark)
    return spark


FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame, free: bool = False) -> DataFrame:
    """Reliable checkpoint in the shared folder: later jobs read it, lost executors do not matter.

    With ``free`` Spark removes the shuffle files of the plan when the checkpoint is written, not whenever the driver's
    collector comes by. The setting counts for the frame that is made under it, the last one before the checkpoint.
    """
    spark = df.sparkSession
    scratch_root(spark)
    if not free:
        return df.checkpoint(eager=True)
    before = spark.conf.get(FREE, None)
    spark.conf.set(FREE, "true")
    try:
        return df.select("*").checkpoint(eager=True)
    finally:
        spark.conf.unset(FREE) if before is None else spark.conf.set(FREE, before)


def crc_mod(column: Column, n: int) -> Column:
    """crc32 of a value's text, modulo n (null for null)."""
    return F.crc32(column.cast("string")) % n


def ascii_lower(column: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sorted_groups(df: DataFrame, keys: list[str], order: list[str], fn: Callable[[pa.Table], pa.Table], schema: str, gather: Callable[[Iterator], Iterator[pa.RecordBatch]] | None = None) -> DataFrame:
    """Apply ``fn`` to tables that hold whole key groups, many groups at a time.

    Rows are dealt by ``keys`` and sorted, then streamed; only the last, still
    open group of a batch is held back. ``fn`` must treat groups separately.
    Use it where a group's size is bounded (rows of one document, say).
    ``gather`` turns a task's results of ``fn``, of any kind, into batches.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        results = map(fn, tables(batches))
        yield from gather(results) if gather else (batch for table in results for batch in table.to_batches())

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            start = last_group(batch, keys)
            if held and (start > 0 or not same_key(held[-1], batch, keys)):
                whole = held + ([batch.slice(0, start)] if start else [])
                yield pa.Table.from_batches(whole)
                held = [batch.slice(start)]
            elif start > 0:
                yield pa.Table.from_batches([batch.slice(0, start)])
                held = [batch.slice(start)]
            else:
                held.append(batch)
        if held:
            yield pa.Table.from_batches(held)

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def last_group(batch: pa.RecordBatch, keys: list[str]) -> int:
    """Where the last key group of a sorted batch begins."""
    start = 0
    for key in keys:
        column = batch.column(batch.schema.get_field_index(key))
        values = column.fill_null(0).to_numpy(zero_copy_only=False) if column.null_count else column.to_numpy(zero_copy_only=False)
        differ = np.flatnonzero(values[1:] != values[:-1])
        if column.null_count:
            null = column.is_null().to_numpy(zero_copy_only=False)
            differ = np.union1d(differ, np.flatnonzero(null[1:] != null[:-1]))
        if len(differ):
            start = max(start, int(differ[-1]) + 1)
    return start


def same_key(before: pa.RecordBatch, after: pa.RecordBatch, keys: list[str]) -> bool:
    at = [before.schema.get_field_index(k) for k in keys]
    return all(before.column(i)[before.num_rows - 1].as_py() == after.column(i)[0].as_py() for i in at)


def binary_rows(flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    """One binary value per row: row i holds the items of ``flat`` up to ends[i] from ends[i - 1]."""
    offsets = np.concatenate(([0], ends)).astype(np.int64) * flat.itemsize
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(flat))]
    ).cast(pa.binary())


class Table:
    """Integer keys to row numbers by open addressing, looked up a whole array at a time."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 4))))
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.rows = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)
        todo, at = np.arange(len(keys)), self.place(keys)
        while len(todo):
            free = self.rows[at] < 0
            self.rows[at[free]] = todo[free]  # of several rows for one slot the last stays
            self.keys[at[free]] = keys[todo[free]]
            put = self.rows[at] == todo
            todo, at = todo[~put], (at[~put] + 1) & self.mask

    def place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        at = self.place(keys)
        found = self.rows[at]
        odd = np.flatnonzero((found >= 0) & (self.keys[at] != keys))
        while len(odd):
            at[odd] = (at[odd] + 1) & self.mask
            found[odd] = self.rows[at[odd]]
            odd = odd[(found[odd] >= 0) & (self.keys[at[odd]] != keys[odd])]
        return found
