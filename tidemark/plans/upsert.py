"""Table writes: full rebuild (SNK3, SNK6), incremental upsert (SNK4, ST1),
partition layout (SNK7), incremental fact append (M23).

Parquet tables have no MERGE, so an upsert rewrites only the partitions a
batch touches:
1. the batch is de-duplicated (newest ingestion per key);
2. the target rows of the touched partitions are read (static partition
   pruning: the touched partition values are a short literal list);
3. target rows whose key is in the batch are dropped (matched -> update) and
   the batch rows are added (unmatched -> insert); nothing is deleted;
4. the result is written to a fresh staging folder first, then moved into
   the target with dynamic partition overwrite. A table is never read and
   overwritten lazily in the same plan, and a lost executor only repeats
   tasks of a job whose output is not yet committed.

The key must determine the partition (e.g. month of price_date), otherwise
an updated key could leave its old copy in another partition.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.staging import latest_per_key
from tidemark.session import scratch_path

# A batch touching more partitions than this is merged with a join instead of a literal list.
MAX_LITERAL_PARTITIONS = 10_000


def month_partition(date_col: str = "price_date") -> Column:
    """SNK7: monthly partitions (daily ones would be tiny files)."""
    return F.date_format(F.col(date_col), "yyyy-MM")


def _data_files(fs, path) -> bool:
    """True when some file below ``path`` is neither hidden nor a marker. Errors of the store are raised."""
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        if name.startswith(("_", ".")):
            continue
        if not status.isDirectory() or _data_files(fs, status.getPath()):
            return True
    return False


def table_exists(spark: SparkSession, path: str) -> bool:
    """False only when ``path`` is absent or holds no data file.

    Whatever else goes wrong (a permission, a broken file, a store that does
    not answer) is raised: taking it for a missing table would let an upsert
    replace the whole target by one batch.
    """
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(jpath)) and _data_files(fs, jpath)


def _remove(spark: SparkSession, path: str) -> None:
    """Free a scratch folder of our own once its rows are committed."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)


def _write(df: DataFrame, path: str, partition_col: str, mode: str, dynamic: bool, sort_cols: Sequence[str]) -> None:
    # REBALANCE on the partition column: one shuffle, AQE splits an oversized
    # (hot) partition over several writer tasks and merges small ones, with no
    # extra sampling pass over the input; files are sorted by the cluster keys
    # (parquet min/max statistics then skip other symbols).
    writer = (
        df.hint("rebalance", partition_col)
        .sortWithinPartitions(partition_col, *sort_cols)
        .write.mode(mode)
        .partitionBy(partition_col)
    )
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def full_refresh(df: DataFrame, path: str, partition: Column, partition_col: str = "part", sort_cols=()) -> None:
    """SNK3/SNK6: rebuild the whole table."""
    _write(df.withColumn(partition_col, partition), path, partition_col, "overwrite", False, sort_cols)


def upsert(
    spark: SparkSession,
    target_path: str,
    batch: DataFrame,
    keys: Sequence[str],
    order_desc: Sequence[str | Column],
    partition: Column,
    partition_col: str = "part",
    prefer: str = "batch",
    sort_cols: Sequence[str] = (),
    max_literal_partitions: int = MAX_LITERAL_PARTITIONS,
    stored: bool = False,
) -> None:
    """SNK4: merge ``batch`` into the parquet table at ``target_path``.

    ``prefer="batch"``: a matched key takes the batch row (MERGE ... WHEN
    MATCHED THEN UPDATE). ``prefer="latest"``: the row with the greatest
    ``order_desc`` wins, so the result does not depend on batch order (used
    by the streaming path). A missing or empty target is a full load.

    The de-duplicated batch is written once and read from there, so its
    upstream runs once; ``stored`` says that the batch has one row per key and
    is read from a table already. NULL keys and NULL partition values match themselves:
    rows of the NULL partition are read and kept like any others. Tables are
    read with the batch's schema (a partition column that holds only NULL has
    no type of its own).
    """
    batch_path, stage = scratch_path(spark, "upsert-batch"), scratch_path(spark, "upsert-stage")
    fresh = (batch if stored else latest_per_key(batch, keys, order_desc)).withColumn(partition_col, partition)
    schema = fresh.schema
    if not table_exists(spark, target_path):
        _write(fresh, target_path, partition_col, "overwrite", False, sort_cols)
        return
    if not stored:
        fresh.write.parquet(batch_path)
        fresh = spark.read.schema(schema).parquet(batch_path)
    target = spark.read.schema(schema).parquet(target_path)
    touched_df = fresh.select(F.col(partition_col).alias("__touched")).distinct()
    touched = [r[0] for r in touched_df.limit(max_literal_partitions + 1).collect()]
    if len(touched) <= max_literal_partitions:
        wanted = F.col(partition_col).isin([v for v in touched if v is not None])
        current = target.where(wanted | F.col(partition_col).isNull() if None in touched else wanted)
    else:
        current = target.join(touched_df, target[partition_col].eqNullSafe(touched_df["__touched"]), "left_semi")
    cols = fresh.columns
    if prefer == "batch":
        taken = fresh.select(*[F.col(k).alias(f"__taken_{k}") for k in keys])
        same = reduce(and_, [current[k].eqNullSafe(taken[f"__taken_{k}"]) for k in keys])
        merged = current.join(taken, same, "left_anti").select(*cols).unionByName(fresh)
    else:
        merged = latest_per_key(current.select(*cols).unionByName(fresh), keys, order_desc)
    _write(merged, stage, partition_col, "overwrite", False, sort_cols)
    staged = spark.read.schema(schema).parquet(stage)
    _write(staged, target_path, partition_col, "overwrite", True, sort_cols)
    _remove(spark, batch_path)
    _remove(spark, stage)


def incremental_watermark(spark: SparkSession, target_path: str, column: str = "__de_processed_at") -> dt.datetime | None:
    """SNK5: the latest ingestion time already loaded, as an instant with its
    zone (UTC, whatever the driver's own zone); None for a missing or empty
    target (which must then be loaded in full)."""
    if not table_exists(spark, target_path):
        return None
    micros = spark.read.parquet(target_path).agg(F.unix_micros(F.max(F.col(column).cast("timestamp")))).first()[0]
    return None if micros is None else dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(microseconds=micros)
