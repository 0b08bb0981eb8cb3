"""Distributed RANK() over a whole DataFrame (no PARTITION BY).

A window without partitioning moves every row into one task. Instead:
1. range-partition the rows on (sort key, unique row tag): partitions hold
   contiguous runs of the sort order, and a key shared by a huge number of
   rows (a hot tie, e.g. NULL) is spread over several partitions;
2. rank inside each range partition (a window partitioned by the range
   partition number, so many tasks work at once);
3. correct with a table of one row per partition (broadcast: its size is the
   partition count): rows in earlier partitions, minus the rows of earlier
   partitions that tie with this partition's first key.
The result equals RANK() OVER (ORDER BY key): ties share the lowest rank and
the next distinct key skips ahead.

Below a checked row bound (``single_task_rows``, default 100k narrow rows)
the rank runs as one plain window instead: the input is counted first, so a
single task only ever sees a bounded number of rows, exactly like a
broadcast behind a size check.

The input is read several times (range sampling, the shuffle, the branches),
so it is materialised first with a reliable checkpoint in the shared
``spark.checkpoint.dir``. The row tag is taken after that checkpoint, so it
is the same every time it is read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import scratch_root


def _sort_expr(key: str, ascending: bool, nulls_first: bool | None):
    if nulls_first is None:
        nulls_first = ascending
    c = F.col(key)
    if ascending:
        return c.asc_nulls_first() if nulls_first else c.asc_nulls_last()
    return c.desc_nulls_first() if nulls_first else c.desc_nulls_last()


def _rank_one(df: DataFrame, key: str, rank_col: str, ascending: bool, nulls_first, n: int) -> DataFrame:
    order = _sort_expr(key, ascending, nulls_first)
    tagged = df.withColumn("__tag", F.monotonically_increasing_id())
    ranged = (
        tagged.repartitionByRange(n, order, F.col("__tag"))
        .withColumn("__part", F.spark_partition_id())
        .checkpoint(eager=True)
    )
    local = ranged.withColumn("__local", F.rank().over(Window.partitionBy("__part").orderBy(order)))

    # One row per non-empty range partition: its first and last key in sort
    # order, its size, and how many rows carry its last key.
    stats = local.groupBy("__part").agg(
        F.count(F.lit(1)).alias("__n"),
        F.min_by(F.col(key), F.col("__local")).alias("__first"),
        F.max_by(F.col(key), F.col("__local")).alias("__last"),
        F.max("__local").alias("__max_local"),
    ).withColumn("__at_last", F.col("__n") - F.col("__max_local") + 1)
    # These windows run over the partition table only (bounded by the partition count).
    w = Window.orderBy("__part")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    has_prev = F.lag("__part").over(w).isNotNull()
    stats = stats.withColumns(
        {
            "__offset": F.coalesce(F.sum("__n").over(before), F.lit(0)),
            "__run": F.sum(
                F.when(has_prev & F.lag("__last").over(w).eqNullSafe(F.col("__last")), 0).otherwise(1)
            ).over(w.rowsBetween(Window.unboundedPreceding, 0)),
        }
    )
    stats = stats.withColumn(
        "__run_rows",
        F.sum("__at_last").over(Window.partitionBy("__run").orderBy("__part").rowsBetween(Window.unboundedPreceding, 0)),
    )
    # Rows of earlier partitions that tie with this partition's first key: the
    # earlier partitions whose last key equals it form the run just before.
    stats = stats.withColumn(
        "__carry",
        F.when(has_prev & F.lag("__last").over(w).eqNullSafe(F.col("__first")), F.lag("__run_rows").over(w)).otherwise(0),
    ).select("__part", "__first", "__offset", "__carry")

    out = local.join(F.broadcast(stats), "__part").withColumn(
        rank_col,
        (
            F.col("__offset")
            - F.when(F.col(key).eqNullSafe(F.col("__first")), F.col("__carry")).otherwise(0)
            + F.col("__local")
        ).cast("long"),
    )
    return out.drop("__part", "__tag", "__local", "__first", "__offset", "__carry")


SINGLE_TASK_ROWS = 100_000


def global_ranks(
    df: DataFrame,
    specs: Sequence[tuple[str, str, bool]],
    nulls_first: bool | None = None,
    partitions: int | None = None,
    single_task_rows: int = SINGLE_TASK_ROWS,
    materialize: bool = True,
) -> DataFrame:
    """Add one RANK() column per (key, rank_col, ascending) spec.

    Null placement follows Spark's default unless ``nulls_first`` is given
    (ascending: nulls first; descending: nulls last). Pass
    ``materialize=False`` when ``df`` is already read from a checkpoint or a
    written table.
    """
    spark = df.sparkSession
    scratch_root(spark)  # make sure a checkpoint folder is set (tests)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The upstream runs once; every later read comes from the checkpoint.
    out = df.checkpoint(eager=True) if materialize else df
    if out.limit(single_task_rows + 1).count() <= single_task_rows:
        for key, rank_col, ascending in specs:
            order = _sort_expr(key, ascending, nulls_first)
            out = out.withColumn(rank_col, F.rank().over(Window.orderBy(order)).cast("long"))
        return out
    for key, rank_col, ascending in specs:
        out = _rank_one(out, key, rank_col, ascending, nulls_first, n)
    return out


def global_rank(
    df: DataFrame,
    key: str,
    rank_col: str,
    ascending: bool = True,
    nulls_first: bool | None = None,
    partitions: int | None = None,
    single_task_rows: int = SINGLE_TASK_ROWS,
) -> DataFrame:
    """Add ``rank_col`` = RANK() OVER (ORDER BY key [ASC|DESC])."""
    return global_ranks(df, [(key, rank_col, ascending)], nulls_first, partitions, single_task_rows)
