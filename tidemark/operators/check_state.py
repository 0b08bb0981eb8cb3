"""QC1-QC4, QC6-QC8, QC10 over growing tables: check state by partition, stored and merged.

A full check scans the whole history on each run. Here each partition of a
table leaves a small state: its rows, the failing rows of each row check, the
keys it holds more than once, and how often it holds each value of a column
whose distinct values are counted. States merge by addition, so a run computes
those of the partitions that it wrote and reads the stored rest; old
partitions are not scanned again. A corrected partition replaces its state.

A unique key must determine the partition (the month of its date, say), so
that no key lies in two of them; tables of ``plans.upsert`` are laid out so.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS = "row_count"
SCHEMA = "kind string, check string, value string, n long, part string"


@dataclass(frozen=True)
class Checks:
    """Row checks by name (condition of a failing row), unique keys by name, columns whose distinct values are counted."""

    rows: Mapping[str, Column] = field(default_factory=dict)
    unique: Mapping[str, Sequence[str]] = field(default_factory=dict)
    distinct: Mapping[str, str] = field(default_factory=dict)


def partition_state(df: DataFrame, checks: Checks, part: str = "part") -> DataFrame:
    """kind, check, value, n, part: the state of each partition of ``df``. Row checks share one aggregation."""
    of = F.col(part).cast("string").alias("part")
    none = F.lit(None).cast("string").alias("value")
    counts = {ROWS: F.lit(True), **checks.rows}
    totals = df.groupBy(of).agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(f"c{i}") for i, c in enumerate(counts.values())])
    pairs = F.array(*[F.struct(F.lit(name).alias("check"), F.col(f"c{i}").alias("n")) for i, name in enumerate(counts)])
    out = [totals.select("part", F.explode(pairs).alias("p")).select(F.lit("rows").alias("kind"), "p.check", none, "p.n", "part")]
    for name, keys in checks.unique.items():
        twice = df.groupBy(of, *keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        # A partition without repeated keys says so by its absence; its rows are counted above.
        out.append(twice.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(F.lit("unique").alias("kind"), F.lit(name).alias("check"), none, "n", "part"))
    for name, column in checks.distinct.items():
        values = df.where(F.col(column).isNotNull()).groupBy(of, F.col(column).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))
        out.append(values.select(F.lit("distinct").alias("kind"), F.lit(name).alias("check"), "value", "n", "part"))
    return reduce(DataFrame.unionByName, out)


def update_state(spark: SparkSession, state_path: str, table: DataFrame, checks: Checks, written: Iterable[str] | None = None, part: str = "part") -> None:
    """Store the state of the ``written`` partitions (of all, if None), in place of what was stored of them.

    Only these partitions of ``table`` are scanned. Each has a row count at least, so replacing by partition leaves
    nothing of its former state.
    """
    if written is not None:
        table = table.where(F.col(part).cast("string").isin(list(written)))
    rows = partition_state(table, checks, part).withColumnRenamed("part", "of_part")
    rows.repartition("of_part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if written is not None else "static").partitionBy("of_part").parquet(state_path)


def merged_checks(spark: SparkSession, state_path: str) -> DataFrame:
    """check, n over all partitions: rows, failing rows of each row check, repeated keys, distinct values."""
    state = spark.read.schema(SCHEMA.replace("part string", "of_part string")).parquet(state_path)
    summed = state.where("kind != 'distinct'").groupBy("check").agg(F.sum("n").alias("n"))
    # Values are reduced to one row each before they are counted.
    values = state.where("kind = 'distinct'").select("check", "value").distinct().groupBy("check").agg(F.count(F.lit(1)).alias("n"))
    return summed.unionByName(values)


def all_checks(spark: SparkSession, state_path: str, checks: Checks) -> DataFrame:
    """``merged_checks`` with a zero for each check that no partition has anything of."""
    names = [*checks.unique, *checks.distinct]
    found = merged_checks(spark, state_path)
    zeros = spark.createDataFrame([(n, 0) for n in names], "check string, n long")
    return found.unionByName(zeros).groupBy("check").agg(F.max("n").alias("n"))
