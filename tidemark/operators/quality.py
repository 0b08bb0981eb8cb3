"""Data-quality checks: each returns the failing rows; empty means pass.

QC1-QC11 are one lazy query each. QC12 (``single_scan``) folds any number of
row-level checks on one table into one aggregation: one scan, one row of
failure counts. ``run_checks`` evaluates a set of checks and writes the
failing rows of each to ``<out>/test_results/<name>`` (SNK8).
"""

from __future__ import annotations

from functools import reduce
from operator import or_
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.constants import GAP_SHARE_LIMIT


def not_null(df: DataFrame, column: str) -> DataFrame:
    """QC1: rows where ``column`` is NULL."""
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """QC2: values of ``column`` seen more than once (NULLs ignored)."""
    return unique_combination(df.where(F.col(column).isNotNull()), [column])


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """QC3: combinations of ``columns`` seen more than once, with their count.

    A count per key with partial aggregation: a hot key is pre-counted on
    every mapper."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1)


def accepted_values(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """QC4: rows whose value is not one of ``values`` (NULL passes)."""
    return df.where(~F.col(column).isin(list(values)))


def row_count_between(df: DataFrame, min_value: int | None = None, max_value: int | None = None) -> DataFrame:
    """QC5: one row with the row count when it falls outside [min, max]."""
    n = F.col("row_count")
    bad = F.lit(False)
    if min_value is not None:
        bad = bad | (n < min_value)
    if max_value is not None:
        bad = bad | (n > max_value)
    return df.agg(F.count(F.lit(1)).alias("row_count")).where(bad)


def row_count_equal(df: DataFrame, expected: int) -> DataFrame:
    """QC6: one row with the row count when it differs from ``expected``."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") != expected)


def distinct_count_equal(df: DataFrame, column: str, expected: int, approximate: bool = False) -> DataFrame:
    """QC7: one row with the distinct count when it differs from ``expected``.

    ``approximate`` uses a HyperLogLog sketch (fixed memory per task) instead
    of the exact two-phase distinct aggregation."""
    agg = F.approx_count_distinct(column) if approximate else F.count_distinct(F.col(column))
    return df.agg(agg.cast("long").alias("distinct_count")).where(F.col("distinct_count") != expected)


def out_of_bounds(df: DataFrame, bounds: dict[str, tuple[str, float, float]], keys: Iterable[str]) -> DataFrame:
    """QC11: rows with some value outside its bounds, in one scan; a flag column for each value (NULL stays NULL)."""
    flags = {flag: (F.col(c) < low) | (F.col(c) > high) for c, (flag, low, high) in bounds.items()}
    out = df.select(*keys, *[v.alias(k) for k, v in flags.items()])
    return out.where(reduce(or_, [F.col(k) for k in flags]))


def values_between(df: DataFrame, column: str, min_value=None, max_value=None) -> DataFrame:
    """QC8: rows whose value lies outside [min, max] (NULL passes)."""
    c = F.col(column)
    bad = F.lit(False)
    if min_value is not None:
        bad = bad | (c < min_value)
    if max_value is not None:
        bad = bad | (c > max_value)
    return df.where(bad)


def not_in_set(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """QC9: rows whose value is one of the forbidden ``values``."""
    return df.where(F.col(column).isin(list(values)))


def gap_share(fact: DataFrame, limit: float = GAP_SHARE_LIMIT) -> DataFrame:
    """QC10: one row (gap rows, total rows) when more than ``limit`` of the rows flag a gap."""
    return fact.agg(
        F.count_if(F.col("has_data_gap")).cast("long").alias("gap_rows"),
        F.count(F.lit(1)).alias("total_rows"),
    ).where(F.col("gap_rows") > F.col("total_rows") * F.lit(limit))


def single_scan(df: DataFrame, failing: Mapping[str, Column]) -> DataFrame:
    """QC12: many row-level checks in one pass: one row holding, per check,
    the number of failing rows, plus the row count."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(F.coalesce(cond, F.lit(False))).cast("long").alias(name) for name, cond in failing.items()],
    )


def run_checks(
    checks: Mapping[str, Callable[[], DataFrame]], out_dir: str | None = None, threads: int = 1
) -> dict[str, int]:
    """Evaluate checks, ``threads`` at a time as concurrent Spark jobs; write
    each failing set to ``<out_dir>/test_results/<name>`` (SNK8). Returns
    failing-row counts (only counts reach the driver)."""

    def one(name: str, make: Callable[[], DataFrame]) -> int:
        failing = make()
        if out_dir:
            path = f"{out_dir.rstrip('/')}/test_results/{name}"
            failing.write.mode("overwrite").parquet(path)
            return failing.sparkSession.read.parquet(path).count()
        return failing.count()

    if threads <= 1:
        return {name: one(name, make) for name, make in checks.items()}
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=threads) as pool:
        futures = {name: pool.submit(one, name, make) for name, make in checks.items()}
        return {name: f.result() for name, f in futures.items()}


def run_row_checks(df: DataFrame, failing: Mapping[str, Column], out_dir: str | None = None) -> dict[str, int]:
    """QC12 with SNK8: count the failing rows of all checks of a table in one
    scan, then write the rows of each check; one without any writes no rows
    and reads nothing."""
    found = single_scan(df, failing).drop("row_count").first().asDict()
    if out_dir:
        for name, n in found.items():
            rows = df.where(failing[name]) if n else df.limit(0)
            rows.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/test_results/{name}")
    return found
