"""The data checks of the batch job: what each written table must satisfy.

A table's row checks (null, accepted value, range, forbidden value) share one
scan; keys, counts and shares take one aggregation each. Expected counts come
from the registry that the job was run with, not from fixed numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.constants import ASSET_CLASSES, ASSET_TYPES
from tidemark.operators import quality


def nulls(*columns: str) -> dict[str, Column]:
    return {f"{c}_not_null": F.col(c).isNull() for c in columns}


def outside(column: str, low: float | None = None, high: float | None = None) -> Column:
    c, bad = F.col(column), F.lit(False)
    if low is not None:
        bad = bad | (c < low)
    return bad if high is None else bad | (c > high)


# Row checks by table: name -> condition of a failing row.
def row_checks(benchmark: str) -> dict[str, dict[str, Column]]:
    return {
        "raw_bars": nulls("symbol"),
        "raw_chart": nulls("coin_id", "raw_json"),
        "stg_bars": nulls("symbol", "price_date", "close_price"),
        "stg_chart": nulls("symbol", "price_date", "close_price"),
        "dim_assets": nulls("symbol", "asset_type", "asset_class")
        | {
            "type_accepted": ~F.col("asset_type").isin(*ASSET_TYPES),
            "class_accepted": ~F.col("asset_class").isin(*ASSET_CLASSES),
        },
        "dim_dates": nulls("date_key"),
        "fact": nulls("price_key", "symbol", "price_date", "close_price"),
        "rolling": nulls("symbol", "price_date", "close_price"),
        "relative": nulls("symbol", "price_date") | {"no_benchmark": F.col("symbol").isin(benchmark)},
        "latest": nulls("symbol", "latest_date"),
        "correlation": nulls("symbol_a", "symbol_b", "correlation")
        | {"correlation_range": outside("correlation", -1.0, 1.0), "obs_count_range": outside("obs_count", 1)},
    }


def table_checks(tables: Mapping[str, DataFrame], registry: DataFrame) -> dict[str, Callable[[], DataFrame]]:
    """Checks over a whole table: keys, row and distinct counts, the share of gaps."""
    # One row per asset: a bounded side of literals, counted once.
    size = registry.agg(
        F.count(F.lit(1)).alias("assets"), F.count_if(~F.col("asset_type").eqNullSafe("crypto")).alias("bars")
    ).first()
    assets, bars = size["assets"], size["bars"]
    t = tables
    unique_on = {
        "stg_bars": ["symbol", "price_date"],
        "stg_chart": ["symbol", "price_date"],
        "fact": ["symbol", "price_date"],
        "rolling": ["symbol", "price_date"],
        "relative": ["symbol", "price_date"],
        "correlation": ["symbol_a", "symbol_b"],
    }
    keys = {"fact": "price_key", "dim_assets": "symbol", "dim_dates": "date_key"}
    symbols = {"stg_bars": bars, "fact": assets, "rolling": assets, "relative": assets - 1}
    out: dict[str, Callable[[], DataFrame]] = {}
    for name, columns in unique_on.items():
        out[f"{name}_unique_{'_'.join(c.replace('price_', '') for c in columns)}"] = partial(
            quality.unique_combination, t[name], columns
        )
    for name, column in keys.items():
        out[f"{name}_{column}_unique"] = partial(quality.unique, t[name], column)
    for name, n in symbols.items():
        out[f"{name}_distinct_symbols"] = partial(quality.distinct_count_equal, t[name], "symbol", n)
    for name in ("stg_bars", "stg_chart", "fact", "rolling"):
        out[f"{name}_has_rows"] = partial(quality.row_count_between, t[name], 1)
    out["dim_assets_row_count"] = partial(quality.row_count_equal, t["dim_assets"], assets)
    out["correlation_row_count"] = partial(quality.row_count_equal, t["correlation"], assets * (assets - 1) // 2)
    out["data_gap_threshold"] = partial(quality.gap_share, t["fact"])
    return out


def run_job_checks(
    tables: Mapping[str, DataFrame], registry: DataFrame, benchmark: str, out_dir: str | None = None, threads: int = 1
) -> dict[str, int]:
    """Failing rows of every check by name; the rows themselves are written as in ``quality.run_checks``."""
    counts = quality.run_checks(table_checks(tables, registry), out_dir, threads)

    def rows(table: tuple[str, dict[str, Column]]) -> dict[str, int]:
        name, failing = table
        return quality.run_row_checks(tables[name], {f"{name}_{k}": v for k, v in failing.items()}, out_dir)

    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        for found in pool.map(rows, row_checks(benchmark).items()):
            counts |= found
    return counts
