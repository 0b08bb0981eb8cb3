"""Builds the star schema (dims + fact) from the driver tables.

Shared by ``__spark_entry__``, ``bench.py`` and the tests, so every query
reads whole tables and derives everything with Spark.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.dims import dim_assets, dim_dates
from tidemark.operators.facts import bars_source, calendar_span, chart_source, combine_sources, fact_daily_prices, with_returns
from tidemark.plans.sizing import bounded_broadcast
from tidemark.sources import fixtures as fx


@dataclass
class Star:
    registry: DataFrame
    assets: DataFrame
    dates: DataFrame
    fact: DataFrame


def build_star(
    registry: DataFrame,
    stg_bars: DataFrame,
    stg_chart: DataFrame | None = None,
    as_of: str | None = None,
    registry_rows: int | None = None,
    slice_rows: int | None = None,
    weekdays_only: bool = False,
) -> Star:
    """``slice_rows`` cuts long series over tasks. ``weekdays_only`` gives a calendar with holes, which the fact joins."""
    staged = [stg_bars] + ([stg_chart] if stg_chart is not None else [])
    assets = dim_assets(registry, *staged)
    dates = dim_dates(assets, as_of=as_of)
    # dim_assets has at most one row per (registry row, source): the registry bounds it.
    known = registry_rows * len(staged) if registry_rows is not None else None
    assets_side = bounded_broadcast(assets, probe=registry, factor=len(staged), known_bound=known)
    if weekdays_only:
        dates = dates.where(F.weekday("date_key") < 5)
    # dim_dates has every day between its first and last one, so a range test stands for the join with it.
    span = None if weekdays_only else calendar_span(dates)
    sources = [bars_source(stg_bars)] + ([chart_source(stg_chart)] if stg_chart is not None else [])
    fact = fact_daily_prices(combine_sources(*sources), assets_side, dates, span=span, slice_rows=slice_rows)
    return Star(registry, assets, dates, fact)


def orders_star(spark: SparkSession, sf_dir: str, with_events: bool = False, **kw) -> Star:
    """Star over the order-priority bars, optionally with the event bars as a second source."""
    reg = fx.registry(spark)
    chart = fx.chart_events(spark, sf_dir) if with_events else None
    return build_star(reg, fx.bars_orders(spark, sf_dir), chart, as_of=fx.AS_OF, registry_rows=len(fx.DRIVER_REGISTRY), **kw)


def brands_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily returns of the brand bars (symbol, price_date, daily_return, ...)."""
    return with_returns(combine_sources(bars_source(fx.bars_brands(spark, sf_dir))))
