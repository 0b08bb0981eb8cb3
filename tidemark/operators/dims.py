"""Dimensions: M3 dim_assets, M4 dim_dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.constants import UPDATED_AT
from tidemark.functions.columns import calendar_columns


def asset_coverage(*staged: DataFrame) -> DataFrame:
    """Per source: first and last date and number of rows of each symbol, stacked.

    A symbol present in two sources yields two rows, as in the reference.
    """
    parts = [
        s.groupBy("symbol").agg(
            F.min("price_date").alias("first_seen"),
            F.max("price_date").alias("last_seen"),
            F.count(F.lit(1)).alias("trading_days"),
        )
        for s in staged
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dim_assets(registry: DataFrame, *staged: DataFrame, updated_at: Column | None = None) -> DataFrame:
    """M3: the registry decides the rows; coverage is joined on symbol.

    A registered symbol without data gets NULL dates and 0 days.
    """
    cov = asset_coverage(*staged)
    out = registry.join(cov, "symbol", "left").select(
        "symbol",
        "asset_type",
        "asset_name",
        "asset_class",
        "currency",
        "exchange",
        "region",
        "is_benchmark",
        "first_seen",
        "last_seen",
        F.coalesce(F.col("trading_days"), F.lit(0)).cast("long").alias("trading_days_available"),
    )
    if updated_at is not None:
        out = out.withColumn(UPDATED_AT, updated_at)
    return out


def _as_date(as_of: str | dt.date | Column | None) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("date")


def dim_dates(assets: DataFrame, as_of: str | dt.date | Column | None = None) -> DataFrame:
    """M4: one row per calendar day from the earliest first_seen to the latest
    last_seen, both inclusive, with calendar attributes.

    The spine is generated from the single (min, max) row; its size is bounded
    by the calendar (one row per day), not by the data volume.
    ``days_ago``/``is_today`` are relative to ``as_of`` (default: today).
    """
    bounds = assets.agg(F.min("first_seen").alias("lo"), F.max("last_seen").alias("hi"))
    spine = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("date_day"))
    day = F.col("date_day")
    ref = _as_date(as_of)
    cal = calendar_columns(day)
    return spine.select(
        day.alias("date_key"),
        day.alias("full_date"),
        *[c.alias(n) for n, c in cal.items()],
        F.datediff(ref, day).alias("days_ago"),
        (day == ref).alias("is_today"),
    )
