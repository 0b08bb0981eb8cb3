"""SRC9: ticks -> one OHLCV bar per symbol and UTC day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import col_

BAR_COLUMNS = ["symbol", "price_date", "open_price", "high_price", "low_price", "close_price", "volume"]


def daily_bars(
    ticks: DataFrame,
    symbol: str | Column,
    ts: str | Column,
    price: str | Column,
    seq: str | Column | None = None,
    volume: str | Column | None = None,
) -> DataFrame:
    """Aggregate ticks to daily bars.

    open/close are the prices of the first/last tick of the day by ``seq``
    (default ``ts``); high/low are max/min; volume is the sum of ``volume`` or,
    when absent, the tick count. Every aggregate is partial (map-side combine),
    so a hot symbol is reduced on each mapper before the shuffle on
    (symbol, day).
    """
    order = col_(seq if seq is not None else ts)
    p = col_(price)
    vol = F.sum(col_(volume)).cast("double") if volume is not None else F.count(F.lit(1)).cast("double")
    return ticks.groupBy(
        col_(symbol).alias("symbol"), F.to_date(col_(ts)).alias("price_date")
    ).agg(
        F.min_by(p, order).alias("open_price"),
        F.max(p).alias("high_price"),
        F.min(p).alias("low_price"),
        F.max_by(p, order).alias("close_price"),
        vol.alias("volume"),
    )
