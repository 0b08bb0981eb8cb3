"""Staging: raw landed documents -> one clean row per (symbol, price_date).

M1 stage_bars, M2 stage_market_chart, WIN1/PF9/S3 latest_per_key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import (
    all_zero,
    col_,
    double_millis_to_date,
    millis_to_date,
    pair_value,
    zip_shortest,
)
from tidemark.schemas import CHART_PAYLOAD


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order_desc: Sequence[str | Column]
) -> DataFrame:
    """Keep one row per key: the greatest by ``order_desc``, then by every other column.

    Same result as ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order_desc DESC
    NULLS LAST, <other columns> DESC NULLS LAST) = 1, but written as a max over
    a struct, which Spark aggregates partially on each mapper. A key holding a
    third of all rows is therefore reduced to one candidate per map task before
    the shuffle, instead of being sorted whole in one task. The full column
    list in the struct makes the choice deterministic under ties.
    """
    keys = list(keys)
    payload = [c for c in df.columns if c not in keys]
    ordering = [col_(o).alias(f"__o{i}") for i, o in enumerate(order_desc)]
    best = F.max(F.struct(*ordering, *[F.col(c) for c in payload])).alias("__best")
    picked = df.groupBy(*keys).agg(best)
    return picked.select(*[F.col(c) for c in keys], *[F.col("__best").getField(c).alias(c) for c in payload]).select(
        *df.columns
    )


BAR_VALUE_COLUMNS = ["open_price", "high_price", "low_price", "close_price", "volume"]


# Which of several rows of a symbol and day stays: the latest ingestion, then the later point, then larger values.
BAR_ORDER = ["__de_processed_at", "price_ms", *BAR_VALUE_COLUMNS]
CHART_ORDER = ["__de_processed_at", "price_ms", "close_price", "volume", "market_cap"]


def bar_rows(raw: DataFrame) -> DataFrame:
    """One row per element of ``results`` (a document with a null or empty array
    contributes nothing), epoch ms -> UTC date, without bars whose five values are all NULL or 0."""
    flat = raw.select(
        "symbol", "__de_processed_at", "__run_id", F.inline("results")
    ).select(
        "symbol",
        F.col("timestamp").alias("price_ms"),
        millis_to_date("timestamp").alias("price_date"),
        F.col("open").alias("open_price"),
        F.col("high").alias("high_price"),
        F.col("low").alias("low_price"),
        F.col("close").alias("close_price"),
        F.col("volume").alias("volume"),
        "__de_processed_at",
        "__run_id",
    )
    return flat.where(~all_zero(*BAR_VALUE_COLUMNS))


def stage_bars(raw: DataFrame) -> DataFrame:
    """M1: nested bar documents -> staging bars: ``bar_rows``, and per
    (symbol, price_date) the latest ingestion wins (``BAR_ORDER``)."""
    latest = latest_per_key(bar_rows(raw), ["symbol", "price_date"], BAR_ORDER)
    return latest.select(
        "symbol", "price_date", *BAR_VALUE_COLUMNS, "__de_processed_at", "__run_id"
    )


def chart_rows(raw: DataFrame) -> DataFrame:
    """The points of chart documents with a JSON payload.

    The three series are zipped by position and cut to the shortest one;
    malformed JSON yields no rows; a point needs a positive close.
    """
    parsed = raw.select(
        "coin_id",
        "vs_currency",
        "__de_processed_at",
        "__run_id",
        F.from_json("raw_json", CHART_PAYLOAD).alias("payload"),
    )
    zipped = zip_shortest(
        p=F.col("payload.prices"), v=F.col("payload.total_volumes"), mc=F.col("payload.market_caps")
    )
    points = parsed.select(
        "coin_id", "vs_currency", "__de_processed_at", "__run_id", F.explode(zipped).alias("pt")
    ).select(
        F.col("coin_id").alias("symbol"),
        "vs_currency",
        pair_value("pt.p", 0).alias("price_ms"),
        double_millis_to_date(pair_value("pt.p", 0)).alias("price_date"),
        pair_value("pt.p", 1).alias("close_price"),
        pair_value("pt.v", 1).alias("volume"),
        pair_value("pt.mc", 1).alias("market_cap"),
        "__de_processed_at",
        "__run_id",
    )
    return points.where(F.col("close_price").isNotNull() & (F.col("close_price") > 0))


def stage_market_chart(raw: DataFrame) -> DataFrame:
    """M2: chart documents -> staging chart rows: ``chart_rows``, and per
    (coin, price_date) the latest ingestion wins (``CHART_ORDER``)."""
    latest = latest_per_key(chart_rows(raw), ["symbol", "price_date"], CHART_ORDER)
    return latest.select(
        "symbol",
        "vs_currency",
        "price_date",
        "close_price",
        "volume",
        "market_cap",
        "__de_processed_at",
        "__run_id",
    )
