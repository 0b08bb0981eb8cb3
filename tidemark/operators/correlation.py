"""Pairwise return correlation and per-symbol volatility: M15, M16, M17."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.constants import LOOKBACK_DAYS, ROUND_RATIO, ROUND_RETURN, TRADING_DAYS, UPDATED_AT
from tidemark.operators.rolling import lookback
from tidemark.plans.sizing import bounded_broadcast
from tidemark.session import scratch_root


def recent_returns(fact: DataFrame, lookback_days: int = LOOKBACK_DAYS, anchor: dt.date | None = None) -> DataFrame:
    """PF6 + PF8: non-null daily returns within the look-back of the fact's latest date (``anchor`` where it is known)."""
    month = ["part"] if "part" in fact.columns else []
    r = fact.where(F.col("daily_return").isNotNull()).select("symbol", "price_date", "daily_return", *month)
    return lookback(r, fact if anchor is None else anchor, lookback_days).drop(*month)


def pearson(x: str, y: str):
    """Pearson correlation that is NULL (not an ANSI error) for zero variance."""
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


# A join group (date, bucket of a, bucket of b) holds at most ~PAIRS_PER_TASK candidate pairs.
PAIRS_PER_TASK = 4_000_000


def pairwise_correlation(
    returns: DataFrame, pairs_per_task: int = PAIRS_PER_TASK, materialize: bool = True
) -> DataFrame:
    """For every pair of symbols (a < b), correlation of the returns on
    common dates and the number of common dates.

    An equi-join on the date with the residual a.symbol < b.symbol (each
    unordered pair once); the joined rows stream straight into a partial
    aggregation, so only per-(task, pair) partial moments are shuffled.

    A date carrying very many symbols would put all of its pairs into one
    task, so hot dates are split explicitly (no reliance on run-time skew
    handling). Rows per date are counted first; that table has one row per
    date and is broadcast after its size check. A date with n rows gets
    k = ceil(n / sqrt(pairs_per_task)) hash buckets of symbols. Each row of
    that date is sent to the k groups (its bucket, j) on the left side and
    (i, its bucket) on the right, so the pair (a, b) meets exactly once, in
    group (bucket(a), bucket(b)), and no group exceeds about pairs_per_task
    candidates. Ordinary dates have k = 1 and are not replicated.

    The returns are read three times (date counts, both join sides); with
    ``materialize`` they are checkpointed once in the shared checkpoint folder.
    """
    if materialize:
        scratch_root(returns.sparkSession)
        returns = returns.checkpoint(eager=True)
    side = max(1, int(pairs_per_task ** 0.5))
    per_date = returns.groupBy("price_date").agg(F.count(F.lit(1)).alias("__n"))
    buckets = per_date.select("price_date", F.greatest(F.lit(1), F.ceil(F.col("__n") / side)).cast("int").alias("__k"))
    tagged = returns.join(bounded_broadcast(buckets), "price_date").select(
        "symbol",
        "price_date",
        "daily_return",
        "__k",
        F.pmod(F.xxhash64("symbol"), F.col("__k")).cast("int").alias("__b"),
    )
    fan = F.explode(F.sequence(F.lit(0), F.col("__k") - 1))
    a = tagged.select(
        F.col("symbol").alias("symbol_a"),
        F.col("price_date"),
        F.col("daily_return").alias("return_a"),
        F.col("__b").alias("__i"),
        fan.alias("__j"),
    )
    b = tagged.select(
        F.col("symbol").alias("symbol_b"),
        F.col("price_date").alias("date_b"),
        F.col("daily_return").alias("return_b"),
        fan.alias("__i_b"),
        F.col("__b").alias("__j_b"),
    )
    cond = (
        (a["price_date"] == b["date_b"])
        & (a["__i"] == b["__i_b"])
        & (a["__j"] == b["__j_b"])
        & (a["symbol_a"] < b["symbol_b"])
    )
    pairs = a.join(b, cond)
    return pairs.groupBy("symbol_a", "symbol_b").agg(
        F.round(pearson("return_a", "return_b"), ROUND_RATIO).alias("correlation"),
        F.count(F.lit(1)).alias("obs_count"),
    )


def volatility_stats(returns: DataFrame, trading_days: int = TRADING_DAYS) -> DataFrame:
    """Per symbol over all its returns in the window: annualised
    volatility, mean, annualised mean, best and worst day, count."""
    ann = F.sqrt(F.lit(float(trading_days)))
    return returns.groupBy("symbol").agg(
        F.round(F.stddev_samp("daily_return") * ann, ROUND_RETURN).alias("annual_volatility"),
        F.round(F.avg("daily_return"), ROUND_RETURN).alias("avg_daily_return"),
        F.round(F.max("daily_return"), ROUND_RETURN).alias("max_daily_gain"),
        F.round(F.min("daily_return"), ROUND_RETURN).alias("max_daily_loss"),
        F.round(F.avg("daily_return") * F.lit(trading_days), ROUND_RETURN).alias("annualized_return"),
        F.count(F.lit(1)).alias("trading_days"),
    )


def volatility_correlation_summary(
    fact: DataFrame,
    lookback_days: int = LOOKBACK_DAYS,
    trading_days: int = TRADING_DAYS,
    symbols: Sequence[str] | None = None,
    ordered: bool = True,
    updated_at: Column | None = None,
    anchor: dt.date | None = None,
) -> DataFrame:
    """Each pair with both symbols' statistics, by |correlation| descending.

    The look-back returns (three narrow columns) feed both the pair join and
    the statistics, so they are materialised once with a reliable checkpoint
    in the shared checkpoint folder: the upstream (bars, joins, lag window)
    runs once and the lineage is cut. The statistics table has one row per
    symbol; it is broadcast to both joins once that count is checked (pairs
    outnumber symbols), otherwise both joins shuffle.

    All pairs of S symbols are S(S-1)/2 rows: ``symbols`` keeps to the pairs
    among those named, and ``ordered=False`` leaves out the sort of the whole
    result. ``updated_at`` adds the audit column of rebuilt tables.
    """
    scratch_root(fact.sparkSession)
    returns = recent_returns(fact, lookback_days, anchor)
    if symbols is not None:
        returns = returns.where(F.col("symbol").isin(*symbols))
    returns = returns.checkpoint(eager=True)
    corr = pairwise_correlation(returns, materialize=False)
    stats = volatility_stats(returns, trading_days)
    side = bounded_broadcast(stats)
    va = side.select(
        F.col("symbol").alias("__sa"),
        F.col("annual_volatility").alias("volatility_a"),
        F.col("annualized_return").alias("ann_return_a"),
        F.col("avg_daily_return").alias("avg_daily_return_a"),
        F.col("max_daily_gain").alias("max_gain_a"),
        F.col("max_daily_loss").alias("max_loss_a"),
    )
    vb = side.select(
        F.col("symbol").alias("__sb"),
        F.col("annual_volatility").alias("volatility_b"),
        F.col("annualized_return").alias("ann_return_b"),
        F.col("avg_daily_return").alias("avg_daily_return_b"),
        F.col("max_daily_gain").alias("max_gain_b"),
        F.col("max_daily_loss").alias("max_loss_b"),
    )
    out = corr.join(va, corr["symbol_a"] == va["__sa"]).join(vb, corr["symbol_b"] == vb["__sb"])
    out = out.select(
        "symbol_a",
        "symbol_b",
        "correlation",
        "obs_count",
        "volatility_a",
        "volatility_b",
        "ann_return_a",
        "ann_return_b",
        "avg_daily_return_a",
        "avg_daily_return_b",
        "max_gain_a",
        "max_gain_b",
        "max_loss_a",
        "max_loss_b",
    )
    if updated_at is not None:
        out = out.withColumn(UPDATED_AT, updated_at)
    return out.orderBy(F.abs("correlation").desc_nulls_last()) if ordered else out
