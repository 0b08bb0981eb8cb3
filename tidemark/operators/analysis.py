"""Investment analyses over the fact and the summaries: M18-M22."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.constants import BENCHMARK, ROUND_RETURN
from tidemark.functions.ranking import global_rank


def _d(v: str | dt.date | Column) -> Column:
    return v if isinstance(v, Column) else F.lit(str(v)).cast("date")


def lump_sum(fact: DataFrame, start: str | dt.date, end: str | dt.date, amount: float = 1000.0) -> DataFrame:
    """Invest ``amount`` at the first close on/after ``start``, value it at
    the last close on/before ``end``: amount / buy x end - amount, per symbol.

    One aggregation per symbol with conditional max_by/min_by (partial,
    map-side combined); rows outside the dates are ignored by NULL ordering
    values, not filtered into separate scans.
    """
    s, e = _d(start), _d(end)
    d, c = F.col("price_date"), F.col("close_price")
    ok = c.isNotNull() & (c > 0)
    agg = fact.groupBy("symbol").agg(
        F.min_by(F.struct(d.alias("d"), c.alias("c")), F.when(ok & (d >= s) & (d <= e), d)).alias("buy"),
        F.max_by(F.struct(d.alias("d"), c.alias("c")), F.when(ok & (d <= e) & (d >= s), d)).alias("sell"),
    ).where(F.col("buy").isNotNull())
    units = F.lit(amount) / F.col("buy.c")
    value = units * F.col("sell.c")
    return agg.select(
        "symbol",
        F.col("buy.d").alias("buy_date"),
        F.col("buy.c").alias("buy_price"),
        F.col("sell.d").alias("value_date"),
        F.col("sell.c").alias("value_price"),
        F.lit(float(amount)).alias("invested"),
        F.round(value, 2).alias("value"),
        F.round(value - F.lit(amount), 2).alias("pnl"),
        F.round((value - F.lit(amount)) / F.lit(amount), 4).alias("return_pct"),
    )


def dollar_cost_average(
    fact: DataFrame,
    start: str | dt.date,
    end: str | dt.date,
    amount: float = 100.0,
    day_of_month: int = 13,
) -> DataFrame:
    """Buy ``amount`` at the close of every ``day_of_month`` in [start, end)
    that has a price (a missing day is a missed buy), then value all units at
    the last close on/before ``end``.
    """
    s, e = _d(start), _d(end)
    d, c = F.col("price_date"), F.col("close_price")
    buy = (F.dayofmonth(d) == day_of_month) & (d >= s) & (d < e) & c.isNotNull() & (c > 0)
    ok = c.isNotNull() & (c > 0)
    agg = fact.groupBy("symbol").agg(
        F.count_if(buy).alias("buys"),
        F.sum(F.when(buy, F.lit(amount) / c)).alias("units"),
        F.max_by(F.struct(d.alias("d"), c.alias("c")), F.when(ok & (d <= e), d)).alias("last"),
    ).where(F.col("buys") > 0)
    invested = F.col("buys") * F.lit(amount)
    value = F.col("units") * F.col("last.c")
    return agg.select(
        "symbol",
        F.col("buys").cast("long").alias("buys"),
        F.round("units", 8).alias("units"),
        invested.cast("double").alias("invested"),
        F.col("last.d").alias("value_date"),
        F.col("last.c").alias("value_price"),
        F.round(value, 2).alias("value"),
        F.round(value - invested, 2).alias("pnl"),
    )


PERIODS = (("1Y", 365), ("6M", 180), ("3M", 90), ("1M", 30), ("7D", 7))


def year_to_date(fact: DataFrame, benchmark: str = BENCHMARK) -> DataFrame:
    """YTD return per symbol (our definition: latest close over the first close
    of the latest date's calendar year, minus 1) and its excess over the
    benchmark's."""
    latest = fact.select(F.max("price_date")).scalar()
    start = F.make_date(F.year(latest), F.lit(1), F.lit(1))
    d, c = F.col("price_date"), F.col("close_price")
    ytd = (
        fact.where((d >= start) & c.isNotNull())
        .groupBy("symbol")
        .agg(F.min_by(c, d).alias("first_close"), F.max_by(c, d).alias("last_close"))
        .select("symbol", F.when(F.col("first_close") > 0, F.col("last_close") / F.col("first_close") - 1).alias("ytd"))
    )
    b = ytd.where(F.col("symbol") == benchmark).select(F.max("ytd")).scalar()
    return ytd.select(
        "symbol", F.round(F.col("ytd") - b, ROUND_RETURN).alias("ytd_excess")
    )


def best_by_period(summary: DataFrame, ytd: DataFrame | None = None, prefix: str = "btc") -> DataFrame:
    """Per period, the symbol with the largest excess return over the
    benchmark (ties: the larger symbol name). Periods are unpivoted with
    ``stack`` and reduced with a partial max_by, one row per period."""
    base = summary
    items = [(label, f"outperformance_vs_{prefix}_{n}d") for label, n in PERIODS]
    if ytd is not None:
        base = base.join(ytd, "symbol", "left")
        items.append(("YTD", "ytd_excess"))
    stack = "stack({}, {}) as (period, excess)".format(
        len(items), ", ".join(f"'{label}', `{col}`" for label, col in items)
    )
    long = base.selectExpr("symbol", stack).where(F.col("excess").isNotNull())
    return long.groupBy("period").agg(
        F.max_by(F.struct("symbol", "excess"), F.struct("excess", "symbol")).alias("best")
    ).select("period", F.col("best.symbol").alias("best_symbol"), F.col("best.excess").alias("excess_return"))


def rank_by_excess(summary: DataFrame, n: int = 365, prefix: str = "btc") -> DataFrame:
    """The latest summary listed by excess return, with its rank."""
    out = summary.select(
        "symbol",
        F.col(f"asset_return_{n}d").alias(f"return_{n}d"),
        f"{prefix}_return_{n}d",
        f"outperformance_vs_{prefix}_{n}d",
    )
    ranked = global_rank(out, f"outperformance_vs_{prefix}_{n}d", "excess_rank", ascending=False)
    return ranked.orderBy("excess_rank", "symbol")


def with_position(ranked: DataFrame, rank: str, *ties: str, name: str = "position") -> DataFrame:
    """The place of each row in a listing by ``rank`` and then ``ties``, as a column: a rank is shared by tied rows
    only, so their order inside it gives the place without a window over all rows."""
    return ranked.withColumn(name, (F.col(rank) + F.row_number().over(Window.partitionBy(rank).orderBy(*ties)) - 1).cast("long"))


def relative_volatility(summary: DataFrame, n: int = 365, prefix: str = "btc") -> DataFrame:
    """Each symbol's volatility as a share of the benchmark's, also in percent."""
    ratio = F.col(f"relative_volatility_{n}d_vs_{prefix}")
    return summary.select("symbol", ratio, (ratio * 100).alias("pct_of_benchmark"))
