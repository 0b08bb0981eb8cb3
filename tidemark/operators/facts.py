"""Fact table: M5 fact_daily_prices, M6-M8 returns and gaps, M9 key, M23 append."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.sizing import bounded_broadcast
from tidemark.constants import GAP_DAYS, UPDATED_AT
from tidemark.functions.slices import OWN, SLICE, sliced
from tidemark.functions.columns import (
    days_between,
    gap_flag,
    intraday_range,
    simple_return,
    surrogate_key,
)


def _null_double():
    return F.lit(None).cast("double")


COMBINED_COLUMNS = [
    "symbol",
    "price_date",
    "close_price",
    "open_price",
    "high_price",
    "low_price",
    "volume",
    "market_cap",
    "__de_processed_at",
    "__run_id",
]


def _audit(df: DataFrame) -> list[Column]:
    out = []
    for name, typ in (("__de_processed_at", "timestamp"), ("__run_id", "string")):
        out.append((F.col(name) if name in df.columns else F.lit(None)).cast(typ).alias(name))
    return out


def bars_source(stg_bars: DataFrame) -> DataFrame:
    """Staging bars in the combined layout (no market cap)."""
    return stg_bars.select(
        "symbol",
        "price_date",
        "close_price",
        "open_price",
        "high_price",
        "low_price",
        "volume",
        _null_double().alias("market_cap"),
        *_audit(stg_bars),
    ).withColumn("source", F.lit("bars"))


def chart_source(stg_chart: DataFrame) -> DataFrame:
    """Staging chart rows in the combined layout (close, volume, market cap only)."""
    return stg_chart.select(
        "symbol",
        "price_date",
        "close_price",
        _null_double().alias("open_price"),
        _null_double().alias("high_price"),
        _null_double().alias("low_price"),
        "volume",
        "market_cap",
        *_audit(stg_chart),
    ).withColumn("source", F.lit("chart"))


def with_returns(
    df: DataFrame, gap_days: int = GAP_DAYS, series: str | None = "source", slice_rows: int | None = None
) -> DataFrame:
    """M6-M8: previous close and date inside each series, then daily return,
    intraday range, days since the previous observation and the gap flag.

    A series is (symbol, ``series``). The window is partitioned by symbol only
    and ordered by (series, price_date); a previous row from another series is
    ignored. That is exactly the per-series lag, but it needs only a
    hash-partitioning on symbol, which every later per-symbol window (rolling
    metrics) reuses: one shuffle for the whole fact + marts chain.
    With unique (symbol, price_date) per series, a window partition holds at
    most one row per calendar day and series. ``slice_rows`` cuts longer series
    into stretches of about that many rows, each with the row before it
    (``functions.slices``); the result is the same.
    """
    if slice_rows is not None:
        keys = ["symbol"] if series is None or series not in df.columns else ["symbol", series]
        cut = sliced(df, keys, "price_date", slice_rows, 1)
        w = Window.partitionBy(*keys, SLICE).orderBy("price_date")
        prev_close, prev_date = F.lag("close_price").over(w), F.lag("price_date").over(w)
        df = cut.select(*df.columns, OWN, SLICE)
    elif series is not None and series in df.columns:
        w = Window.partitionBy("symbol").orderBy(series, "price_date")
        same = F.lag(series).over(w).eqNullSafe(F.col(series))
        prev_close = F.when(same, F.lag("close_price").over(w))
        prev_date = F.when(same, F.lag("price_date").over(w))
    else:
        w = Window.partitionBy("symbol").orderBy("price_date")
        prev_close = F.lag("close_price").over(w)
        prev_date = F.lag("price_date").over(w)
    out = df.withColumns({"prev_close_price": prev_close, "prev_price_date": prev_date})
    if slice_rows is not None:
        out = out.where(OWN).drop(OWN, SLICE)
    days = days_between("price_date", "prev_price_date")
    return out.withColumns(
        {
            "daily_return": simple_return("close_price", "prev_close_price"),
            "intraday_range_pct": intraday_range("high_price", "low_price", "close_price"),
            "days_since_prev": days,
            "has_data_gap": gap_flag(days, gap_days),
        }
    ).drop("prev_price_date")


def combine_sources(*sources: DataFrame) -> DataFrame:
    """Stack the per-source rows (positional columns, by name)."""
    out = sources[0]
    for s in sources[1:]:
        out = out.unionByName(s)
    return out


def calendar_span(dates: DataFrame) -> Column:
    """First and last day of a calendar that has every day between them, as one scalar subquery."""
    return dates.select(F.struct(F.min("date_key").alias("lo"), F.max("date_key").alias("hi"))).scalar()


def fact_daily_prices(
    sources: DataFrame,
    assets: DataFrame,
    dates: DataFrame | None,
    gap_days: int = GAP_DAYS,
    updated_at: Column | None = None,
    span: Column | None = None,
    slice_rows: int | None = None,
    keep_source: bool = False,
) -> DataFrame:
    """M5/M9: returns per (symbol, source) series, then the two dimension joins.

    ``sources`` is the output of ``combine_sources``. Both dimensions are left
    joins on their keys: the asset dimension on symbol (hint it for broadcast
    upstream when its size is checked), the date dimension on the date, so that
    a date the calendar lacks gets no key. The calendar is broadcast if its
    counted size allows, and joined by a shuffle otherwise. ``keep_source`` adds
    the row's source, for tables that are updated row by row.
    """
    return with_dimensions(with_returns(sources, gap_days, slice_rows=slice_rows), assets, dates, updated_at, span, keep_source)


def with_dimensions(
    returns: DataFrame,
    assets: DataFrame,
    dates: DataFrame | None,
    updated_at: Column | None = None,
    span: Column | None = None,
    keep_source: bool = False,
) -> DataFrame:
    """Fact rows from rows with returns: the two dimension joins of ``fact_daily_prices``."""
    asset_cols = assets.select(F.col("symbol").alias("__asset_symbol"), F.col("asset_type"))
    joined = returns.join(asset_cols, returns["symbol"] == asset_cols["__asset_symbol"], "left")
    if span is None:
        calendar = bounded_broadcast(dates.select(F.col("date_key").alias("__date_key")))
        joined = joined.join(calendar, F.col("price_date") == F.col("__date_key"), "left")
    else:
        inside = F.col("price_date").between(span.getField("lo"), span.getField("hi"))
        joined = joined.withColumn("__date_key", F.when(inside, F.col("price_date")))
    out = joined.select(
        surrogate_key("symbol", "price_date").alias("price_key"),
        F.col("__asset_symbol").alias("asset_key"),
        F.col("__date_key").alias("date_key"),
        "symbol",
        "asset_type",
        "price_date",
        "close_price",
        "open_price",
        "high_price",
        "low_price",
        "volume",
        "market_cap",
        "daily_return",
        "prev_close_price",
        "intraday_range_pct",
        "days_since_prev",
        "has_data_gap",
        "__run_id",
        "__de_processed_at",
        *(["source"] if keep_source else []),
    )
    if updated_at is not None:
        out = out.withColumn(UPDATED_AT, updated_at)
    return out


def returns_to_rewrite(existing: DataFrame, incoming: DataFrame, gap_days: int = GAP_DAYS) -> DataFrame:
    """Incremental returns for new or corrected rows of an existing series.

    ``existing`` holds rows already computed (at least symbol, source,
    price_date and the combined columns); ``incoming`` holds new staging rows in
    the combined layout. Per (symbol, source) the rewrite starts at the
    earliest incoming date: the last existing row before it anchors ``lag``,
    existing rows from that date on are recomputed (a late correction changes
    the return of the next row), and incoming rows replace existing rows with
    the same key. Returns the rows to upsert, each with its returns.
    """
    keys = ["symbol", "source"]
    start = incoming.groupBy(*keys).agg(F.min("price_date").alias("__from"))
    ex = existing.select(*COMBINED_COLUMNS, "source").join(start, keys, "inner")
    anchor = (
        ex.where(F.col("price_date") < F.col("__from"))
        .groupBy(*keys)
        .agg(F.max_by(F.struct(*[c for c in COMBINED_COLUMNS if c != "symbol"]), F.col("price_date")).alias("a"))
        .select(*keys, "a.*")
        .withColumn("__anchor", F.lit(True))
    )
    tail = ex.where(F.col("price_date") >= F.col("__from")).drop("__from")
    replaced = tail.join(incoming.select(*keys, "price_date"), [*keys, "price_date"], "left_anti")
    body = replaced.unionByName(incoming.select(*COMBINED_COLUMNS, "source")).withColumn("__anchor", F.lit(False))
    series = anchor.unionByName(body)
    return with_returns(series, gap_days).where(~F.col("__anchor")).drop("__anchor")


def dirty_returns(rows: DataFrame, dirty: DataFrame, gap_days: int = GAP_DAYS) -> DataFrame:
    """The rows, with their returns, that a change of the ``dirty`` keys touches.

    ``rows`` is the combined staging after the change, ``dirty`` has the changed
    (symbol, source, price_date). A changed row touches its own return and that of the next row of its
    series, and nothing else. Only touched series are read from their first
    changed date on, with the last row before it.
    """
    keys = ["symbol", "source"]
    flags = dirty.select(*[F.col(k).alias(f"__d_{k}") for k in (*keys, "price_date")]).distinct()
    start = flags.groupBy("__d_symbol", "__d_source").agg(F.min("__d_price_date").alias("__from"))
    series = [F.col(k).eqNullSafe(F.col(f"__d_{k}")) for k in keys]
    near = rows.join(start, series[0] & series[1]).drop("__d_symbol", "__d_source")
    payload = [c for c in rows.columns if c not in keys]
    last = near.where(F.col("price_date") < F.col("__from")).groupBy(*keys).agg(F.max_by(F.struct(*payload), F.col("price_date")).alias("a"))
    anchor = last.select(*keys, "a.*").select(*rows.columns, F.lit(False).alias("__dirty"))
    tail = near.where(F.col("price_date") >= F.col("__from"))
    marked = tail.join(flags, series[0] & series[1] & F.col("price_date").eqNullSafe(F.col("__d_price_date")), "left")
    body = marked.select(*rows.columns, F.col("__d_price_date").isNotNull().alias("__dirty"))
    w = Window.partitionBy("symbol").orderBy("source", "price_date")
    after = F.lag("source").over(w).eqNullSafe(F.col("source")) & F.lag("__dirty").over(w)
    both = anchor.unionByName(body).withColumn("__touched", F.col("__dirty") | F.coalesce(after, F.lit(False)))
    return with_returns(both, gap_days).where("__touched").drop("__dirty", "__touched")
