"""M10 rolling_performance and PF8 look-back filter."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.constants import LOOKBACK_DAYS, ROUND_RETURN, TRADING_DAYS, UPDATED_AT, WINDOWS
from tidemark.functions.slices import OWN, SLICE, sliced
from tidemark.session import ship


def lookback(df: DataFrame, anchor: DataFrame | dt.date, days: int = LOOKBACK_DAYS) -> DataFrame:
    """PF8: keep rows on or after (latest date of ``anchor``) - ``days``.

    The latest date is an uncorrelated scalar subquery: Spark runs it once and
    uses the value as a literal in the filter. It may also be given as a date (from
    ``sources.statistics``). A table by month (column ``part``) is filtered on the month too, so months
    before the look-back are not read.
    """
    latest = anchor.select(F.max("price_date")).scalar() if isinstance(anchor, DataFrame) else F.lit(anchor).cast("date")
    first = F.date_sub(latest, days)
    if "part" in df.columns:
        df = df.where(F.col("part") >= F.date_format(first, "yyyy-MM"))
    return df.where(F.col("price_date") >= first)


def _frame_aggregates(base: DataFrame, windows: Sequence[int], w: WindowSpec, unit: str = "rows") -> DataFrame:
    """first close, sample stddev and count of returns over each frame:
    the last N observations (``unit="rows"``) or the last N calendar days
    (``unit="calendar"``, a RANGE frame over the day number).

    Spark re-aggregates a sliding frame for every row: O(rows x window)."""
    if unit == "calendar":
        base = base.withColumn("__day", F.unix_date("price_date"))
        w = Window.partitionBy("symbol").orderBy("__day")
    aggs = []
    for n in windows:
        frame = w.rangeBetween(-(n - 1), Window.currentRow) if unit == "calendar" else w.rowsBetween(-(n - 1), Window.currentRow)
        opening = F.first("close_price").over(frame) if unit == "calendar" else _opening(w, n)
        aggs += [
            opening.alias(f"__first_{n}"),
            F.stddev_samp("daily_return").over(frame).alias(f"__sd_{n}"),
            F.count("daily_return").over(frame).alias(f"obs_{n}d"),
        ]
    return base.select("*", *aggs)


def _opening(w: WindowSpec, n: int) -> Column:
    """Rows have a close, so the first of the last ``n`` is the one n - 1 back, or the series' own first."""
    whole = F.first("close_price").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return F.coalesce(F.lag("close_price", n - 1).over(w), whole)


# Rows gathered before they are worked on, besides those that the windows reach back to.
GATHER = 16_384


def sliding_moments(x: np.ndarray, place: np.ndarray, windows: Sequence[int]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Count, mean and squared deviations of the last N values at each row, for each N; NaN values are left out.

    ``place`` is a row's number in its series, from 0; windows end where the series begins. Blocks of 2^k
    rows are made of two blocks of the level before, and a window is a sum of the blocks given by N's binary
    digits, so a row costs O(log N). Merging adds squares only and never takes away what was summed before, so
    no digits cancel behind an extreme value; and as the order of merging is the same in every window,
    windows of equal values have bit-equal results wherever they lie.
    """
    has = ~np.isnan(x)
    block = (has.astype(np.float64), np.where(has, x, 0.0), np.zeros(len(x)))

    def back(moments: tuple, rows: int) -> tuple:
        """The moments that end ``rows`` rows earlier in the same series, else those of nothing."""
        out = []
        for m in moments:
            moved = np.zeros(len(m))
            moved[rows:] = m[: len(m) - rows] if rows < len(m) else m[:0]
            moved[place < rows] = 0.0
            out.append(moved)
        return tuple(out)

    def merged(a: tuple, b: tuple) -> tuple:
        n = a[0] + b[0]
        share = np.divide(b[0], n, out=np.zeros(len(n)), where=n > 0)
        apart = np.where((a[0] > 0) & (b[0] > 0), b[1] - a[1], 0.0)
        mean = np.where(a[0] > 0, a[1] + apart * share, b[1])
        return n, mean, a[2] + b[2] + apart * apart * a[0] * share

    out: dict[int, tuple] = {}
    at = dict.fromkeys(windows, 0)
    for k in range(max(windows).bit_length()):
        for n in windows:
            if n >> k & 1:
                own = back(block, at[n])
                out[n] = merged(own, out[n]) if n in out else own
                at[n] += 1 << k
        if max(windows) >> (k + 1):
            block = merged(back(block, 1 << k), block)
    return out


def _block_aggregates(base: DataFrame, windows: Sequence[int], w: WindowSpec) -> DataFrame:
    """The same three aggregates from merged blocks (``sliding_moments``): O(log N) a row, no visits of frames.

    A row's number in its series, from a window, puts the rows in order without a shuffle beyond that
    window's; they are then streamed through arrays. Only the rows that the longest window reaches back to are held
    from batch to batch, however long a series is.
    """
    ship(base.sparkSession)
    columns, reach = base.columns, max(windows)
    close, returns = columns.index("close_price"), columns.index("daily_return")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        halo = (np.zeros(0), np.zeros(0), np.zeros(0, np.int64))
        held: list[pa.RecordBatch] = []

        def worked() -> pa.RecordBatch:
            nonlocal halo
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            new = (
                rows.column(returns).to_numpy(zero_copy_only=False).astype(np.float64),  # null becomes NaN
                rows.column(close).to_numpy(zero_copy_only=False).astype(np.float64),
                rows.column(len(columns)).to_numpy().astype(np.int64) - 1,
            )
            x, price, place = (np.concatenate(pair) for pair in zip(halo, new))
            fresh = slice(len(halo[0]), None)
            halo = (x[-reach:], price[-reach:], place[-reach:])
            cells = list(rows.columns[:-1])
            found = sliding_moments(x, place, windows)
            at = np.arange(len(x))
            for n in windows:
                count, _, squares = (m[fresh] for m in found[n])
                deviation = np.sqrt(np.divide(squares, count - 1, out=np.full(len(count), np.nan), where=count > 1))
                first = price[(at - np.minimum(place, n - 1))[fresh]]
                cells += [pa.array(first), pa.array(deviation, mask=count < 2), pa.array(count.astype(np.int64))]
            return pa.RecordBatch.from_arrays(cells, names)

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                if sum(b.num_rows for b in held) >= GATHER:
                    yield worked()
                    held = []
        if held:
            yield worked()

    made = [(c, t) for n in windows for c, t in ((f"__first_{n}", T.DoubleType()), (f"__sd_{n}", T.DoubleType()), (f"obs_{n}d", T.LongType()))]
    names = columns + [c for c, _ in made]
    schema = T.StructType([*base.schema.fields, *[T.StructField(c, t) for c, t in made]])
    return base.withColumn("__place", F.row_number().over(w)).mapInArrow(run, schema)


def _chart_point(fact: DataFrame) -> Column:
    return F.col("market_cap").isNotNull() if "market_cap" in fact.columns else F.lit(False)


def _prefix_aggregates(base: DataFrame, windows: Sequence[int], w: WindowSpec) -> DataFrame:
    """The same three aggregates in O(1) per row from running totals.

    first close = the close N-1 rows back (or the series' first close);
    count = running count minus the running count N rows back, both exact.
    The variance comes from running sums of (r - c) and (r - c)^2, with c the
    series' first return (shifting keeps the sums small), differenced N rows
    apart: equal to the frame result up to floating-point rounding.
    """
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    shift = F.first("daily_return", ignorenulls=True).over(whole)
    centred = F.col("daily_return") - F.col("__shift")
    step1 = base.withColumn("__shift", shift).select(
        "*",
        F.count("daily_return").over(running).alias("__cnt"),
        F.coalesce(F.sum(centred).over(running), F.lit(0.0)).alias("__s1"),
        F.coalesce(F.sum(centred * centred).over(running), F.lit(0.0)).alias("__s2"),
    )
    cols = []
    for n in windows:
        k = F.col("__cnt") - F.coalesce(F.lag("__cnt", n).over(w), F.lit(0))
        s1 = F.col("__s1") - F.coalesce(F.lag("__s1", n).over(w), F.lit(0.0))
        s2 = F.col("__s2") - F.coalesce(F.lag("__s2", n).over(w), F.lit(0.0))
        var = F.greatest(F.try_divide(s2 - F.try_divide(s1 * s1, k), k - 1), F.lit(0.0))
        cols += [
            _opening(w, n).alias(f"__first_{n}"),
            F.when(k >= 2, F.sqrt(var)).alias(f"__sd_{n}"),
            k.alias(f"obs_{n}d"),
        ]
    return step1.select("*", *cols)


def rolling_performance(
    fact: DataFrame,
    windows: Sequence[int] = WINDOWS,
    lookback_days: int | None = LOOKBACK_DAYS,
    trading_days: int = TRADING_DAYS,
    method: str = "blocks",
    unit: str = "rows",
    updated_at: Column | None = None,
    slice_rows: int | None = None,
    touched: str | None = None,
    anchor: DataFrame | dt.date | None = None,
) -> DataFrame:
    """Per symbol and date: simple return, annualised volatility and the count
    of returns over the last N observations (ROWS frames), for each N.

    All window expressions share one partition/order spec, so one shuffle and
    one sort serve them. Partial windows at the start of a series are allowed.
    Rows of one date (a symbol in both sources) are ordered by source: bars,
    which have no market cap, before chart points. The look-back filter is
    applied after the windows (history before it still feeds them) and is
    anchored on the latest date of the whole fact.

    ``method="blocks"`` (default) merges blocks of returns, a fixed number for
    each row, in arrays; see ``sliding_moments``. ``method="frames"`` evaluates the ROWS
    frames, O(window) a row. ``method="prefix"`` differences running totals,
    which loses digits behind extreme returns; counts and first closes are
    identical in all three.

    ``unit="rows"`` (default, the reference's code) counts observations;
    ``unit="calendar"`` uses the last N calendar days instead (what the
    reference's documentation describes); it differs where series have gaps and
    is evaluated with frames.

    ``slice_rows`` cuts each series into stretches of about that many rows
    (``functions.slices``), each with the rows before it that its windows
    reach back to, so that one long series is the work of many tasks. The result
    is the same.

    ``touched`` names a boolean column of changed rows: only dates that have a
    changed row within the longest window are returned. ``anchor`` is what
    the look-back is anchored on if ``fact`` is a part of it, or its latest date.

    ``updated_at`` adds the audit column of rebuilt tables.
    """
    if unit not in ("rows", "calendar"):
        raise ValueError(f"unit must be 'rows' or 'calendar', not {unit!r}")
    if unit == "calendar" and slice_rows is not None:
        raise ValueError("slices are counted in rows, not in days")
    base = fact.where(F.col("close_price").isNotNull()).select(
        "symbol", "asset_type", "price_date", F.col("close_price").cast("double").alias("close_price"), "daily_return", _chart_point(fact).alias("__chart"),
        *([F.col(touched).alias("__touched")] if touched else []),
    )
    keys, order = ["symbol"], ["price_date", "__chart"]
    if slice_rows is not None:
        base = sliced(base, keys, "price_date", slice_rows, max(windows) - 1)
        keys = [*keys, SLICE]
    w = Window.partitionBy(*keys).orderBy(*order)
    if touched:
        place = F.row_number().over(w)
        last = F.last(F.when(F.col("__touched"), F.col("__row")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        base = base.withColumn("__row", place).withColumn("__reached", F.coalesce(F.col("__row") - last < max(windows), F.lit(False)))
        # Rows of one date are replaced together.
        base = base.withColumn("__reached", F.max("__reached").over(Window.partitionBy(*keys, "price_date")))
    ann = F.sqrt(F.lit(float(trading_days)))
    # Every window aggregate is computed once (one sort, Window operators over
    # the same partitioning); returns and volatilities are projections over them.
    if unit == "calendar" or method == "frames":
        framed = _frame_aggregates(base, windows, w, unit)
    else:
        framed = {"blocks": _block_aggregates, "prefix": _prefix_aggregates}[method](base, windows, w)
    if slice_rows is not None:
        framed = framed.where(OWN)
    if touched:
        framed = framed.where("__reached")
    close = F.col("close_price")
    out = framed.select(
        "symbol",
        "asset_type",
        "price_date",
        "close_price",
        "daily_return",
        *[
            F.round(F.when(F.col(f"__first_{n}") > 0, (close - F.col(f"__first_{n}")) / F.col(f"__first_{n}")),
                    ROUND_RETURN).alias(f"return_{n}d")
            for n in windows
        ],
        *[F.round(F.col(f"__sd_{n}") * ann, ROUND_RETURN).alias(f"volatility_{n}d") for n in windows],
        *[F.col(f"obs_{n}d") for n in windows],
    )
    if lookback_days is not None:
        out = lookback(out, fact if anchor is None else anchor, lookback_days)
    return out if updated_at is None else out.withColumn(UPDATED_AT, updated_at)
