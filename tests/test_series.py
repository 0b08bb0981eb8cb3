"""Rolling metrics from merged blocks, long series in slices, and the refetch plan."""

import datetime as dt
import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions.slices import OWN, SLICE, sliced
from tidemark.operators.facts import with_returns
from tidemark.operators.rolling import rolling_performance, sliding_moments
from tidemark.sources.landing import refetch_plan

DAY = dt.date(2020, 1, 1)
FACT = "symbol string, asset_type string, price_date date, close_price double, daily_return double, market_cap double"


def test_moments_equal_exact_ones_behind_extreme_values():
    rng = random.Random(1)
    x = [rng.gauss(0, 1e-3) for _ in range(400)]
    x[50], x[51], x[120], x[200] = 1e12, -3e9, float("nan"), 1e-300
    got = sliding_moments(np.array(x), np.arange(400), (1, 2, 7, 30, 90))
    for n, (count, mean, squares) in got.items():
        for i in range(400):
            own = [v for v in x[max(0, i - n + 1) : i + 1] if not math.isnan(v)]
            assert count[i] == len(own)
            if own:
                assert mean[i] == pytest.approx(statistics.fmean(own), rel=1e-12, abs=1e-12 * max(map(abs, own)))
            if len(own) > 1:
                assert squares[i] / (len(own) - 1) == pytest.approx(statistics.variance(own), rel=1e-9)


def test_equal_windows_are_bit_equal_wherever_they_lie():
    """Behind an outlier, at another offset, in another series: the same 30 values give the same bits."""
    rng = random.Random(2)
    tail = [rng.gauss(0, 1) ** 5 for _ in range(30)]
    seen = set()
    for before in ([], [1e15] * 3, [0.1] * 17, [1e-9, -1e20] * 40):
        x = np.array(before + tail)
        count, mean, squares = sliding_moments(np.concatenate(([5.0, 6.0], x)), np.concatenate(([0, 1], np.arange(len(x)))), (30,))[30]
        seen.add((count[-1], mean[-1].tobytes(), squares[-1].tobytes()))
    assert len(seen) == 1


def series_fact(spark, seed=3):
    """One symbol with a third of all rows, gaps in its days, null returns, a symbol in both sources on the same days."""
    rng = random.Random(seed)
    rows = []
    for symbol, n in (("HOT", 700), *((f"S{i}", rng.randint(1, 120)) for i in range(20))):
        day = DAY
        for _ in range(n):
            day += dt.timedelta(days=rng.choice([1, 1, 1, 2, 40]))
            r = None if rng.random() < 0.03 else rng.gauss(0, 1) ** 7
            rows.append((symbol, "x", day, round(rng.uniform(1, 9), 3), r, None))
            if symbol == "S3":
                rows.append((symbol, "x", day, 5.0, 0.5, 1.0))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, FACT)


@pytest.fixture(scope="module")
def fact(spark):
    return series_fact(spark).cache()


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("kw", [{}, {"slice_rows": 1}, {"slice_rows": 100}, {"slice_rows": 100, "method": "frames"}, {"slice_rows": 5000}])
def test_blocks_and_slices_equal_frames(fact, kw):
    windows = (2, 7, 30, 90)
    want = rows_of(rolling_performance(fact, windows, lookback_days=None, method="frames"))
    assert rows_of(rolling_performance(fact, windows, lookback_days=None, **kw)) == want


def test_batches_do_not_change_bits(spark, fact, monkeypatch):
    from tidemark.operators import rolling

    want = rows_of(rolling_performance(fact, lookback_days=None))
    monkeypatch.setattr(rolling, "GATHER", 1)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert rows_of(rolling_performance(fact, lookback_days=None)) == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_tied_dates_are_ordered_by_source(spark):
    rows = [("A", "x", DAY, 2.0, None, 9.0), ("A", "x", DAY, 1.0, None, None), ("A", "x", DAY + dt.timedelta(days=1), 4.0, 1.0, None)]
    for _ in range(3):
        random.shuffle(rows)
        out = rolling_performance(spark.createDataFrame(rows, FACT).repartition(3), (2, 3), lookback_days=None)
        last = out.where(F.col("price_date") > F.lit(DAY)).first()
        assert (last["return_2d"], last["return_3d"]) == (1.0, 3.0)  # the chart point is the later one of its day


@pytest.mark.parametrize("slice_rows,reach", [(1, 0), (50, 1), (50, 90), (10_000, 5)])
def test_slices_are_bounded_and_hold_what_windows_reach_back_to(fact, slice_rows, reach):
    cut = sliced(fact.select("symbol", "price_date", "close_price", "daily_return", "market_cap"), ["symbol"], "price_date", slice_rows, reach).cache()
    assert cut.where(OWN).count() == fact.count()
    month = fact.groupBy("symbol", F.trunc("price_date", "month")).count().agg(F.max("count")).first()[0]
    sizes = cut.groupBy("symbol", SLICE).agg(F.count_if(OWN).alias("own"), F.count_if(~F.col(OWN)).alias("halo")).collect()
    assert max(r["own"] for r in sizes) <= slice_rows + month
    assert max(r["halo"] for r in sizes) <= reach + month
    if slice_rows == 50:
        assert sum(r["symbol"] == "HOT" for r in sizes) > 5
    series, slices = {}, {}
    for r in cut.collect():
        slices.setdefault((r["symbol"], r[SLICE]), []).append((r["price_date"], r[OWN]))
        if r[OWN]:
            series.setdefault(r["symbol"], []).append(r["price_date"])
    for (symbol, _), own in slices.items():
        whole = sorted(series[symbol])
        first = whole.index(min(d for d, mine in own if mine))
        held = sorted(d for d, _ in own)
        assert held[-1:] == whole[first + sum(m for _, m in own) - 1 :][:1]
        assert len(held) >= sum(m for _, m in own) + min(reach, first)
        assert held == whole[first + sum(m for _, m in own) - len(held) : first + sum(m for _, m in own)]


def test_returns_in_slices_equal_whole_series(spark):
    rng = random.Random(9)
    rows = [(s, src, DAY + dt.timedelta(days=d * rng.randint(1, 3)), rng.uniform(1, 5)) for s in ("A", "B", None) for src in ("bars", "chart") for d in range(rng.randint(1, 200))]
    rows = list({r[:3]: r for r in rows}.values())
    df = spark.createDataFrame(rows, "symbol string, source string, price_date date, close_price double")
    df = df.withColumns({c: F.col("close_price") for c in ("high_price", "low_price")})
    want = rows_of(with_returns(df))
    for n in (1, 30, 1000):
        assert rows_of(with_returns(df, slice_rows=n)) == want


def test_refetch_plan(spark):
    d = lambda i: DAY + dt.timedelta(days=i)
    loaded = [("A", d(i)) for i in (-5, 0, 1, 4, 4, 9, 30)] + [("B", d(i)) for i in range(10)] + [("X", d(3))]
    expected = spark.createDataFrame([("A",), ("B",), ("C",), ("C",)], "symbol string")
    plan = refetch_plan(expected, spark.createDataFrame(loaded, "symbol string, price_date date"), d(0), d(9))
    got = sorted((r[0], (r[1] - DAY).days, (r[2] - DAY).days, r[3]) for r in plan.collect())
    assert got == [("A", 2, 3, 2), ("A", 5, 8, 4), ("C", 0, 9, 10)]
