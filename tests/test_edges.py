"""Hand-made edge tables (FIXTURES.md section 4)."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators.correlation import pairwise_correlation, volatility_stats
from tidemark.operators.dims import dim_assets, dim_dates
from tidemark.operators.facts import bars_source, chart_source, combine_sources, returns_to_rewrite, with_returns
from tidemark.operators.relative import relative_performance
from tidemark.operators.rolling import rolling_performance
from tidemark.operators.staging import stage_bars, stage_market_chart
from tidemark.schemas import RAW_BARS, RAW_CHART, REGISTRY

D = dt.date
TS = dt.datetime


def ms(d: dt.date, hour: int = 5) -> int:
    return int(dt.datetime(d.year, d.month, d.day, hour, tzinfo=dt.timezone.utc).timestamp() * 1000)


def raw_bars(spark, docs):
    return spark.createDataFrame(docs, RAW_BARS)


def bars(spark, rows, cols="symbol string, price_date date, close_price double"):
    df = spark.createDataFrame(rows, cols)
    for c in ("open_price", "high_price", "low_price", "volume"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("double"))
    return df


# ---------------------------------------------------------------- staging


def test_stage_bars_zero_null_and_partial_bars(spark):
    d = D(2025, 3, 10)
    pts = [
        (ms(d), None, None, None, None, None),  # all null: dropped
        (ms(d + dt.timedelta(1)), 0.0, 0.0, 0.0, 0.0, 0.0),  # all zero: dropped
        (ms(d + dt.timedelta(2)), 0.0, 0.0, 0.0, 0.0, 5.0),  # only volume: kept
        (ms(d + dt.timedelta(3)), 1.0, 2.0, 0.5, None, 10.0),  # close null: kept
    ]
    docs = [("AAA", "2025-03-10", "2025-03-14", pts, TS(2025, 3, 15), "r1"), ("BBB", None, None, None, TS(2025, 3, 15), "r1"),
            ("CCC", None, None, [], TS(2025, 3, 15), "r1")]
    out = {r["price_date"]: r for r in stage_bars(raw_bars(spark, docs)).collect()}
    assert sorted(out) == [d + dt.timedelta(2), d + dt.timedelta(3)]
    assert out[d + dt.timedelta(3)]["close_price"] is None


def test_stage_bars_latest_ingestion_wins_and_ties_are_deterministic(spark):
    d = D(2025, 3, 10)
    docs = [
        ("AAA", None, None, [(ms(d), 1.0, 1.0, 1.0, 1.0, 1.0)], TS(2025, 3, 11), "first"),
        ("AAA", None, None, [(ms(d), 2.0, 2.0, 2.0, 2.0, 2.0)], TS(2025, 3, 13), "third"),
        ("AAA", None, None, [(ms(d), 3.0, 3.0, 3.0, 3.0, 3.0)], TS(2025, 3, 12), "second"),
        # Two bars of one fetch on the same UTC date: the later bar wins.
        ("BBB", None, None, [(ms(d, 1), 5.0, 5.0, 5.0, 5.0, 5.0), (ms(d, 20), 6.0, 6.0, 6.0, 6.0, 6.0)], TS(2025, 3, 11), "x"),
        # Same date, same ingestion, same timestamp: larger values win, every time.
        ("CCC", None, None, [(ms(d), 7.0, 7.0, 7.0, 7.0, 7.0)], TS(2025, 3, 11), "a"),
        ("CCC", None, None, [(ms(d), 8.0, 8.0, 8.0, 8.0, 8.0)], TS(2025, 3, 11), "b"),
    ]
    out = {r["symbol"]: r for r in stage_bars(raw_bars(spark, docs)).collect()}
    assert out["AAA"]["close_price"] == 2.0 and out["AAA"]["__run_id"] == "third"
    assert out["BBB"]["close_price"] == 6.0
    assert out["CCC"]["close_price"] == 8.0


def test_stage_bars_utc_date(spark):
    # 2025-03-06 05:00 UTC, the first bar of the sample feed
    docs = [("AAPL", None, None, [(1741237200000, 1.0, 1.0, 1.0, 1.0, 1.0)], TS(2025, 3, 7), "r")]
    assert stage_bars(raw_bars(spark, docs)).first()["price_date"] == D(2025, 3, 6)


def chart_doc(coin, payload, at, run="r"):
    return (coin, "usd", None, None, payload if isinstance(payload, str) else json.dumps(payload), at, run)


def test_stage_chart_zip_shortest_null_price_absent_key_malformed_float_ts(spark):
    d0 = ms(D(2025, 1, 1), 0)
    day = 86_400_000
    docs = [
        chart_doc("uneq", {"prices": [[d0, 1.0], [d0 + day, 2.0], [d0 + 2 * day, 3.0]],
                           "total_volumes": [[d0, 10], [d0 + day, 20]],
                           "market_caps": [[d0, 100], [d0 + day, 200], [d0 + 2 * day, 300]]}, TS(2025, 2, 1)),
        chart_doc("nullp", {"prices": [[d0, None], [d0 + day, 0], [d0 + 2 * day, 4.5]],
                            "total_volumes": [[d0, 1], [d0 + day, 1], [d0 + 2 * day, 1]],
                            "market_caps": [[d0, 1], [d0 + day, 1], [d0 + 2 * day, 1]]}, TS(2025, 2, 1)),
        chart_doc("nokey", {"prices": [[d0, 1.0]], "total_volumes": [[d0, 1.0]]}, TS(2025, 2, 1)),
        chart_doc("bad", "{not json", TS(2025, 2, 1)),
        chart_doc("float", {"prices": [[float(d0) + 0.6, 9.0]], "total_volumes": [[d0, 1]], "market_caps": [[d0, 1]]},
                  TS(2025, 2, 1)),
    ]
    out = stage_market_chart(spark.createDataFrame(docs, RAW_CHART)).collect()
    by = {}
    for r in out:
        by.setdefault(r["symbol"], []).append(r)
    assert sorted(r["price_date"] for r in by["uneq"]) == [D(2025, 1, 1), D(2025, 1, 2)]
    assert [r["close_price"] for r in by["nullp"]] == [4.5]
    assert "nokey" not in by and "bad" not in by
    assert by["float"][0]["price_date"] == D(2025, 1, 1)


# ---------------------------------------------------------------- fact and returns


def test_gap_of_five_and_six_days_and_zero_close(spark):
    rows = [
        ("A", D(2025, 1, 1), 10.0),
        ("A", D(2025, 1, 6), 0.0),   # 5 days later: no gap; previous close positive
        ("A", D(2025, 1, 12), 5.0),  # 6 days later: gap; previous close 0 -> return NULL
        ("A", D(2025, 1, 13), 6.0),
        ("S", D(2025, 1, 1), 1.0),   # a symbol with one row
    ]
    out = {(r["symbol"], r["price_date"]): r for r in with_returns(combine_sources(bars_source(bars(spark, rows)))).collect()}
    a1, a2, a3, a4 = (out[("A", D(2025, 1, d))] for d in (1, 6, 12, 13))
    assert a1["daily_return"] is None and a1["has_data_gap"] is False and a1["days_since_prev"] is None
    assert a2["days_since_prev"] == 5 and a2["has_data_gap"] is False and a2["daily_return"] == -1.0
    assert a3["days_since_prev"] == 6 and a3["has_data_gap"] is True and a3["daily_return"] is None
    assert a4["daily_return"] == pytest.approx(0.2)
    assert out[("S", D(2025, 1, 1))]["daily_return"] is None


def test_symbol_in_two_sources_is_two_series(spark):
    b = bars(spark, [("X", D(2025, 1, 1), 10.0), ("X", D(2025, 1, 3), 11.0)])
    c = spark.createDataFrame(
        [("X", "usd", D(2025, 1, 2), 100.0, 1.0, 1.0)],
        "symbol string, vs_currency string, price_date date, close_price double, volume double, market_cap double",
    )
    out = with_returns(combine_sources(bars_source(b), chart_source(c))).collect()
    by = {(r["source"], r["price_date"]): r for r in out}
    assert by[("bars", D(2025, 1, 3))]["prev_close_price"] == 10.0
    assert by[("chart", D(2025, 1, 2))]["prev_close_price"] is None


def test_incremental_returns_with_late_correction_equal_full_build(spark):
    rows = [("A", D(2025, 1, d), float(d)) for d in range(1, 11)]
    full = with_returns(combine_sources(bars_source(bars(spark, rows))))
    existing = with_returns(combine_sources(bars_source(bars(spark, rows[:7]))))
    # late correction of day 5, plus new days 8..10
    incoming_rows = [("A", D(2025, 1, 5), 50.0)] + rows[7:]
    incoming = bars_source(bars(spark, incoming_rows)).select(*existing.columns[:10], "source")
    rewrite = returns_to_rewrite(existing, incoming)
    got = {r["price_date"]: r["daily_return"] for r in rewrite.collect()}
    corrected = [r if r[1] != D(2025, 1, 5) else ("A", D(2025, 1, 5), 50.0) for r in rows]
    want = {r["price_date"]: r["daily_return"]
            for r in with_returns(combine_sources(bars_source(bars(spark, corrected)))).collect()}
    assert set(got) == {D(2025, 1, d) for d in range(5, 11)}
    for k, v in got.items():
        assert v == pytest.approx(want[k])
    assert full.count() == 10


# ---------------------------------------------------------------- rolling, relative, correlation


def test_rolling_window_longer_than_history_is_expanding(spark):
    rows = [("A", D(2025, 1, d), 100.0 + d * (-1) ** d) for d in range(1, 21)]
    fact = with_returns(combine_sources(bars_source(bars(spark, rows)))).withColumn("asset_type", F.lit("stock"))
    r = {x["price_date"]: x for x in rolling_performance(fact, windows=(7, 365), lookback_days=None).collect()}
    last = r[D(2025, 1, 20)]
    closes = [100.0 + d * (-1) ** d for d in range(1, 21)]
    assert last["return_365d"] == round((closes[-1] - closes[0]) / closes[0], 6)
    assert last["return_7d"] == round((closes[-1] - closes[-7]) / closes[-7], 6)
    assert last["obs_365d"] == 19 and last["obs_7d"] == 7
    assert r[D(2025, 1, 1)]["return_7d"] == 0.0 and r[D(2025, 1, 1)]["volatility_7d"] is None
    assert r[D(2025, 1, 2)]["volatility_7d"] is None  # one return only


def test_relative_dates_missing_in_benchmark_drop_and_zero_vol_ratio_is_null(spark):
    rows = [("B", D(2025, 1, d), 100.0) for d in (1, 2, 3)] + [("A", D(2025, 1, d), float(d)) for d in (1, 2, 3, 4)]
    fact = with_returns(combine_sources(bars_source(bars(spark, rows)))).withColumn("asset_type", F.lit("t"))
    roll = rolling_performance(fact, windows=(7,), lookback_days=None)
    rel = relative_performance(roll, benchmark="B", windows=(7,)).collect()
    assert sorted(r["price_date"] for r in rel) == [D(2025, 1, 1), D(2025, 1, 2), D(2025, 1, 3)]
    assert all(r["relative_volatility_7d_vs_btc"] is None for r in rel)  # benchmark is flat


def test_correlation_zero_variance_one_and_no_common_date(spark):
    rows = (
        [("FLAT", D(2025, 1, d), 0.0) for d in range(1, 6)]
        + [("UP", D(2025, 1, d), 0.01 * d) for d in range(1, 6)]
        + [("ONE", D(2025, 1, 1), 0.5), ("NONE", D(2025, 2, 1), 0.3)]
    )
    rets = spark.createDataFrame(rows, "symbol string, price_date date, daily_return double")
    pairs = {(r["symbol_a"], r["symbol_b"]): r for r in pairwise_correlation(rets).collect()}
    assert pairs[("FLAT", "UP")]["correlation"] is None and pairs[("FLAT", "UP")]["obs_count"] == 5
    assert pairs[("ONE", "UP")]["obs_count"] == 1 and pairs[("ONE", "UP")]["correlation"] is None
    assert not any("NONE" in k for k in pairs)
    stats = {r["symbol"]: r for r in volatility_stats(rets).collect()}
    assert stats["ONE"]["annual_volatility"] is None and stats["FLAT"]["annual_volatility"] == 0.0


def test_correlation_is_symmetric_and_bounded(spark):
    import random

    rnd = random.Random(7)
    rows = [(s, D(2025, 1, 1) + dt.timedelta(i), rnd.gauss(0, 0.02)) for s in "ABCD" for i in range(60)]
    rets = spark.createDataFrame(rows, "symbol string, price_date date, daily_return double")
    flipped = rets.withColumn("symbol", F.concat(F.lit("~"), F.col("symbol")))  # reverse a < b order
    a = {(r[0], r[1]): r[2] for r in pairwise_correlation(rets).select("symbol_a", "symbol_b", "correlation").collect()}
    b = {(r[0][1:], r[1][1:]): r[2] for r in pairwise_correlation(flipped).select("symbol_a", "symbol_b", "correlation").collect()}
    assert len(a) == 6 and a == b
    assert all(-1 <= v <= 1 for v in a.values())


# ---------------------------------------------------------------- calendar


def test_dim_dates_iso_week_leap_day_and_inclusive_end(spark):
    reg = spark.createDataFrame([("A", "stock", "a", "equity", "USD", "X", "US", False)], REGISTRY)
    stg = bars(spark, [("A", D(2024, 2, 28), 1.0), ("A", D(2025, 1, 2), 1.0)])
    dates = {r["date_key"]: r for r in dim_dates(dim_assets(reg, stg), as_of="2025-01-01").collect()}
    assert len(dates) == (D(2025, 1, 2) - D(2024, 2, 28)).days + 1
    assert D(2024, 2, 29) in dates
    assert dates[D(2024, 12, 30)]["week_of_year"] == 1
    sun = dates[D(2024, 12, 29)]
    assert sun["day_of_week"] == 1 and sun["is_weekend"] and not sun["is_weekday"] and sun["day_name"] == "Sunday"
    assert dates[D(2025, 1, 1)]["is_today"] and dates[D(2025, 1, 1)]["days_ago"] == 0
    assert dates[D(2024, 3, 1)]["year_quarter"] == "2024-Q1" and dates[D(2024, 3, 1)]["month_name"] == "March"


def test_dim_assets_symbol_without_data(spark):
    reg = spark.createDataFrame(
        [("A", "stock", "a", "equity", "USD", "X", "US", False), ("Z", "stock", "z", "equity", "USD", "X", "US", False)],
        REGISTRY,
    )
    out = {r["symbol"]: r for r in dim_assets(reg, bars(spark, [("A", D(2025, 1, 1), 1.0)])).collect()}
    assert out["Z"]["trading_days_available"] == 0 and out["Z"]["first_seen"] is None
    assert out["A"]["trading_days_available"] == 1


# ---------------------------------------------------------------- incremental writes


def test_upsert_empty_target_then_merge(spark, tmp_path):
    from tidemark.plans.upsert import month_partition, upsert

    target = str(tmp_path / "stg")
    schema = "symbol string, price_date date, close_price double, __de_processed_at timestamp"
    b1 = spark.createDataFrame([("A", D(2025, 1, 1), 1.0, TS(2025, 1, 2)), ("A", D(2025, 2, 1), 2.0, TS(2025, 2, 2))], schema)
    upsert(spark, target, b1, ["symbol", "price_date"], ["__de_processed_at"], month_partition())
    b2 = spark.createDataFrame([("A", D(2025, 2, 1), 20.0, TS(2025, 2, 3)), ("A", D(2025, 3, 1), 3.0, TS(2025, 3, 2))], schema)
    upsert(spark, target, b2, ["symbol", "price_date"], ["__de_processed_at"], month_partition())
    got = {r["price_date"]: r["close_price"] for r in spark.read.parquet(target).collect()}
    assert got == {D(2025, 1, 1): 1.0, D(2025, 2, 1): 20.0, D(2025, 3, 1): 3.0}


def test_upsert_prefer_latest_ignores_batch_order(spark, tmp_path):
    from tidemark.plans.upsert import month_partition, upsert

    target = str(tmp_path / "stg")
    schema = "symbol string, price_date date, close_price double, __de_processed_at timestamp"
    newer = spark.createDataFrame([("A", D(2025, 1, 1), 2.0, TS(2025, 1, 5))], schema)
    older = spark.createDataFrame([("A", D(2025, 1, 1), 1.0, TS(2025, 1, 2))], schema)
    for b in (newer, older):
        upsert(spark, target, b, ["symbol", "price_date"], ["__de_processed_at"], month_partition(), prefer="latest")
    assert [r["close_price"] for r in spark.read.parquet(target).collect()] == [2.0]


def test_incremental_watermark_empty_target(spark, tmp_path):
    from tidemark.plans.upsert import incremental_watermark

    assert incremental_watermark(spark, str(tmp_path / "missing")) is None


# ---------------------------------------------------------------- distributed rank


@pytest.mark.parametrize("ascending", [True, False])
def test_global_rank_hot_ties_and_nulls_match_brute_force(spark, ascending):
    import random

    from tidemark.functions.ranking import global_ranks

    rnd = random.Random(11)
    keys = []
    for i in range(3000):
        u = rnd.random()
        keys.append(None if u < 0.2 else (5.0 if u < 0.55 else float(rnd.randint(0, 50))))
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id long, k double")
    got = {r["id"]: r["rk"] for r in global_ranks(df, [("k", "rk", ascending)], partitions=16, single_task_rows=0).collect()}

    # Spark default null placement: first when ascending, last when descending.
    def sort_key(k):
        if k is None:
            return (0,) if ascending else (2,)
        return (1, k if ascending else -k)

    ordered = sorted(keys, key=sort_key)
    first_pos = {}
    for pos, k in enumerate(ordered, start=1):
        first_pos.setdefault(k, pos)
    assert all(got[i] == first_pos[k] for i, k in enumerate(keys))


# ---------------------------------------------------------------- incremental = full refresh


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_staging_loaded_in_random_batches_equals_full_refresh(spark, tmp_path, seed):
    """Documents arrive in ingestion order, split into random batches; each
    batch is staged and merged. The table equals staging everything at once."""
    import random

    from tidemark.operators.staging import BAR_VALUE_COLUMNS
    from tidemark.plans.upsert import month_partition, upsert

    rnd = random.Random(seed)
    days = [D(2025, 1, 1) + dt.timedelta(i) for i in range(40)]
    docs = []
    for k in range(12):  # 12 fetches, each re-reading an overlapping window with new values
        at = TS(2025, 3, 1) + dt.timedelta(hours=k)
        start = rnd.randint(0, 30)
        pts = [(ms(d), float(k), float(k + 1), float(k), rnd.choice([0.0, float(k + 1)]), 1.0)
               for d in days[start:start + rnd.randint(1, 10)]]
        docs.append((rnd.choice(["A", "B"]), None, None, pts, at, f"run{k}"))
    full = stage_bars(raw_bars(spark, docs))
    target = str(tmp_path / f"stg{seed}")
    cuts = sorted(rnd.sample(range(1, 12), 3))
    for lo, hi in zip([0] + cuts, cuts + [12]):
        batch = stage_bars(raw_bars(spark, docs[lo:hi]))
        upsert(spark, target, batch, ["symbol", "price_date"], ["__de_processed_at", *BAR_VALUE_COLUMNS],
               month_partition())
    got = spark.read.parquet(target).drop("part")
    assert got.exceptAll(full.select(*got.columns)).count() == 0
    assert full.select(*got.columns).exceptAll(got).count() == 0


def test_prefix_rolling_matches_frames(spark, sf_dir):
    from tidemark.plans.star import orders_star

    fact = orders_star(spark, sf_dir).fact.cache()
    a = rolling_performance(fact, lookback_days=None, method="frames")
    b = rolling_performance(fact, lookback_days=None, method="prefix")
    j = a.alias("a").join(b.alias("b"), ["symbol", "price_date"])
    assert j.count() == a.count() == b.count()
    exact = [c for c in a.columns if c.startswith(("return_", "obs_"))]
    for c in exact:
        assert j.where(~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))).count() == 0, c
    for c in [c for c in a.columns if c.startswith("volatility_")]:
        worst = j.select(F.max(F.abs(F.col(f"a.{c}") - F.col(f"b.{c}")))).first()[0]
        assert worst is None or worst <= 1.01e-6, (c, worst)


def test_stage_chart_quoted_and_bad_values(spark):
    d0 = ms(D(2025, 1, 1), 0)
    doc = ('{"prices": [[%d, "12.5"], [%d, "n/a"]], "total_volumes": [[%d, 1], [%d, 2]], '
           '"market_caps": [[%d, 3], [%d, 4]]}') % (d0, d0 + 86_400_000, d0, d0 + 86_400_000, d0, d0 + 86_400_000)
    out = stage_market_chart(spark.createDataFrame([chart_doc("q", doc, TS(2025, 2, 1))], RAW_CHART)).collect()
    assert [(r["price_date"], r["close_price"], r["volume"]) for r in out] == [(D(2025, 1, 1), 12.5, 1.0)]


def test_hot_date_split_gives_the_same_pairs(spark):
    hot = spark.range(300).select(
        F.concat(F.lit("S"), F.col("id").cast("string")).alias("symbol"),
        F.lit("2025-01-01").cast("date").alias("price_date"),
        (F.rand(1) / 100).alias("daily_return"),
    )
    cold = spark.range(900).select(
        F.concat(F.lit("S"), (F.col("id") % 300).cast("string")).alias("symbol"),
        F.date_add(F.lit("2025-01-02").cast("date"), (F.col("id") % 9).cast("int")).alias("price_date"),
        (F.rand(2) / 100).alias("daily_return"),
    )
    rets = hot.unionByName(cold).dropDuplicates(["symbol", "price_date"]).checkpoint(eager=True)
    whole = {tuple(r) for r in pairwise_correlation(rets, pairs_per_task=10**9, materialize=False).collect()}
    split = {tuple(r) for r in pairwise_correlation(rets, pairs_per_task=400, materialize=False).collect()}  # k=15 on the hot date
    assert len(whole) == 300 * 299 // 2
    assert whole == split


def test_chart_stream_equals_batch_staging(spark, tmp_path):
    from tidemark.sources.landing import write_landing
    from tidemark.streaming.landing_stream import stage_chart_stream

    d0 = ms(D(2025, 1, 1), 0)
    day = 86_400_000
    docs = []
    for k in range(4):  # overlapping fetches, later ones correct the earlier values
        pts = [[d0 + i * day, 100.0 + k + i] for i in range(k, k + 5)]
        payload = {"prices": pts, "total_volumes": [[t, 1.0] for t, _ in pts], "market_caps": [[t, 2.0] for t, _ in pts]}
        docs.append(chart_doc("coin", payload, TS(2025, 2, 1) + dt.timedelta(hours=k)))
    raw = spark.createDataFrame(docs, RAW_CHART)
    landing = str(tmp_path / "landing")
    write_landing(raw.repartition(4), landing, "chart")
    staging = str(tmp_path / "staging")
    stage_chart_stream(spark, f"{landing}/chart", staging, str(tmp_path / "ckpt"), max_files_per_trigger=1)
    got = spark.read.parquet(staging).drop("part")
    want = stage_market_chart(raw).select(*got.columns)
    assert got.count() == 8
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


# ---------------------------------------------------------------- checks


def test_quality_checks_pass_and_fail(spark):
    from tidemark.operators import quality

    df = spark.createDataFrame([(i, "a" if i % 2 else "b", float(i)) for i in range(10)], "id int, s string, v double")
    assert quality.row_count_between(df, 1, 20).count() == 0
    assert quality.row_count_between(df, 11).first()["row_count"] == 10
    assert quality.distinct_count_equal(df, "s", 2).count() == 0
    assert quality.distinct_count_equal(df, "s", 3, approximate=True).first()["distinct_count"] == 2
    assert quality.values_between(df, "v", 0, 8).count() == 1
    assert quality.accepted_values(df, "s", ["a"]).count() == 5
    assert quality.not_in_set(df, "s", ["a"]).count() == 5
    assert quality.unique(df, "s").count() == 2 and quality.unique(df, "id").count() == 0
    one = quality.single_scan(df, {"neg": F.col("v") < 0, "big": F.col("v") > 5}).first()
    assert (one["row_count"], one["neg"], one["big"]) == (10, 0, 4)


def test_calendar_windows_differ_from_row_windows_only_across_gaps(spark):
    # daily rows on days 1-10, then one row on day 20
    rows = [("A", D(2025, 1, d), 100.0 + d) for d in list(range(1, 11)) + [20]]
    fact = with_returns(combine_sources(bars_source(bars(spark, rows)))).withColumn("asset_type", F.lit("t"))
    by_rows = {r["price_date"]: r for r in rolling_performance(fact, windows=(7,), lookback_days=None).collect()}
    by_days = {r["price_date"]: r for r in
               rolling_performance(fact, windows=(7,), lookback_days=None, unit="calendar").collect()}
    for d in range(1, 11):  # no gap yet: identical
        assert by_rows[D(2025, 1, d)]["return_7d"] == by_days[D(2025, 1, d)]["return_7d"]
    last_rows, last_days = by_rows[D(2025, 1, 20)], by_days[D(2025, 1, 20)]
    assert last_rows["obs_7d"] == 7 and last_rows["return_7d"] == round((120 - 105) / 105, 6)  # days 5-10 and 20
    assert last_days["obs_7d"] == 1 and last_days["return_7d"] == 0.0  # only itself within 7 days
