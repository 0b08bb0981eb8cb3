"""Every check of the job passes on sound tables and fails on broken ones; audit column, pair list, rank paths."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators.correlation import volatility_correlation_summary
from tidemark.operators.rolling import rolling_performance
from tidemark.plans.checks import row_checks, run_job_checks

DAY = dt.date(2024, 1, 2)
PRICES = "symbol string, price_date date, close_price double"


def tables(spark, broken: bool):
    def frame(rows, bad, schema):
        return spark.createDataFrame(bad if broken else rows, schema)

    good = [(s, DAY, 1.0) for s in "ab"]
    stg = frame(good[:1], [("x", DAY, None), ("x", DAY, 1.0), (None, None, 1.0), ("y", DAY, 1.0)], PRICES)
    none = frame([("b", DAY, 1.0)], [], PRICES)
    fact_schema = "price_key string, " + PRICES + ", has_data_gap boolean"
    return {
        "raw_bars": frame([("a",)], [(None,)], "symbol string"),
        "raw_chart": frame([("b", "{}")], [(None, None)], "coin_id string, raw_json string"),
        "stg_bars": stg,
        "stg_chart": none,
        "dim_assets": frame(
            [("a", "stock", "equity"), ("b", "crypto", "crypto")],
            [("a", "coin", None), ("a", None, "cash"), (None, "stock", "fx")],
            "symbol string, asset_type string, asset_class string",
        ),
        "dim_dates": frame([(DAY,)], [(DAY,), (DAY,), (None,)], "date_key date"),
        "fact": frame(
            [("1", "a", DAY, 1.0, False), ("2", "b", DAY, 1.0, False)],
            [("1", "a", DAY, 1.0, True), ("1", "a", DAY, None, True), (None, None, None, 1.0, None)],
            fact_schema,
        ),
        "rolling": frame(good, [("a", DAY, 1.0), ("a", DAY, None), (None, None, 1.0)], PRICES),
        "relative": frame(good[:1], [("b", DAY, 1.0), ("b", DAY, 1.0), (None, None, 1.0), ("c", DAY, 1.0)], PRICES),
        "latest": frame([("a", DAY)], [(None, None)], "symbol string, latest_date date"),
        "correlation": frame(
            [("a", "b", 0.5, 3)],
            [("a", "b", 1.5, 0), ("a", "b", None, 1), (None, None, -2.0, 1)],
            "symbol_a string, symbol_b string, correlation double, obs_count long",
        ),
    }


def registry(spark):
    return spark.createDataFrame([("a", "stock"), ("b", "crypto")], "symbol string, asset_type string")


def test_sound_tables_pass_every_check(spark):
    found = run_job_checks(tables(spark, False), registry(spark), "b", threads=4)
    assert len(found) == 52 and not any(found.values()), found


def test_broken_tables_fail_the_checks_and_their_rows_are_kept(spark, tmp_path):
    found = run_job_checks(tables(spark, True), registry(spark), "b", str(tmp_path), threads=4)
    # An empty chart table has no row to be wrong; a table with rows is no empty one.
    holds = {f"stg_chart_{c}_not_null" for c in ("symbol", "price_date", "close_price")}
    holds |= {"stg_chart_unique_symbol_date", "stg_bars_has_rows", "fact_has_rows", "rolling_has_rows"}
    assert {k for k, n in found.items() if not n} == holds
    assert found["stg_chart_has_rows"] == 1
    for name, n in found.items():
        kept = spark.read.parquet(f"{tmp_path}/test_results/{name}").count()
        assert kept == n, name


@pytest.mark.parametrize("name", ["stg_chart", "stg_bars"])
def test_the_checks_left_hold_or_fail_too(spark, name):
    from tidemark.plans.checks import table_checks

    bad = spark.createDataFrame([("x", DAY, None), ("x", DAY, 1.0), (None, None, 1.0)], PRICES)
    counts = row_checks("b")[name]
    assert all(bad.where(c).count() == 1 for c in counts.values())
    t = tables(spark, False) | {name: bad}
    assert table_checks(t, registry(spark))[f"{name}_unique_symbol_date"]().count() == 1
    t = tables(spark, False) | {n: bad.limit(0) for n in ("fact", "rolling", "stg_bars")}
    made = table_checks(t, registry(spark))
    assert all(made[f"{n}_has_rows"]().count() == 1 for n in ("fact", "rolling", "stg_bars"))


def series(spark):
    rows = [(s, "stock", dt.date(2024, 1, 1) + dt.timedelta(d), 10.0 + (d * k) % 7, 0.01 * ((d * k) % 5)) for k, s in enumerate("abc", 2) for d in range(40)]
    return spark.createDataFrame(rows, "symbol string, asset_type string, price_date date, close_price double, daily_return double")


def test_pair_list_and_audit_column(spark):
    fact = series(spark)
    stamp = F.lit("2024-02-01 00:00:00").cast("timestamp")
    every = volatility_correlation_summary(fact)
    some = volatility_correlation_summary(fact, symbols=["a", "c"], ordered=False, updated_at=stamp)
    assert some.columns == [*every.columns, "__dbt_updated_at"]
    assert every.count() == 3
    want = [tuple(r) for r in every.where("symbol_a = 'a' AND symbol_b = 'c'").collect()]
    assert [tuple(r)[:-1] for r in some.collect()] == want
    rolled = rolling_performance(fact, updated_at=stamp)
    assert rolled.columns[-1] == "__dbt_updated_at" and rolled.where("__dbt_updated_at IS NULL").count() == 0


def test_first_close_by_position_equals_the_frame(spark):
    got = {(r["symbol"], r["price_date"]): r["return_7d"] for r in rolling_performance(series(spark)).collect()}
    rows = sorted((r["symbol"], r["price_date"], r["close_price"]) for r in series(spark).collect())
    for i, (symbol, day, close) in enumerate(rows):
        first = next(r for r in rows[max(0, i - 6) :] if r[0] == symbol)[2]
        assert got[symbol, day] == pytest.approx((close - first) / first, abs=1e-6)


def test_both_rank_paths_agree(spark):
    from tidemark.functions.ranking import global_rank

    df = spark.range(0, 900).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 17).alias("k"))
    for up in (True, False):
        one = sorted(map(tuple, global_rank(df, "k", "rk", up).collect()))
        many = sorted(map(tuple, global_rank(df, "k", "rk", up, single_task_rows=0).select("id", "k", "rk").collect()))
        assert [(a, c) for a, _, c in one] == [(a, c) for a, _, c in many]
