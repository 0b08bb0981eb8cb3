"""A3, A4, J10, PF8: bounds from parquet footers, and a look-back that reads its months only."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators.correlation import recent_returns
from tidemark.operators.rolling import lookback
from tidemark.plans.upsert import full_refresh, month_partition
from tidemark.sources.statistics import PUSH_DOWN, V1_SOURCES, _footers, bounds_frame, stored_bounds

DAY = dt.date(2020, 1, 1)


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("t") / "fact")
    rows = [(s, DAY + dt.timedelta(days=i), float(i), None if i % 7 == 0 else 0.1 * i, i) for s in "AB" for i in range(0, 900, 1 if s == "A" else 3)]
    df = spark.createDataFrame(rows + [("N", None, 1.0, None, None)], "symbol string, price_date date, close_price double, daily_return double, n int")
    full_refresh(df, path, month_partition(), sort_cols=["symbol"])
    return path


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bounds_come_from_footers(spark, table, tmp_path):
    before = {k: spark.conf.get(k) for k in (V1_SOURCES, PUSH_DOWN)}
    assert stored_bounds(spark, table, "price_date") == (DAY, DAY + dt.timedelta(days=899))  # one file has no date at all
    dated = str(tmp_path / "dated")
    spark.read.parquet(table).where("price_date is not null").drop("part").write.parquet(dated)
    table = dated
    assert stored_bounds(spark, table, "price_date") == (DAY, DAY + dt.timedelta(days=899))
    assert stored_bounds(spark, table, "n") == (0, 899)
    with _footers(spark):
        plan = plan_of(bounds_frame(spark, table, "price_date"))
    assert "PushedAggregation: [MIN(price_date), MAX(price_date)]" in plan
    assert "ReadSchema: struct<min(price_date):date,max(price_date):date>" in plan  # bounds, no column of the table
    assert {k: spark.conf.get(k) for k in before} == before
    with pytest.raises(ValueError, match="double"):
        stored_bounds(spark, table, "close_price")
    assert {k: spark.conf.get(k) for k in before} == before


def test_bounds_of_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "e")
    spark.createDataFrame([], "price_date date").write.parquet(path)
    assert stored_bounds(spark, path, "price_date") == (None, None)


def files_read(df):
    """Files of a lazy scan after partition pruning."""
    return {r[0] for r in df.select(F.input_file_name()).distinct().collect()}


def test_look_back_reads_its_months_only(spark, table):
    fact, last = spark.read.parquet(table), stored_bounds(spark, table, "price_date")[1]
    for days in (0, 20, 365, 2000):
        whole = fact.drop("part")
        want = sorted(map(tuple, lookback(whole, whole, days).collect()), key=repr)
        for anchor in (fact, last):
            assert sorted(map(tuple, lookback(fact, anchor, days).drop("part").collect()), key=repr) == want
    cut = lookback(fact, last, 20)
    assert "PartitionFilters: [isnotnull(part" in plan_of(cut) and "part" in plan_of(cut).split("PartitionFilters")[1][:200]
    months = {f.split("part=")[1].split("/")[0] for f in files_read(cut)}
    first = last - dt.timedelta(days=20)
    assert months == {f"{first:%Y-%m}", f"{last:%Y-%m}"}
    assert recent_returns(fact, 30).columns == ["symbol", "price_date", "daily_return"]
    same = lambda df: sorted(map(tuple, df.collect()))
    assert same(recent_returns(fact, 30)) == same(recent_returns(fact.drop("part"), 30)) == same(recent_returns(fact, 30, anchor=last))
