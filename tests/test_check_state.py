"""Checks merged from partition states equal checks over the whole table, after inserts and corrections."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.operators.check_state import ROWS, Checks, all_checks, update_state
from tidemark.plans.upsert import full_refresh, month_partition, upsert

SCHEMA = "symbol string, price_date date, close_price double, note string"


def checks():
    return Checks(
        rows={"null_close": F.col("close_price").isNull(), "negative": F.col("close_price") < 0, "never": F.lit(False)},
        unique={"symbol_date": ["symbol", "price_date"], "close_date": ["close_price", "price_date"]},
        distinct={"symbols": "symbol", "notes": "note"},
    )


def rows(rng, n, symbols):
    day = lambda: dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(200))
    return [(rng.choice(symbols), rng.choice([day(), day(), None]), rng.choice([None, -1.0, 2.0, 3.0, rng.random()]), None) for _ in range(n)]


def whole(df):
    one = quality.single_scan(df, checks().rows).first().asDict()
    out = {ROWS: one.pop("row_count")} | one
    out |= {n: quality.unique_combination(df, list(k)).count() for n, k in checks().unique.items()}
    return out | {n: df.select(c).where(F.col(c).isNotNull()).distinct().count() for n, c in checks().distinct.items()}


def test_merged_state_equals_full_checks(spark, tmp_path):
    rng = random.Random(3)
    target, state = str(tmp_path / "t"), str(tmp_path / "s")
    first = spark.createDataFrame(rows(rng, 150, ["A", "B", None]), SCHEMA)
    full_refresh(first, target, month_partition())  # duplicates stay
    update_state(spark, state, spark.read.parquet(target), checks())
    merged = lambda: {r["check"]: r["n"] for r in all_checks(spark, state, checks()).collect()}
    assert merged() == whole(spark.read.parquet(target).drop("part"))
    assert merged()["symbol_date"] > 0 and merged()["never"] == 0 and merged()["notes"] == 0
    for k in range(3):  # later loads insert and correct: their months are scanned, and no other
        batch = spark.createDataFrame(rows(rng, 25, ["A", "C", "D"])[:25], SCHEMA).where("price_date is not null")
        upsert(spark, target, batch, ["symbol", "price_date"], ["close_price"], month_partition())
        written = [r[0] for r in batch.select(month_partition()).distinct().collect()]
        table = spark.read.parquet(target)
        update_state(spark, state, table.where(F.col("part").isin(written)), checks(), written)
        assert merged() == whole(table.drop("part")), k
