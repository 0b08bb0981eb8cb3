"""An incremental run computes dirty rows only and leaves what a full rebuild would."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

import oracle_compare as oc
from tidemark.plans import job
from tidemark.schemas import RAW_BARS
from tidemark.sources import fixtures as fx
from tidemark.sources.landing import refetch_plan, write_landing

MARTS = ["dim_assets", "dim_dates", "fact_daily_prices", "rolling_performance", "relative_performance",
         "asset_performance_summary", "asset_performance_summary_latest", "volatility_correlation_summary"]
STAMP = "__dbt_updated_at"


def bar_doc(symbol, day, close, at, run):
    ms = int(dt.datetime.combine(day, dt.time(5), dt.timezone.utc).timestamp() * 1000)
    return (symbol, None, None, [(ms, close, close, close, close, 1.0)], at, run)


def land_bars(spark, landing, docs):
    write_landing(spark.createDataFrame(docs, RAW_BARS).coalesce(1), landing, "bars")


def tables(spark, wh):
    out = {}
    for name in MARTS:
        df = spark.read.parquet(f"{wh}/marts/{name}")
        out[name] = oc.digest(*oc.spark_rows(df.drop(STAMP)))
    for name in ("bars", "chart"):
        out[name] = oc.digest(*oc.spark_rows(spark.read.parquet(f"{wh}/staging/{name}")))
    return out


@pytest.fixture(scope="module")
def landing(spark, sf_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("landing"))
    write_landing(fx.raw_nested(spark, sf_dir).coalesce(2), root, "bars")
    chart = fx.raw_chart(spark, sf_dir).where(F.col("coin_id") == fx.ORDERS_BENCHMARK)
    write_landing(chart.coalesce(1), root, "chart")
    return root


def stamps(spark, path, *where):
    rows = spark.read.parquet(path)
    for w in where:
        rows = rows.where(w)
    return rows.groupBy(STAMP).count().orderBy(STAMP).collect()


def test_incremental_equals_full_and_touches_dirty_rows_only(spark, landing, tmp_path, monkeypatch):
    wh, reg = str(tmp_path / "wh"), fx.registry(spark)

    def go(to=wh, full=False, **kw):
        return job.run(spark, landing, to, fx.AS_OF, full=full, benchmark=fx.ORDERS_BENCHMARK, registry=reg, **kw)

    first = go(full=True)
    before = tables(spark, wh)

    # Nothing new: nothing is written, the last checks are given out.
    stamped = stamps(spark, f"{wh}/marts/rolling_performance")
    assert go() == first
    assert tables(spark, wh) == before and stamps(spark, f"{wh}/marts/rolling_performance") == stamped

    # New days for two symbols, a correction far back for a third one, a fetch that repeats what is there.
    fact = spark.read.parquet(f"{wh}/marts/fact_daily_prices")
    last = fact.agg(F.max("price_date")).first()[0]
    old = sorted(r[0] for r in fact.where("symbol = '3-MEDIUM'").select("price_date").collect())
    late = old[-40]
    at = dt.datetime(2003, 1, 1, 12, tzinfo=dt.timezone.utc)
    land_bars(spark, landing, [
        bar_doc("2-HIGH", last + dt.timedelta(days=1), 1234.5, at, "n1"),
        bar_doc("2-HIGH", last + dt.timedelta(days=3), 2345.5, at, "n1"),
        bar_doc("5-LOW", last + dt.timedelta(days=2), 345.25, at, "n1"),
        bar_doc("3-MEDIUM", late, 777.125, at, "n1"),
    ])
    go()
    monkeypatch.undo()
    fresh = str(tmp_path / "fresh")
    go(fresh, full=True)
    assert tables(spark, wh) == tables(spark, fresh)

    # Fact: the four rows, the one after the correction, and the last 5-LOW row, a day that the calendar lacked. Rolling: the new rows and 365 rows from the correction on.
    newest = stamps(spark, f"{wh}/marts/fact_daily_prices")[-1]
    assert newest["count"] in (5, 6)
    rolling = f"{wh}/marts/rolling_performance"
    assert [r["count"] for r in stamps(spark, rolling, "symbol = '3-MEDIUM'")][-1] == 40
    assert [r["count"] for r in stamps(spark, rolling, "symbol = '2-HIGH'")][-1] == 2
    assert len(stamps(spark, rolling, "symbol = '1-URGENT'")) == 1


def test_a_run_that_dies_is_made_up_for(spark, landing, tmp_path, monkeypatch):
    wh, reg = str(tmp_path / "wh"), fx.registry(spark)

    def go(to=wh, full=False, **kw):
        return job.run(spark, landing, to, fx.AS_OF, full=full, benchmark=fx.ORDERS_BENCHMARK, registry=reg, **kw)

    go(full=True)
    at = dt.datetime(2003, 6, 1, 12, tzinfo=dt.timezone.utc)
    land_bars(spark, landing, [bar_doc("4-NOT SPECIFIED", dt.date(1998, 5, 5), 55.5, at, "x1")])

    def dies(*a, **kw):
        raise RuntimeError("lost")

    # After staging took the change over, before any mart.
    real = job.dim_assets
    monkeypatch.setattr(job, "dim_assets", dies)
    with pytest.raises(RuntimeError, match="lost"):
        go()
    monkeypatch.setattr(job, "dim_assets", real)
    # While the staging table is being written.
    land_bars(spark, landing, [bar_doc("2-HIGH", dt.date(1998, 5, 6), 66.5, at, "x2")])
    upsert = job.upsert
    monkeypatch.setattr(job, "upsert", dies)
    with pytest.raises(RuntimeError, match="lost"):
        go()
    monkeypatch.setattr(job, "upsert", upsert)
    go(window=("1998-05-01", "1998-05-20"))
    fresh = str(tmp_path / "fresh")
    go(fresh, full=True)
    assert tables(spark, wh) == tables(spark, fresh)
    staged = spark.read.parquet(f"{wh}/staging/bars").select("symbol", "price_date")
    staged = staged.unionByName(spark.read.parquet(f"{wh}/staging/chart").select("symbol", "price_date"))
    want = refetch_plan(reg, staged, "1998-05-01", "1998-05-20")
    got = spark.read.parquet(f"{wh}/marts/refetch_plan")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() > 0


def test_other_settings_rebuild(spark, landing, tmp_path):
    wh, reg = str(tmp_path / "wh"), fx.registry(spark)
    run = lambda benchmark, days: job.run(spark, landing, wh, fx.AS_OF, benchmark=benchmark, registry=reg, lookback_days=days)
    run(fx.ORDERS_BENCHMARK, 100)
    run("2-HIGH", 60)
    rel = spark.read.parquet(f"{wh}/marts/relative_performance")
    assert rel.where("symbol = '2-HIGH'").count() == 0 and rel.where("symbol = '1-URGENT'").count() > 0
    span = spark.read.parquet(f"{wh}/marts/rolling_performance").agg(F.datediff(F.max("price_date"), F.min("price_date"))).first()[0]
    assert span <= 60
    assert json.loads(job.read_state(spark, wh)["settings"])[:2] == ["2-HIGH", 60]
