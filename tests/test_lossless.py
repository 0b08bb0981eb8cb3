"""Writes and loads that must not lose rows."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators.facts import fact_daily_prices
from tidemark.plans import job
from tidemark.plans.upsert import full_refresh, incremental_watermark, month_partition, table_exists, upsert
from tidemark.sources.landing import append_raw, read_raw_since, with_landing_path

SCHEMA = "symbol string, price_date date, close_price double, __de_processed_at timestamp"
AT = dt.datetime(2025, 1, 9, 12, tzinfo=dt.timezone.utc)


def _rows(spark, *rows):
    return spark.createDataFrame([(s, d, c, AT) for s, d, c in rows], SCHEMA)


def _upsert(spark, path, batch, **kw):
    upsert(spark, path, batch, ["symbol", "price_date"], ["__de_processed_at", "close_price"], month_partition(), **kw)


def _content(spark, path):
    return sorted((str(r[0]), str(r[1]), r[2]) for r in spark.read.parquet(path).select("symbol", "price_date", "close_price").collect())


@pytest.mark.parametrize("limit", [10_000, 0])  # a literal list of partitions, or a join with them
@pytest.mark.parametrize("prefer", ["batch", "latest"])
def test_upsert_keeps_null_partitions_and_matches_null_keys(spark, tmp_path, limit, prefer):
    path, day = str(tmp_path / "t"), dt.date(2025, 1, 2)
    full_refresh(_rows(spark, ("A", None, 1.0), ("C", day, 3.0), ("D", dt.date(2025, 3, 1), 4.0)), path, month_partition())
    _upsert(spark, path, _rows(spark, ("B", None, 2.0), ("C", day, 5.0)), max_literal_partitions=limit, prefer=prefer)
    assert _content(spark, path) == [("A", "None", 1.0), ("B", "None", 2.0), ("C", "2025-01-02", 5.0), ("D", "2025-03-01", 4.0)]
    _upsert(spark, path, _rows(spark, ("A", None, 9.0)), max_literal_partitions=limit, prefer=prefer)  # NULL dates only
    assert _content(spark, path)[0] == ("A", "None", 9.0) and len(_content(spark, path)) == 4


def test_unreadable_target_is_an_error_and_stays(spark, tmp_path):
    path = tmp_path / "t"
    (path / "part=2025-01").mkdir(parents=True)
    (path / "part=2025-01" / "x.parquet").write_bytes(b"not parquet")
    assert table_exists(spark, str(path))
    with pytest.raises(Exception):  # noqa: B017 - whatever the reader says
        _upsert(spark, str(path), _rows(spark, ("A", dt.date(2025, 1, 2), 1.0)))
    assert (path / "part=2025-01" / "x.parquet").read_bytes() == b"not parquet"
    assert not table_exists(spark, str(tmp_path / "absent"))


def test_upsert_reads_its_batch_once(spark, tmp_path):
    path, seen = str(tmp_path / "t"), spark.sparkContext.accumulator(0)
    full_refresh(_rows(spark, ("A", dt.date(2025, 1, 2), 1.0)), path, month_partition())

    def count(rows):
        for batch in rows:
            seen.add(batch.num_rows)
            yield batch

    batch = _rows(spark, *[(f"S{i}", dt.date(2025, 1, 3), float(i)) for i in range(10)]).mapInArrow(count, SCHEMA)
    _upsert(spark, path, batch)
    assert seen.value == 10


def test_overlap_is_computed_in_utc_whatever_the_drivers_zone(spark, tmp_path, monkeypatch):
    import time

    path = str(tmp_path / "raw")
    stamps = ["2025-01-09T12:00:00Z", "2025-01-06T21:00:00Z", "2025-01-06T11:00:00Z"]
    append_raw(spark.createDataFrame([(f"S{i}", s) for i, s in enumerate(stamps)], "symbol string, t string").select("symbol", F.to_timestamp("t").alias("__de_processed_at")), path)
    for zone in ("UTC", "Asia/Tokyo", "America/Los_Angeles"):
        monkeypatch.setenv("TZ", zone)
        time.tzset()
        mark = incremental_watermark(spark, path)
        assert mark == AT
        assert sorted(r[0] for r in read_raw_since(spark, path, mark).select("symbol").collect()) == ["S0", "S1"]
    monkeypatch.setenv("TZ", "UTC")
    time.tzset()


def test_landed_files_load_once_and_bad_lines_stop_the_run(spark, tmp_path):
    landing, wh = tmp_path / "landing", str(tmp_path / "wh")
    for source, doc in (("bars", {"symbol": "A", "results": []}), ("chart", {"coin_id": "b", "raw_json": "{}"})):
        (landing / source).mkdir(parents=True)
        (landing / source / "one.json").write_text(json.dumps(doc) + "\n")
    for _ in range(2):
        job.load_raw(spark, str(landing), wh, "run")
    raw = spark.read.parquet(f"{wh}/raw/bars")
    assert raw.count() == 1
    assert raw.where("__de_processed_at is null or ingest_date is null or __run_id <> 'run'").count() == 0
    (landing / "bars" / "two.json").write_text('{"symbol": "B", "results": [}\n')
    with pytest.raises(ValueError, match="1 landed lines are malformed"):
        job.load_raw(spark, str(landing), wh, "run")
    assert spark.read.parquet(f"{wh}/rejected/bars").collect()[0]["line"].startswith('{"symbol": "B"')
    assert spark.read.parquet(f"{wh}/raw/bars").count() == 1


def test_path_of_another_form_decodes_to_null(spark, tmp_path):
    (tmp_path / "part-0.json").write_text('{"symbol": "A"}\n')
    row = with_landing_path(spark.read.schema("symbol string").json(str(tmp_path))).first()
    assert row["landing_start"] is None and row["landed_at"] is None and row["landing_source"] is None


def test_date_missing_from_the_calendar_gets_no_key(spark):
    columns = ["symbol", "source", "price_date", "close_price", "open_price", "high_price", "low_price", "volume", "market_cap", "__run_id", "__de_processed_at"]
    days = [dt.date(2025, 1, d) for d in (3, 4, 6)]
    rows = [("A", "bars", d, 1.0, 1.0, 1.0, 1.0, 1.0, None, "r", AT) for d in days]
    kinds = ["string", "string", "date", *["double"] * 6, "string", "timestamp"]
    sources = spark.createDataFrame(rows, ", ".join(f"{c} {k}" for c, k in zip(columns, kinds)))
    assets = spark.createDataFrame([("A", "stock")], "symbol string, asset_type string")
    dates = spark.createDataFrame([(days[0],), (days[2],)], "date_key date")
    got = {r["price_date"]: r["date_key"] for r in fact_daily_prices(sources, assets, dates).collect()}
    assert got == {days[0]: days[0], days[1]: None, days[2]: days[2]}
