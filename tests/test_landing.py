"""Landed files and raw tables: SRC1-SRC5, SRC8, SNK1, SNK2, SNK5."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from tidemark.operators.staging import stage_bars
from tidemark.sources.landing import (
    append_raw,
    chart_window_start,
    fetch_window,
    read_raw_bars,
    read_raw_since,
    with_audit,
    with_landing_path,
    write_landing,
)


def _land(root, source, ident, start, end, stamp, doc):
    folder = os.path.join(root, source, ident)
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, f"{start}_{end}_{stamp}.json")
    with open(path, "w") as fh:
        fh.write(json.dumps(doc) + "\n")
    return path


def test_read_selected_files_and_decode_path(spark, tmp_path):
    root = str(tmp_path / "raw")
    doc = {"symbol": "AAPL", "fetch_start": "2025-03-06", "fetch_end": "2025-03-07",
           "results": [{"timestamp": 1741237200000, "open": 1.0, "high": 2.0, "low": 0.5, "close": 1.5, "volume": 10.0}],
           "__de_processed_at": "2025-03-07T12:56:24Z", "__run_id": "manual__1"}
    p1 = _land(root, "bars", "AAPL", "2025-03-06", "2025-03-07", "20250307T125624", doc)
    _land(root, "bars", "MSFT", "2025-03-06", "2025-03-07", "20250307T125700", {**doc, "symbol": "MSFT"})
    only_first = read_raw_bars(spark, [p1], mode="FAILFAST")          # SRC3: the fetch's own key list
    assert [r["symbol"] for r in only_first.collect()] == ["AAPL"]
    decoded = with_landing_path(read_raw_bars(spark, f"{root}/bars/*/*.json")).collect()
    by = {r["symbol"]: r for r in decoded}
    assert by["AAPL"]["landing_source"] == "bars" and by["AAPL"]["landing_id"] == "AAPL"
    assert by["AAPL"]["landing_start"] == dt.date(2025, 3, 6) and by["AAPL"]["landing_end"] == dt.date(2025, 3, 7)
    assert by["AAPL"]["landed_at"] == dt.datetime(2025, 3, 7, 12, 56, 24)
    assert stage_bars(only_first).first()["price_date"] == dt.date(2025, 3, 6)


def test_permissive_scan_survives_a_malformed_line(spark, tmp_path):
    path = tmp_path / "mixed.json"
    path.write_text('{"symbol": "A", "results": []}\n{not json\n')
    rows = read_raw_bars(spark, str(path)).collect()
    assert len(rows) == 2 and rows[0]["symbol"] == "A" and rows[1]["symbol"] is None


def test_audit_and_fetch_window(spark):
    df = spark.createDataFrame([(dt.date(2025, 1, d),) for d in range(1, 11)], "price_date date")
    stamped = with_audit(df, "run-7", F.lit(dt.datetime(2025, 2, 1)).cast("timestamp"))
    assert {r["__run_id"] for r in stamped.collect()} == {"run-7"}
    assert fetch_window(df, "2025-01-03", "2025-01-05").count() == 3
    start = spark.range(1).select(chart_window_start("2026-03-13").alias("s")).first()["s"]
    assert start == dt.date(2025, 3, 14)   # 365 days ending at the end date


def test_raw_append_partitioned_and_incremental_reread_prunes(spark, tmp_path):
    table = str(tmp_path / "raw_bars")
    schema = "symbol string, results array<struct<timestamp:bigint,open:double,high:double,low:double,close:double,volume:double>>, __de_processed_at timestamp, __run_id string"
    for day in (1, 5, 9):
        batch = spark.createDataFrame([("A", [], dt.datetime(2025, 1, day, 6), f"r{day}")], schema)
        append_raw(batch, table)
    assert sorted(os.listdir(table))[:3] == ["_SUCCESS", "ingest_date=2025-01-01", "ingest_date=2025-01-05"] or \
        {"ingest_date=2025-01-01", "ingest_date=2025-01-05", "ingest_date=2025-01-09"} <= set(os.listdir(table))
    since = read_raw_since(spark, table, dt.datetime(2025, 1, 8, 5))
    assert sorted(r["__run_id"] for r in since.collect()) == ["r5", "r9"]   # after watermark - 3 days
    boundary = read_raw_since(spark, table, dt.datetime(2025, 1, 8, 6))
    assert [r["__run_id"] for r in boundary.collect()] == ["r9"]            # strictly after
    jvm = spark._jvm
    plan = jvm.PythonSQLUtils.explainString(since._jdf.queryExecution(), "formatted")
    assert "PartitionFilters: [isnotnull(ingest_date" in plan and "ingest_date" in plan.split("PartitionFilters:")[1]
    assert read_raw_since(spark, table, None).count() == 3


def test_landing_write_appends(spark, tmp_path):
    root = str(tmp_path / "landing")
    docs = spark.createDataFrame([("A", "x")], "symbol string, payload string")
    write_landing(docs, root, "bars")
    write_landing(docs, root, "bars")
    assert spark.read.json(f"{root}/bars").count() == 2


def test_export_json_roundtrip(spark, tmp_path):
    from tidemark.sources.landing import export_json

    df = spark.createDataFrame(
        [("A", dt.date(2025, 1, 2), 1.5, dt.datetime(2025, 1, 3, 4, 5, 6))],
        "symbol string, price_date date, close_price double, updated timestamp",
    )
    out = str(tmp_path / "export")
    export_json(df, out)
    lines = [x for p in (tmp_path / "export").glob("part-*.json") for x in p.read_text().splitlines()]
    assert len(lines) == 1  # a task without rows may leave an empty file
    line = json.loads(lines[0])
    assert line["symbol"] == "A" and line["price_date"] == "2025-01-02" and line["close_price"] == 1.5
    assert line["updated"] == "2025-01-03 04:05:06.000000 UTC"
    back = spark.read.schema(df.schema.simpleString()[7:-1].replace(":", " ")).json(out)
    assert back.select("symbol", "price_date", "close_price").collect() == df.select("symbol", "price_date", "close_price").collect()


def test_job_loads_only_the_listed_landed_files(spark, tmp_path):
    from tidemark.plans.job import load_raw

    root = str(tmp_path / "landing")
    doc = {"symbol": "A", "results": [], "__de_processed_at": "2025-03-07T12:56:24Z"}
    p1 = _land(root, "bars", "A", "2025-03-06", "2025-03-07", "20250307T125624", doc)
    _land(root, "bars", "B", "2025-03-06", "2025-03-07", "20250307T125700", {**doc, "symbol": "B"})
    chart = {"coin_id": "c", "raw_json": "{}", "__de_processed_at": "2025-03-07T12:56:24Z"}
    c1 = _land(root, "chart", "c", "2025-03-06", "2025-03-07", "20250307T125624", chart)
    wh = str(tmp_path / "wh")
    load_raw(spark, root, wh, "run-1", bars_files=[p1], chart_files=[c1])
    assert [r["symbol"] for r in spark.read.parquet(f"{wh}/raw/bars").collect()] == ["A"]
    assert spark.read.parquet(f"{wh}/raw/chart").first()["__run_id"] == "run-1"
