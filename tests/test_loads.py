"""SNK2, SRC3: a landed file is loaded exactly once, whatever fails in between."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tidemark.plans import job
from tidemark.sources.commits import committed
from tidemark.sources.landing import LOAD, load_once, read_raw, read_raw_since


def land_bar(landing, name, symbol):
    os.makedirs(f"{landing}/bars", exist_ok=True)
    point = {"timestamp": 1735689600000, "open": 1.0, "high": 1.0, "low": 1.0, "close": 1.0, "volume": 1.0}
    doc = {"symbol": symbol, "fetch_start": None, "fetch_end": None, "results": [point], "__de_processed_at": "2025-01-02T06:00:00Z", "__run_id": None}
    with open(f"{landing}/bars/{name}.json", "w") as f:
        f.write(json.dumps(doc) + "\n")


def land_chart(landing, name, coin):
    os.makedirs(f"{landing}/chart", exist_ok=True)
    doc = {"coin_id": coin, "vs_currency": "usd", "fetch_start": None, "fetch_end": None, "raw_json": "{}", "__de_processed_at": "2025-01-02T06:00:00Z", "__run_id": None}
    with open(f"{landing}/chart/{name}.json", "w") as f:
        f.write(json.dumps(doc) + "\n")


def loaded(spark, wh, source, key):
    return sorted(r[0] for r in read_raw(spark, f"{wh}/raw/{source}").select(key).collect())


def test_failure_between_the_sources_leaves_no_duplicate(spark, tmp_path, monkeypatch):
    landing, wh = str(tmp_path / "landing"), str(tmp_path / "wh")
    land_bar(landing, "a", "A")
    land_chart(landing, "c", "coin")
    real = job.load_once

    def fails_on_chart(docs, path, *a, **kw):
        if path.endswith("chart"):
            raise RuntimeError("lost")
        return real(docs, path, *a, **kw)

    monkeypatch.setattr(job, "load_once", fails_on_chart)
    with pytest.raises(RuntimeError, match="lost"):
        job.load_raw(spark, landing, wh, "r1")
    land_bar(landing, "b", "B")  # more has landed when the run is done again
    monkeypatch.setattr(job, "load_once", real)
    job.load_raw(spark, landing, wh, "r2")
    job.load_raw(spark, landing, wh, "r3")
    assert loaded(spark, wh, "bars", "symbol") == ["A", "B"]
    assert loaded(spark, wh, "chart", "coin_id") == ["coin"]


def test_write_that_fails_half_way_does_not_count(spark, tmp_path):
    path = str(tmp_path / "raw")
    rows = [(f"s{i}", f"f{i % 5}", "2025-01-02 00:00:00") for i in range(50)]
    docs = spark.createDataFrame(rows, "symbol string, __file string, at string").select("symbol", "__file", F.col("at").cast("timestamp").alias("__de_processed_at"))
    first = docs.where("__file < 'f2'")
    assert load_once(first, path) == 2
    # Files of an attempt that never committed: under its own id, and under an id of another set of files.
    for name in ("5-0000000000000000", "3-0123456789abcdef"):
        half = f"{path}/{LOAD}={name}"
        docs.withColumn("ingest_date", F.to_date("__de_processed_at")).write.partitionBy("ingest_date").parquet(half)
        os.remove(f"{half}/_SUCCESS")
    assert len(committed(spark, path, LOAD)) == 1
    assert read_raw(spark, path).count() == 20
    assert load_once(docs, path) == 3
    assert load_once(docs, path) == 0
    got = read_raw(spark, path)
    assert got.count() == 50 and got.select("symbol").distinct().count() == 50
    assert read_raw_since(spark, path, None).count() == 50


def test_the_same_load_again_replaces_what_it_left(spark, tmp_path):
    path = str(tmp_path / "raw")
    docs = spark.createDataFrame([("A", "f1"), ("B", "f2")], "symbol string, __file string").withColumn("__de_processed_at", F.lit("2025-01-02").cast("timestamp"))
    load_once(docs, path)
    part = committed(spark, path, LOAD)[0].removeprefix("file:")
    os.remove(f"{part}/_SUCCESS")  # as if the run had died before its commit
    with pytest.raises(ValueError, match="committed"):
        read_raw(spark, path)
    assert load_once(docs, path) == 2
    assert read_raw(spark, path).count() == 2 and committed(spark, path, LOAD)[0].removeprefix("file:") == part
