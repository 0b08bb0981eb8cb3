"""ST1, ST2: late, replayed and out-of-order landed files give what the batch gives."""

import datetime as dt
import json
import os
import random

import pytest

from tidemark.operators.staging import stage_bars
from tidemark.schemas import RAW_BARS
from tidemark.sources.commits import committed, folders
from tidemark.streaming import landing_stream as ls

DAY_MS = 86_400_000


def land(folder, name, docs):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.json", "w") as f:
        for symbol, hour, points in docs:
            results = [{"timestamp": t, "open": v, "high": v, "low": v, "close": v, "volume": v} for t, v in points]
            at = (dt.datetime(2025, 1, 1) + dt.timedelta(hours=hour)).isoformat() + "Z"
            f.write(json.dumps({"symbol": symbol, "fetch_start": None, "fetch_end": None, "results": results, "__de_processed_at": at, "__run_id": f"r{hour}"}) + "\n")


def documents(rng, n):
    """Fetches of overlapping days in any order of ingestion; some have two points of one day, zeros, or the same ingestion time."""
    out = []
    for _ in range(n):
        first = rng.randrange(12)
        points = [(20_000 * DAY_MS + d * DAY_MS + rng.choice([0, 1, 3_600_000]), rng.choice([0.0, 1.0, 2.5, 9.0])) for d in range(first, first + rng.randint(0, 6)) for _ in range(rng.choice([1, 1, 2]))]
        out.append((rng.choice("ABC"), rng.randrange(6), points))
    return out


def content(df):
    return sorted(map(tuple, df.select("symbol", "price_date", "open_price", "close_price", "volume", "__de_processed_at", "__run_id").collect()), key=repr)


def batch(spark, landing):
    return content(stage_bars(spark.read.schema(RAW_BARS).json(landing)))


def logged(spark, log):
    return content(ls.read_log(spark, log))


@pytest.fixture
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_stream_equals_batch_with_late_replayed_and_unordered_files(spark, tmp_path, few_partitions):
    rng = random.Random(6)
    landing, log, ckpt, staging = (str(tmp_path / n) for n in ("landing", "stg_log", "ckpt", "stg"))
    for k in range(3):
        land(landing, f"f{k}", documents(rng, 5))
    ls.log_bars_stream(spark, landing, log, ckpt, max_files_per_trigger=1)
    assert logged(spark, log) == batch(spark, landing)

    # Later files with earlier and with equal ingestion times; state of an arrival period of a moment is gone by now.
    for k in range(3, 5):
        land(landing, f"f{k}", documents(rng, 5))
    ls.log_bars_stream(spark, landing, log, ckpt, max_files_per_trigger=1, period="1 second", delay="0 seconds")
    assert logged(spark, log) == batch(spark, landing)

    # The last micro-batch is run again, as after a crash before its commit.
    last = max((n for n in os.listdir(f"{ckpt}/commits") if n.isdigit()), key=int)
    os.remove(f"{ckpt}/commits/{last}")
    crc = f"{ckpt}/commits/.{last}.crc"
    if os.path.exists(crc):
        os.remove(crc)
    ls.log_bars_stream(spark, landing, log, ckpt, max_files_per_trigger=1, period="1 second", delay="0 seconds")
    assert logged(spark, log) == batch(spark, landing)

    # An epoch that was not committed does not count.
    part = committed(spark, log, ls.EPOCH)[0].removeprefix("file:")
    half = f"{log}/{ls.EPOCH}=000000000999"
    os.makedirs(half)
    name = next(n for n in os.listdir(part) if n.endswith(".parquet"))
    with open(f"{part}/{name}", "rb") as a, open(f"{half}/{name}", "wb") as b:
        b.write(a.read())
    assert not folders(spark, log, ls.EPOCH)[f"file:{half}"]
    assert logged(spark, log) == batch(spark, landing)

    # Published and folded; then more arrives, and a publication is run twice.
    ls.publish(spark, log, staging)
    assert content(spark.read.parquet(staging)) == batch(spark, landing) == logged(spark, log)
    assert len(committed(spark, log, ls.EPOCH)) == 1
    land(landing, "f9", documents(rng, 6))
    ls.log_bars_stream(spark, landing, log, ckpt)
    folded = ls.compact
    ls.compact = lambda *a, **k: None
    try:
        ls.publish(spark, log, staging)
    finally:
        ls.compact = folded
    ls.publish(spark, log, staging)
    assert content(spark.read.parquet(staging)) == batch(spark, landing) == logged(spark, log)


def test_update_mode_gives_out_changed_keys_only(spark, tmp_path, few_partitions):
    landing, log, ckpt = (str(tmp_path / n) for n in ("landing", "log", "ckpt"))
    land(landing, "a", [("A", 3, [(20_000 * DAY_MS, 1.0), (20_001 * DAY_MS, 1.0)])])
    ls.log_bars_stream(spark, landing, log, ckpt)
    land(landing, "b", [("A", 1, [(20_000 * DAY_MS, 5.0)]), ("A", 4, [(20_001 * DAY_MS + 5, 7.0)])])
    ls.log_bars_stream(spark, landing, log, ckpt)
    rows = spark.read.parquet(log).where("close_price = 7.0").collect()
    assert len(rows) == 1
    assert [r[3] for r in logged(spark, log)] == [1.0, 7.0]
