"""SNK1, SRC4: landed files under decodable paths; a failed job leaves none."""

import os

import pytest
from pyspark.sql import functions as F

from tidemark.sources.landing import with_landing_path
from tidemark.sources.landing_sink import land_documents

DOC = "symbol string, fetch_start string, fetch_end string, n int, at string"


def docs(spark, rows):
    return spark.createDataFrame(rows, DOC).withColumn("__de_processed_at", F.col("at").cast("timestamp")).drop("at")


def files(root):
    return sorted(os.path.relpath(os.path.join(d, f), root) for d, _, names in os.walk(root) for f in names if not f.startswith("."))


def test_round_trip_and_paths(spark, tmp_path):
    root = str(tmp_path / "l")
    rows = [("A", "2025-01-01", "2025-01-31", i, "2025-02-01 06:00:01") for i in range(3)]
    rows += [(s, "2025-01-01", "2025-01-02", 9, "2025-02-01 06:00:01") for s in ("C:EUR/USD", "sp ace", "a+b", "100%", "é")]
    land_documents(docs(spark, rows).repartition(4), root, "bars")
    assert "bars/A/2025-01-01_2025-01-31_20250201T060001.json" in files(root)
    assert len(files(root)) == 6 and not any("_staging/" in f for f in files(root))
    back = spark.read.schema("symbol string, fetch_start string, fetch_end string, n int").option("recursiveFileLookup", "true").json(f"{root}/bars")
    got = with_landing_path(back).select("symbol", "landing_source", "landing_id", F.col("landing_start").cast("string"), F.col("landing_end").cast("string"), F.date_format("landed_at", "HHmmss"), "n").collect()
    assert sorted(map(tuple, got)) == sorted((s, "bars", s, a, b, "060001", n) for s, a, b, n, _ in rows)
    # A later fetch is another file; the same one again changes nothing; another content for a landed path fails.
    land_documents(docs(spark, [("A", "2025-01-01", "2025-01-31", 5, "2025-03-01 06:00:01")]), root, "bars")
    land_documents(docs(spark, rows), root, "bars")
    assert len(files(root)) == 7
    with pytest.raises(Exception, match="another content"):
        land_documents(docs(spark, [("N", "2025-01-01", "2025-01-31", 1, "2025-03-01 06:00:01"), ("A", "2025-01-01", "2025-01-31", 6, "2025-03-01 06:00:01")]), root, "bars")
    assert len(files(root)) == 7


def test_failed_task_leaves_no_file(spark, tmp_path):
    root = str(tmp_path / "l")
    good = [(f"s{i}", "2025-01-01", "2025-01-31", i, "2025-02-01 06:00:00") for i in range(20)]
    with pytest.raises(Exception, match="can't land"):
        land_documents(docs(spark, good + [("x", None, "2025-01-31", 1, "2025-02-01 06:00:00")]), root, "bars")
    broken = docs(spark, good).withColumn("n", F.when(F.col("n") == 7, F.raise_error(F.lit("lost"))).otherwise(F.col("n")))
    with pytest.raises(Exception, match="lost"):
        land_documents(broken, root, "bars")
    assert files(root) == []
    land_documents(docs(spark, []), root, "bars")
    land_documents(docs(spark, good), root, "bars")
    assert len(files(root)) == 20
