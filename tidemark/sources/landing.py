"""Landed files and raw tables: SRC1-5, SRC8, SRC10, SNK1, SNK2, SNK5.

Landing layout: ``<root>/<source>/<id>/<start>_<end>_<yyyyMMddTHHmmss>.json``,
newline-delimited JSON, one document per asset and fetch, never overwritten.
Raw tables: parquet, append-only, partitioned by ingestion day and sorted by
symbol inside each file (row-group min/max then skip other symbols).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.constants import REINGEST_OVERLAP_DAYS
from tidemark.plans.sizing import bounded_broadcast
from tidemark.schemas import RAW_BARS, RAW_CHART
from tidemark.session import scratch_path
from tidemark.sources.commits import folders, read_committed, remove

# Fixed value: the landing file name pattern <start>_<end>_<landed at>.json
LANDING_PATH_RE = r"([^/]+)/([^/]+)/(\d{4}-\d{2}-\d{2})_(\d{4}-\d{2}-\d{2})_(\d{8}T\d{6})\.json$"


def read_landed(
    spark: SparkSession, paths: str | Sequence[str], schema, mode: str = "PERMISSIVE", glob: str | None = None
) -> DataFrame:
    """SRC1/SRC2/SRC3: read landed JSON with a declared schema (no inference).

    ``paths`` is a folder or the explicit list of files a fetch produced.
    PERMISSIVE keeps going on a malformed line (fields become NULL); use
    FAILFAST in tests.
    """
    reader = spark.read.schema(schema).option("mode", mode)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if isinstance(paths, str):
        paths = [paths]
    return reader.json(list(paths))


def read_with_rejects(spark: SparkSession, paths: str | Sequence[str], schema) -> tuple[DataFrame, DataFrame]:
    """Landed documents with their file path, and the lines that are not documents of this schema.

    A malformed line never turns into a document of NULLs: it is in the second
    frame (file_path, line), and only there."""
    declared = T.StructType([*schema.fields, T.StructField("__line", T.StringType())])
    paths = [paths] if isinstance(paths, str) else list(paths)
    lines = spark.read.option("recursiveFileLookup", "true").text(paths).where(F.trim("value") != "")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__line"}
    docs = lines.select(F.from_json("value", declared, options).alias("d"), F.col("_metadata.file_path").alias("__file"))
    good = docs.where(F.col("d.__line").isNull()).select(*[F.col("d")[n].alias(n) for n in schema.names], "__file")
    return good, docs.where(F.col("d.__line").isNotNull()).select(F.col("__file").alias("file_path"), F.col("d.__line").alias("line"))


def read_raw_bars(spark: SparkSession, paths, mode: str = "PERMISSIVE") -> DataFrame:
    return read_landed(spark, paths, RAW_BARS, mode)


def read_raw_chart(spark: SparkSession, paths, mode: str = "PERMISSIVE") -> DataFrame:
    return read_landed(spark, paths, RAW_CHART, mode)


def with_landing_path(df: DataFrame) -> DataFrame:
    """SRC4: recover source, id, fetch window and landing time from the file path; NULL where the path is of another form."""
    p = F.col("_metadata.file_path")
    part = lambda i: F.nullif(F.regexp_extract(p, LANDING_PATH_RE, i), F.lit(""))
    day = lambda i: F.to_date(F.try_to_timestamp(part(i), F.lit("yyyy-MM-dd")))
    return df.withColumns(
        {
            "landing_source": part(1),
            "landing_id": F.coalesce(_unquoted(_unquoted(part(2))), part(2)),
            "landing_start": day(3),
            "landing_end": day(4),
            "landed_at": F.try_to_timestamp(part(5), F.lit("yyyyMMdd'T'HHmmss")),
        }
    )


def _unquoted(name: Column) -> Column:
    """A path's own percent signs stand for themselves in its URI, so a quoted name is quoted twice there."""
    return F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def with_audit(df: DataFrame, run_id: str, processed_at: Column | None = None) -> DataFrame:
    """SRC5: stamp ingestion time (UTC) and the run id; a row's own values are kept."""
    stamp = {"__de_processed_at": processed_at if processed_at is not None else F.current_timestamp(), "__run_id": F.lit(run_id)}
    return df.withColumns({c: F.coalesce(F.col(c), v) if c in df.columns else v for c, v in stamp.items()})


def fetch_window(df: DataFrame, start: str | dt.date, end: str | dt.date, column: str = "price_date") -> DataFrame:
    """SRC8: keep [start, end] (inclusive), pushed down to the scan when ``column`` is stored."""
    return df.where(F.col(column).between(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")))


def chart_window_start(end: str | dt.date) -> Column:
    """SRC8: the chart source always asks for the 365 days ending at ``end``."""
    return F.date_sub(F.lit(str(end)).cast("date"), 364)


def missing_assets(expected: DataFrame, loaded: DataFrame) -> DataFrame:
    """SRC10/J11: expected assets that have no loaded row.

    The loaded symbols are first reduced to those in the expected list
    (semi-join against the expected list, broadcast when its size is checked)
    and de-duplicated with a partial aggregate, so the anti-join sees at most
    one row per expected symbol."""
    exp_keys = expected.select("symbol")
    present = loaded.select("symbol").join(bounded_broadcast(exp_keys), "symbol", "left_semi").distinct()
    return expected.join(present, "symbol", "left_anti")


def refetch_plan(expected: DataFrame, loaded: DataFrame, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """SRC8/SRC10: what a run over [start, end] has to fetch: symbol, missing_from, missing_to, missing_days.

    One row for each longest stretch of days without a row of an expected
    asset; an asset without any has the whole window. Covered days are
    distinct by partial aggregation, and the day before the window and the day
    behind it stand as covered, so a stretch is the gap between a covered day and the
    next one. A window holds an asset's days, which the run's window bounds.
    """
    first, last = (F.lit(str(d)).cast("date") for d in (start, end))
    names = expected.select("symbol").distinct()
    days = fetch_window(loaded, start, end).select("symbol", "price_date")
    covered = days.join(bounded_broadcast(names), "symbol", "left_semi").distinct()
    edges = names.select("symbol", F.explode(F.array(F.date_sub(first, 1), F.date_add(last, 1))).alias("price_date"))
    following = F.lead("price_date").over(Window.partitionBy("symbol").orderBy("price_date"))
    gaps = covered.unionAll(edges).withColumn("__next", following).where(F.datediff("__next", "price_date") > 1)
    return gaps.select(
        "symbol",
        F.date_add("price_date", 1).alias("missing_from"),
        F.date_sub("__next", 1).alias("missing_to"),
        (F.datediff("__next", "price_date") - 1).cast("long").alias("missing_days"),
    )


def write_landing(docs: DataFrame, root: str, source: str) -> None:
    """SNK1: append landed documents as newline JSON under ``root/<source>/``.

    Appends never replace earlier files (each write adds new part files), and
    each document keeps its own id, window and audit fields, so the folder can
    be scanned by a batch read or picked up file by file by a stream."""
    docs.write.mode("append").json(f"{root.rstrip('/')}/{source}")


def append_raw(docs: DataFrame, table_path: str, id_column: str = "symbol") -> None:
    """SNK2: append to a raw table partitioned by ingestion day, clustered by id.

    A daily load is a single ingestion day; REBALANCE on the day lets AQE
    split that one hot partition over many writer tasks (and merge small
    ones) without a sampling pass, and files are sorted by id."""
    out = docs.withColumn("ingest_date", F.to_date("__de_processed_at"))
    (
        out.hint("rebalance", "ingest_date")
        .sortWithinPartitions("ingest_date", id_column)
        .write.mode("append")
        .partitionBy("ingest_date")
        .parquet(table_path)
    )


LOAD = "load"


def load_once(docs: DataFrame, table_path: str, id_column: str = "symbol", file_column: str = "__file") -> int:
    """SNK2, SRC3: append the documents of files that are not loaded yet, each file exactly once; the number of files.

    A load is one committed folder ``load=<id>`` (``sources.commits``). Its rows
    carry the file they came from, so the rows and the list of loaded files are one
    commit: a failure at any point leaves all of the files loaded or none. The id follows
    from the files, so the same load done again replaces what it left. One
    load of a table runs at a time.
    """
    spark = docs.sparkSession
    done = read_committed(spark, table_path, LOAD)
    if done is not None:
        docs = docs.join(done.select(F.col(file_column).alias("__done")).distinct(), F.col(file_column) == F.col("__done"), "left_anti")
    scratch = scratch_path(spark, "load")
    docs.write.parquet(scratch)  # landed files are read once
    batch = spark.read.schema(docs.schema).parquet(scratch)
    files = batch.select(file_column).distinct().agg(F.count("*").alias("n"), F.sum(F.xxhash64(file_column).cast("decimal(38,0)")).alias("h")).first()
    if files["n"]:
        rows = batch.withColumn("ingest_date", F.to_date("__de_processed_at"))
        path = f"{table_path.rstrip('/')}/{LOAD}={files['n']}-{int(files['h']) % 2**64:016x}"
        (
            rows.hint("rebalance", "ingest_date")
            .sortWithinPartitions("ingest_date", id_column)
            .write.mode("overwrite")
            .partitionBy("ingest_date")
            .parquet(path)
        )
    remove(spark, scratch)
    return files["n"]


def read_raw(spark: SparkSession, table_path: str) -> DataFrame:
    """A raw table: its committed loads, or all of it where it was written by ``append_raw``."""
    if not folders(spark, table_path, LOAD):
        return spark.read.parquet(table_path)
    rows = read_committed(spark, table_path, LOAD)
    if rows is None:
        raise ValueError(f"no load of {table_path} is committed")
    return rows.drop(LOAD)


def read_raw_since(
    spark: SparkSession, table_path: str, watermark: dt.datetime | None, overlap_days: int = REINGEST_OVERLAP_DAYS
) -> DataFrame:
    """SNK5: raw rows ingested after (watermark - overlap), strict ``>``.

    The watermark is the latest ingestion time already in the target. Besides
    the timestamp predicate (pushed to the parquet scan), an explicit
    predicate on the ``ingest_date`` partition column prunes whole folders:
    Spark does not derive it from the timestamp by itself. ``None`` (empty or
    missing target) means a full load.
    """
    raw = read_raw(spark, table_path)
    if watermark is None:
        return raw
    # A time without a zone is the driver's local time, as Spark hands it out.
    since = F.lit(watermark.astimezone(dt.timezone.utc)) - F.make_dt_interval(F.lit(overlap_days))
    return raw.where((F.col("ingest_date") >= F.to_date(since)) & (F.col("__de_processed_at") > since))


def export_json(df: DataFrame, path: str) -> None:
    """SNK9: newline-JSON export of a mart (one file per task, written in parallel)."""
    df.write.mode("overwrite").option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS 'UTC'").json(path)
