"""ST1, ST2: landed documents -> staging with Structured Streaming.

The file source picks up new landed JSON files (declared schema, no
inference). A streaming aggregate keeps, in the state store, the newest row of
each (symbol, price_date) that arrived lately, and each micro-batch gives out
only the keys whose newest row changed (update mode). They are appended to a
log, one committed folder for each epoch; nothing that was written before is
read or written again. Reading the log takes the newest row per key.

Late data. An event-time watermark on the price date would drop a bar that is
corrected years later, which the batch load keeps. So the watermark is on the
time of arrival: rows are grouped by the period in which they arrive, which is
never behind the watermark, and the state of past periods is let go. A
correction of an old day, whenever it lands, is a new group; it goes to the log, and
there the order of rows (ingestion time, point, values) decides as in the batch. The
state store thus only saves writing rows that are not the newest; the result does not depend on
what it still holds, on the order of files, or on a batch being run again (its
epoch's folder is replaced).

``publish`` merges the keys of new epochs into the monthly staging table, once a
run instead of once a micro-batch, and ``compact`` folds the log into one folder.
``trigger(availableNow=True)`` processes everything landed so far in bounded
micro-batches and stops, which is the daily schedule of the reference.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.staging import BAR_ORDER, CHART_ORDER, bar_rows, chart_rows, latest_per_key
from tidemark.plans.upsert import month_partition, upsert
from tidemark.schemas import RAW_BARS, RAW_CHART
from tidemark.sources.commits import committed, read_committed, remove

KEYS = ["symbol", "price_date"]
EPOCH, FOLDED = "epoch", "-folded"
ARRIVAL_PERIOD, ARRIVAL_DELAY = "1 day", "1 hour"


def newest_of_period(rows: DataFrame, keys: Sequence[str], order: Sequence[str], period: str = ARRIVAL_PERIOD, delay: str = ARRIVAL_DELAY) -> DataFrame:
    """Streaming (or batch) aggregate: the newest row of each key among those that arrive in one period."""
    rest = [c for c in rows.columns if c not in keys and c not in order]
    arrived = rows.withColumn("__arrived", F.current_timestamp()).withWatermark("__arrived", delay)
    best = F.max(F.struct(*order, *rest)).alias("__best")
    return arrived.groupBy(*keys, F.window("__arrived", period)).agg(best).select(*keys, "__best.*")


def log_stream(
    spark: SparkSession,
    landing_dir: str,
    schema: StructType,
    rows: Callable[[DataFrame], DataFrame],
    order: Sequence[str],
    log_path: str,
    checkpoint_dir: str,
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
    period: str = ARRIVAL_PERIOD,
    delay: str = ARRIVAL_DELAY,
):
    """Start (and, with ``available_now``, finish) a landing -> log stream for one source: ``rows`` turns
    documents into rows, of which the newest by ``order`` for each key goes to the log."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    changed = newest_of_period(rows(reader.json(landing_dir)), KEYS, order, period, delay)

    def append(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{log_path}/{EPOCH}={epoch_id:012d}")

    writer = changed.writeStream.outputMode("update").foreachBatch(append).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query


def log_bars_stream(spark: SparkSession, landing_dir: str, log_path: str, checkpoint_dir: str, **kw):
    """Nested bar documents to a log."""
    return log_stream(spark, landing_dir, RAW_BARS, bar_rows, BAR_ORDER, log_path, checkpoint_dir, **kw)


def log_chart_stream(spark: SparkSession, landing_dir: str, log_path: str, checkpoint_dir: str, **kw):
    """Chart documents with a JSON payload to a log."""
    return log_stream(spark, landing_dir, RAW_CHART, chart_rows, CHART_ORDER, log_path, checkpoint_dir, **kw)


def _staged(stream, order: Sequence[str], spark: SparkSession, landing_dir: str, staging_path: str, checkpoint_dir: str, **kw):
    log_path = f"{staging_path.rstrip('/')}_log"
    query = stream(spark, landing_dir, log_path, checkpoint_dir, **kw)
    if kw.get("available_now", True):
        publish(spark, log_path, staging_path, order)
    return query


def stage_bars_stream(spark: SparkSession, landing_dir: str, staging_path: str, checkpoint_dir: str, **kw):
    """ST2 for nested bar documents: to the log ``<staging_path>_log``, and published when the run ends."""
    return _staged(log_bars_stream, BAR_ORDER, spark, landing_dir, staging_path, checkpoint_dir, **kw)


def stage_chart_stream(spark: SparkSession, landing_dir: str, staging_path: str, checkpoint_dir: str, **kw):
    """ST2 for chart documents with a JSON payload, as ``stage_bars_stream``."""
    return _staged(log_chart_stream, CHART_ORDER, spark, landing_dir, staging_path, checkpoint_dir, **kw)


def publish(spark: SparkSession, log_path: str, staging_path: str, order: Sequence[str] = BAR_ORDER) -> None:
    """Merge the newest rows of the keys in epochs that are not folded yet into the staging table, then fold them.

    Done again after a failure it changes nothing: the rows come from the whole log.
    """
    new = [p for p in committed(spark, log_path, EPOCH) if not p.endswith(FOLDED)]
    if not new:
        return
    keys = spark.read.parquet(*new).select(*KEYS).distinct()
    rows = read_log(spark, log_path, order).join(keys, KEYS, "left_semi").drop("price_ms")
    upsert(spark, staging_path, rows, KEYS, order[:1], month_partition("price_date"), sort_cols=KEYS)
    compact(spark, log_path, order)


def read_log(spark: SparkSession, log_path: str, order: Sequence[str] = BAR_ORDER) -> DataFrame | None:
    """The newest row of each key over all committed epochs; None before the first one."""
    log = read_committed(spark, log_path, EPOCH)
    return None if log is None else latest_per_key(log.drop(EPOCH), KEYS, order)


def compact(spark: SparkSession, log_path: str, order: Sequence[str] = BAR_ORDER) -> None:
    """Fold all epochs into one folder.

    The folded rows are committed before the epochs go; in between both are
    read, and the newest row per key is the same. The folder is named after the last epoch it holds, behind
    which new epochs sort.
    """
    parts = committed(spark, log_path, EPOCH)
    if not parts or (len(parts) == 1 and parts[0].endswith(FOLDED)):
        return
    last = parts[-1].rsplit("=", 1)[1].removesuffix(FOLDED) + FOLDED
    rows = latest_per_key(spark.read.parquet(*parts), KEYS, order)
    rows.hint("rebalance", "symbol").sortWithinPartitions(*KEYS).write.mode("overwrite").parquet(f"{log_path}/{EPOCH}={last}")
    for part in parts:
        if not part.endswith(last):
            remove(spark, part)
