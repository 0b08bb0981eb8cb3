"""A3, A4, J10, PF8: bounds of a stored column from file statistics.

The least and greatest value of a column are in every parquet file's footer.
Spark's parquet reader of the second data source API takes them from there
when an aggregate without a filter asks for nothing else, so no data page is
read, however long the history is.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

V1_SOURCES = "spark.sql.sources.useV1SourceList"
PUSH_DOWN = "spark.sql.parquet.aggregatePushdown"
# Types whose bounds a parquet footer holds exactly.
BOUNDED_TYPES = ("date", "int", "bigint", "smallint", "tinyint", "boolean")


@contextmanager
def _footers(spark: SparkSession) -> Iterator[None]:
    before = {k: spark.conf.get(k) for k in (V1_SOURCES, PUSH_DOWN)}
    spark.conf.set(V1_SOURCES, ",".join(s for s in before[V1_SOURCES].split(",") if s != "parquet"))
    spark.conf.set(PUSH_DOWN, "true")
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def bounds_frame(spark: SparkSession, path: str, column: str) -> DataFrame:
    """One row (low, high) of a stored column; to be built and run while the settings of ``_footers`` hold."""
    table = spark.read.parquet(path)
    kind = table.schema[column].dataType.simpleString()
    if kind not in BOUNDED_TYPES:
        raise ValueError(f"file statistics do not bound a column of type {kind}")
    return table.agg(F.min(column).alias("low"), F.max(column).alias("high"))


def stored_bounds(spark: SparkSession, path: str, column: str) -> tuple:
    """(least, greatest) value of ``column`` in the parquet table at ``path``; (None, None) if it has none.

    A file without statistics of the column (one that holds only nulls, say) makes Spark refuse; then the
    column is read.
    """
    with _footers(spark):
        frame = bounds_frame(spark, path, column)
        try:
            row = frame.first()
        except Exception as refusal:  # noqa: BLE001 - whichever error class wraps it
            if "No min/max found" not in str(refusal):
                raise
            row = None
    if row is None:
        row = bounds_frame(spark, path, column).first()
    return row["low"], row["high"]
