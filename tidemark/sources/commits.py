"""Folders that count once their write is committed.

A write goes to a folder of its own, ``<root>/<key>=<id>/``, whose ``_SUCCESS``
marker Spark puts there when the job commits. Readers take only marked folders,
so a write that failed half-way leaves nothing behind that counts, and
writing the same id again replaces what an earlier attempt left. Data and
whatever it says about itself (a column with the files it came from) are thus
committed in one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

MARKER = "_SUCCESS"


def _fs(spark: SparkSession, path: str):
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def folders(spark: SparkSession, root: str, key: str) -> dict[str, bool]:
    """The folders ``<key>=...`` below ``root`` and whether each is committed; none when ``root`` is absent."""
    fs, jroot = _fs(spark, root)
    if not fs.exists(jroot):
        return {}
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    found = {s.getPath().toString(): s.getPath() for s in fs.listStatus(jroot) if s.getPath().getName().startswith(f"{key}=")}
    return {name: bool(fs.exists(path(jpath, MARKER))) for name, jpath in sorted(found.items())}


def committed(spark: SparkSession, root: str, key: str) -> list[str]:
    return [name for name, done in folders(spark, root, key).items() if done]


def read_committed(spark: SparkSession, root: str, key: str, schema: StructType | None = None) -> DataFrame | None:
    """The rows of all committed folders, with ``key`` as a column; None if there are none."""
    paths = committed(spark, root, key)
    if not paths:
        return None
    reader = spark.read.option("basePath", root)
    return (reader.schema(schema) if schema is not None else reader).parquet(*paths)


def remove(spark: SparkSession, path: str) -> None:
    fs, jpath = _fs(spark, path)
    fs.delete(jpath, True)
