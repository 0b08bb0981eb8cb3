"""Session settings the operators rely on, and the shared scratch folder.

Every operator is a lazy DataFrame -> DataFrame function, so the only session
state that changes results is the time zone (dates are derived from UTC
instants) and ANSI mode (division guards are written for it).
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings that change results or plans; applied to any session we are handed.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the library depends on to an existing session."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(
    master: str | None = None,
    app_name: str = "tidemark",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library settings.

    On a cluster leave ``master`` unset and let spark-submit decide; size
    ``shuffle_partitions`` to the data (about 128-256 MB per shuffle partition)
    and let AQE coalesce the small ones.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(RUNTIME_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    # Remove reliable-checkpoint files once their DataFrames are garbage collected.
    conf["spark.cleaner.referenceTracking.cleanCheckpoints"] = "true"
    conf["spark.sql.execution.arrow.pyspark.enabled"] = "true"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    return configure(spark)


def ship(spark: SparkSession) -> None:
    """Send this package to the workers, once a context: operators that run Python in tasks need it there."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        return
    if getattr(sc, "_tidemark_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    # Code only, read by the driver's own file server.
    out = os.path.join(tempfile.mkdtemp(prefix="tidemark-"), "tidemark-package.zip")
    with zipfile.ZipFile(out, "w") as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(out)
    sc._tidemark_shipped = True


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is a path every executor can reach (HDFS, object store).
    Only when the setting is absent (local tests) do we set our own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        sc = None
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        if sc is not None and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = os.path.join("/tmp", "tidemark-checkpoints")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared scratch root for one run."""
    return f"{scratch_root(spark).rstrip('/')}/tidemark/{name}-{uuid.uuid4().hex}"
