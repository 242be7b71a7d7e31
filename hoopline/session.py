"""Session settings and the shared staging folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Splits the hot side of a sort-merge join even when the join's partitioning is used further up.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(app_name: str = "hoopline", **overrides: str) -> SparkSession:
    """A session with the settings above; the master and memory come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def staging_root(spark: SparkSession) -> str:
    """The folder shared by all executors that lineage-cutting tables are written to.

    It is the one the cluster names in ``spark.checkpoint.dir`` (or the context's checkpoint folder).
    Only a local session without either gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="hoopline-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


# Spark's switch for removing a command's shuffle files when it ends, instead of when the driver collects its garbage.
REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# The folders stored within each open ``stage_alone`` of a thread.
_OPEN = threading.local()


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Later plans start from files, so values that depend on task placement are fixed and a lost
    executor costs no recomputation of what lies upstream. Nothing reads the write's shuffle files again, so they go
    as it ends: of several steps, only the widest is on disk at a time.
    """
    spark = df.sparkSession
    path = f"{staging_root(spark)}/{label}-{uuid.uuid4().hex}"
    with _shuffles_removed(spark):
        df.write.mode("errorifexists").parquet(path)
    for made in getattr(_OPEN, "made", [])[-1:]:
        made.append(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_alone(make: Callable[[], DataFrame], label: str) -> DataFrame:
    """``stage`` what ``make`` returns, then delete the tables that ``make`` itself staged on the way to it."""
    _OPEN.made = [*getattr(_OPEN, "made", []), []]
    try:
        df = make()
    finally:
        made = _OPEN.made.pop()
    stored = stage(df, label)
    for path in made:
        _delete(stored.sparkSession, path)
    return stored


def discard(df: DataFrame) -> None:
    """Delete the stored table that ``df`` reads and nothing will read again; only a folder of the staging root is."""
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    root = path(staging_root(spark))
    root = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(root)
    # both as Hadoop writes them: file:/ and file:/// are one folder
    for folder in {path(f).getParent().toString() for f in df.inputFiles()}:
        if path(folder).getParent().toString() == root.toString():
            _delete(spark, folder)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(REMOVE_SHUFFLES, None)
    spark.conf.set(REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(REMOVE_SHUFFLES)
        else:
            spark.conf.set(REMOVE_SHUFFLES, before)
