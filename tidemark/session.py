"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Every day boundary in the library is a UTC day.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

CHECKPOINT_DIR = "spark.checkpoint.dir"

_local_scratch: str | None = None
_hadoop: tuple | None = None


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    app_name: str = "tidemark", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share for intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local-mode session may fall back to a
    temporary folder of this machine.
    """
    global _local_scratch
    shared = spark.conf.get(CHECKPOINT_DIR, None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="tidemark-")
    return _local_scratch


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def folder(spark: SparkSession, path: str):
    """A path and its Hadoop file system, whichever store the path is on."""
    global _hadoop
    if _hadoop is None or _hadoop[0] is not spark.sparkContext:
        # Looked up once: by name each of them costs several calls into the JVM.
        _hadoop = spark.sparkContext, spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    place = _hadoop[1](path)
    return place, place.getFileSystem(_hadoop[2])


def listed(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that match a pattern; none if its folder does not exist."""
    place, files = folder(spark, pattern)
    return [str(status.getPath().toString()) for status in files.globStatus(place) or []]


def data_files(spark: SparkSession, path: str) -> dict[str, int]:
    """Data files below a folder by their path inside it, with their sizes."""
    place, files = folder(spark, path)
    if not files.exists(place):
        return {}
    start = len(files.makeQualified(place).toString()) + 1
    found, walk = {}, files.listFiles(place, True)
    while walk.hasNext():
        status = walk.next()
        inside = status.getPath().toString()[start:]
        if not inside.rsplit("/", 1)[-1].startswith(("_", ".")):
            found[inside] = status.getLen()
    return found


@contextmanager
def materialized(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> Iterator[DataFrame]:
    """Write ``df`` once to the shared folder and hand back the written table.

    For plans that several later jobs read: the work behind ``df`` runs once, survives executor
    loss, and the reader gets columnar pruning and true sizes. The table is dropped on exit.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.partitionBy(*partition_by).parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        place, files = folder(spark, path)
        files.delete(place, True)
