"""Session settings, durable intermediate tables and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from math import ceil

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


SHUFFLE_BYTES = 128 * 1024**2

_WORKSPACE: ContextVar[str | None] = ContextVar("workspace", default=None)


def configure(
    spark: SparkSession, time_zone: str = "UTC", input_bytes: int | None = None
) -> SparkSession:
    """Set what the operators rely on: one explicit zone for dates, and AQE.

    AQE merges small shuffle partitions but does not add any, so for a large log
    ``input_bytes`` sets how many it starts from, in proportion.
    """
    if input_bytes is not None:
        at_least = int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.conf.set(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
            str(max(at_least, ceil(input_bytes / SHUFFLE_BYTES))),
        )
    spark.conf.set("spark.sql.session.timeZone", time_zone)
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def stored_bytes(df: DataFrame) -> int:
    """Bytes of the files behind a plain scan, from their listing; starts no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Where the setting is missing, a local session gets a folder of its own;
    a cluster must name one, as no machine-local folder is visible to all.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by the cluster")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="stayline-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder, or in the current :func:`workspace`, that no other run uses."""
    return f"{_WORKSPACE.get() or shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def workspace(spark: SparkSession) -> Iterator[str]:
    """A folder of its own for all tables stored meanwhile; it is deleted in the end.

    What is to stay has to be written elsewhere before.
    """
    folder = scratch_path(spark, "work")
    token = _WORKSPACE.set(folder)
    try:
        yield folder
    finally:
        _WORKSPACE.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there.

    For tables that several later steps read: what made them is computed once, and a lost
    executor costs re-reading files instead. They stay until the folder is cleared, unless they
    are stored inside a :func:`workspace`.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
