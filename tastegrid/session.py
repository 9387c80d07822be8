"""Session settings and the shared folder that long jobs keep data in."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime re-planning does the skew splitting and the size-checked broadcasts.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}

# Paths given out by fresh_path that have not been removed yet.
_made: list[str] = []


def build_session(app_name: str = "tastegrid", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or where that
    is unset the warehouse, which tables are shared through anyway."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return folder or spark.conf.get("spark.sql.warehouse.dir")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses. What is stored there
    goes with the ``scratch`` block around the call, or else when Python ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def remove_path(spark: SparkSession, path: str) -> None:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def _remove_from(spark: SparkSession, first: int) -> None:
    while len(_made) > first:
        remove_path(spark, _made.pop())


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes what is stored under fresh paths inside the block, also if it
    fails. Results that are still to be read must be written elsewhere."""
    first = len(_made)
    try:
        yield
    finally:
        _remove_from(spark, first)


@atexit.register
def _remove_rest() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None:
        _remove_from(spark, 0)


def pin(df: DataFrame) -> DataFrame:
    """Store ``df`` in the shared folder and read it back, so that all later
    uses see the same rows and a lost executor costs no recomputation. Columns
    are compressed, and each use reads only those it needs."""
    spark = df.sparkSession
    path = fresh_path(spark, "pinned")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
