"""Profile lookups that answer for every id asked."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastegrid.sources.stored import read_ids


def lookup(profiles: DataFrame, ids: int | Sequence[int], key: str = "user_id") -> DataFrame:
    """Rows of one id or a list of ids. The ids reach the scan as a filter, so
    a table stored in key order reads only the row groups that can match."""
    asked = sorted({ids} if isinstance(ids, int) else set(ids))
    requested = profiles.sparkSession.createDataFrame([(i,) for i in asked], f"{key} bigint")
    return lookup_each(profiles.where(F.col(key).isin(asked)), requested, key)


def lookup_stored(
    spark: SparkSession, path: str, ids: int | str | Sequence[int | str], key: str = "user_id", schema: T.StructType | None = None
) -> DataFrame:
    """``lookup`` in a stored table; with a manifest, only the files whose keys
    can match are opened."""
    asked = sorted({ids} if isinstance(ids, (int, str)) else set(ids))
    rows = read_ids(spark, path, key, asked, schema)
    kind = rows.schema[key].dataType.simpleString()
    return lookup_each(rows, spark.createDataFrame([(i,) for i in asked], f"{key} {kind}"), key)


def lookup_each(profiles: DataFrame, requested: DataFrame, key: str = "user_id") -> DataFrame:
    """Every requested id with its profile rows, or one row with ``found`` false."""
    hits = profiles.withColumn("found", F.lit(True))
    return (
        requested.select(key)
        .distinct()
        .join(hits, key, "left")
        .withColumn("found", F.coalesce("found", F.lit(False)))
    )
