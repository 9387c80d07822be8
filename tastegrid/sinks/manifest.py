"""Manifests of keyed tables: the range of keys that each file holds.

The manifest lies in the table's folder, under a name that plain reads of the
folder pass over, and has one row per file. A lookup opens only the files that
can hold an id; a merge rewrites only the files that its keys fall into.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastegrid.operators.ranking import first_per_key, stored_in_order
from tastegrid.session import pin, remove_path, scratch
from tastegrid.sinks.tables import replace_table, swap_in
from tastegrid.sources.stored import manifest_path, path_exists, read_keyed, read_manifest


def key_ranges(spark: SparkSession, folder: str, schema: T.StructType, key: Sequence[str]) -> DataFrame:
    """(file, rows, least, most) of the files in ``folder``; reads the keys only."""
    keys = F.struct(*[F.col(name) for name in key])
    stored = spark.read.schema(schema).parquet(folder).select(keys.alias("_key"), "_metadata.file_name")
    return stored.groupBy(F.col("file_name").alias("file")).agg(
        F.count("*").alias("rows"), F.min("_key").alias("least"), F.max("_key").alias("most")
    )


def replace_keyed(df: DataFrame, path: str, key: Sequence[str], newest_first: Sequence[Column] = ()) -> None:
    """``replace_table`` with a manifest, which is swapped in with the rows."""

    def manifest(fresh: str) -> None:
        ranges = key_ranges(df.sparkSession, fresh, df.schema, key)
        ranges.write.parquet(manifest_path(fresh))

    replace_table(df, path, key, newest_first, also=manifest)


def _with_file(rows: DataFrame, files: DataFrame, key: Sequence[str]) -> DataFrame:
    """``rows`` with ``_file``, the last file that starts at or before their key.

    Starts and rows are sorted together by ranges; a row takes the last start
    before it in its stored partition, or else that of an earlier partition.
    Rows before all starts take the first file; without files it is null.
    """
    starts = files.select(*[F.col("least")[name].alias(name) for name in key], F.col("file").alias("_file"))
    both = rows.withColumn("_file", F.lit(None).cast("string")).unionByName(starts, allowMissingColumns=True)
    slots = stored_in_order(both, [*key, F.desc_nulls_last("_file")])
    before = Window.partitionBy("_part").orderBy("_slot").rowsBetween(Window.unboundedPreceding, 0)
    found = slots.withColumn("_start", F.last("_file", ignorenulls=True).over(before)).where("_file IS NULL")
    ends = slots.groupBy("_part").agg(
        F.max_by("_file", F.when(F.col("_file").isNotNull(), F.col("_slot"))).alias("_end")
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("_part", F.last("_end", ignorenulls=True).over(earlier).alias("_carried"))
    first = files.agg(F.min_by("file", "least").alias("_least"))
    return (
        found.join(F.broadcast(carried), "_part")
        .withColumn("_file", F.coalesce("_start", "_carried", first.scalar()))
        .drop("_start", "_carried", "_part", "_slot")
    )


def merge_keyed(changes: DataFrame, path: str, key: Sequence[str], newest_first: Sequence[Column]) -> None:
    """Put ``changes`` into the keyed table at ``path``.

    Of changes with one key the newest stays, and it replaces the stored row of
    that key; other stored rows stay. Only files that a changed key falls into
    are read and written again, the others stay byte for byte. Null keys are
    keys like others, and columns go by name. Without a table, one is written.

    Readers by the manifest find the old table or the new one, as with
    ``swap_in``; plain readers of the folder may meet rows twice until the
    replaced files are gone. Files that a broken merge left are removed by the
    next one. The driver gets the names of the files to read, not their rows.
    """
    spark = changes.sparkSession
    if not path_exists(spark, manifest_path(path)):
        if path_exists(spark, path):
            raise ValueError(f"{path} has no manifest; write it with replace_keyed first")
        replace_keyed(changes, path, key, newest_first)
        return
    with scratch(spark):
        files = pin(read_manifest(spark, path))
        kept_names = {row.file for row in files.select("file").toLocalIterator()}
        _remove_unlisted(spark, path, kept_names)
        latest = first_per_key(changes, key, newest_first)
        placed = pin(_with_file(latest, files, key))
        touched = [row[0] for row in placed.select("_file").distinct().toLocalIterator() if row[0] is not None]
        merged = placed.drop("_file").withColumn("_stored", F.lit(0))
        if touched:
            old = read_keyed(spark, path, files=touched).withColumn("_stored", F.lit(1))
            merged = first_per_key(old.unionByName(merged), key, [F.col("_stored")])
        staged = f"{path.rstrip('/')}/_staged-{uuid.uuid4().hex}"
        try:
            rows = merged.drop("_stored").repartitionByRange(*key).sortWithinPartitions(*key)
            rows.write.parquet(staged)
            fresh = pin(key_ranges(spark, staged, rows.schema, key))
            _move_files(spark, staged, path, [row.file for row in fresh.select("file").toLocalIterator()])
        finally:
            remove_path(spark, staged)
        gone = spark.createDataFrame([(name,) for name in touched], "file string")
        now = files.join(gone, "file", "left_anti").unionByName(fresh)
        swap_in(spark, manifest_path(path), now.write.parquet)
        for name in touched:
            remove_path(spark, f"{path.rstrip('/')}/{name}")


def _move_files(spark: SparkSession, source: str, target: str, names: Sequence[str]) -> None:
    to_path = spark._jvm.org.apache.hadoop.fs.Path
    system = to_path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    for name in names:
        if not system.rename(to_path(source, name), to_path(target, name)):
            raise RuntimeError(f"could not move {name} to {target}")


def _remove_unlisted(spark: SparkSession, path: str, listed: set[str]) -> None:
    """Removes data files that the manifest does not have."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    for status in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder):
        name = status.getPath().getName()
        if status.isFile() and name.endswith(".parquet") and name not in listed:
            remove_path(spark, f"{path.rstrip('/')}/{name}")
