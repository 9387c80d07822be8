"""Checkpoints, text batches and connected components for the operators here."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegrid.session import shared_dir


# Whole texts are some KB to some 100 KB; Spark's 10,000 rows make batches that
# the JVM and the worker both hold, several times over.
_ROWS_PER_BATCH = 2000


def prepare_workers(spark: SparkSession) -> None:
    """Let the session send whole texts to Python in batches of fewer rows, and
    let workers find this package where the driver has it. On a cluster without
    it in that place, submit it with ``--py-files``."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", _ROWS_PER_BATCH)
    root = str(Path(__file__).resolve().parents[2])
    variables = spark.sparkContext.environment
    paths = [path for path in variables.get("PYTHONPATH", "").split(os.pathsep) if path]
    if root not in paths:
        variables["PYTHONPATH"] = os.pathsep.join([*paths, root])


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the folder that all executors share."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def slices_by_bytes(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Start and length of runs of rows with about ``most`` bytes of text; a
    longer text is a run by itself."""
    start, held = 0, 0
    for row, size in enumerate(pa.compute.binary_length(texts).to_pylist()):
        size = size or 0
        if row > start and held + size > most:
            yield start, row - start
            start, held = row, 0
        held += size
    if len(texts) > start:
        yield start, len(texts) - start


def _attached_minimum(edges: DataFrame) -> DataFrame:
    """Edges (a, b) with ``m``, the least of ``a`` and all its partners. The
    minima are stored first, so Spark may split the rows of a hub in the join."""
    least = checkpointed(edges.groupBy("a").agg(F.min("b").alias("m")))
    return edges.join(least.withColumn("m", F.least("a", "m")), "a")


def _summary(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """Least node reachable from each node of ``links`` (a, b).

    Alternates large-star and small-star steps (Kiveris et al., 2014), which
    keep the number of links and turn each component into a star about its
    least node. Returns (node, component); a node without a link is not listed.
    """
    edges = checkpointed(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before = _summary(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _attached_minimum(both).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        small = _attached_minimum(large)
        hung = small.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        edges = checkpointed(hung.unionByName(small.select("a", F.col("m").alias("b"))).distinct())
        after = _summary(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots).distinct()
