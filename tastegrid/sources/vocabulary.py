"""Label vocabularies as small lookup tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def vocabulary(spark: SparkSession, labels: Sequence[str], name: str = "genre") -> DataFrame:
    """``name`` and its index, from 0, in the order given."""
    return spark.createDataFrame([(label, i) for i, label in enumerate(labels)], f"{name} string, {name}_index int")


def outside_vocabulary(df: DataFrame, column: str, labels: Sequence[str] | DataFrame) -> DataFrame:
    """Values of ``column`` that the vocabulary lacks, with their row counts.
    The vocabulary is a list, or a table with a column of that name."""
    known = labels if isinstance(labels, DataFrame) else vocabulary(df.sparkSession, labels, column)
    known = known.select(column)
    counts = df.groupBy(column).agg(F.count("*").alias("row_count"))
    return counts.join(known, column, "left_anti")
