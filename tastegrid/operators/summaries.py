"""Distribution summaries of a column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OTHER = "Other"


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most first; rows without a value are not counted."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def value_counts_in_order(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, in value order; rows without a value are not counted."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).orderBy(column)


def top_k_and_other(counts: DataFrame, column: str, k: int = 6) -> DataFrame:
    """The ``k`` largest counts and the sum of the rest; empty lines drop out.

    ``column`` becomes a label, and a value that reads "Other" stays apart from
    the rest line. A count of rows without a value is no line and not in the
    rest. Only the ``k`` kept rows are broadcast.
    """
    counts = counts.where(F.col(column).isNotNull())
    kept = counts.orderBy(F.desc("n"), column).limit(k).select(column, F.lit(False).alias("is_rest"))
    labelled = counts.join(F.broadcast(kept), column, "left").select(
        F.coalesce("is_rest", F.lit(True)).alias("is_rest"), column, "n"
    )
    label = F.when(F.col("is_rest"), F.lit(OTHER)).otherwise(F.col(column).cast("string"))
    return (
        labelled.groupBy("is_rest", label.alias(column))
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") > 0)
        .orderBy("is_rest", F.desc("n"), column)
    )


def shares(counts: DataFrame, column: str, label_from: float = 1.0) -> DataFrame:
    """Percent of the total, one decimal, and a label for the larger ones."""
    total = counts.agg(F.sum("n")).scalar()
    with_share = counts.select(column, "n", F.round(100.0 * F.col("n") / total, 1).alias("pct"))
    return with_share.withColumn(
        "label", F.when(F.col("pct") >= label_from, F.format_string("%.1f%%", "pct"))
    )


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width bins between the smallest and largest value, the last one
    closed; empty bins are listed. If all values are equal, the range reaches
    half a unit to both sides. A value belongs to the bin whose printed edges
    enclose it, also where the division rounds across an edge. Nulls and NaN
    are in no bin."""
    values = df.select(F.col(column).cast("double").alias("x")).where("x IS NOT NULL AND NOT isnan(x)")
    low, high = values.agg(F.min("x")).scalar(), values.agg(F.max("x")).scalar()
    widen = F.when(F.col("low0") == F.col("high0"), F.lit(0.5)).otherwise(F.lit(0.0))

    def with_range(rows: DataFrame) -> DataFrame:
        ends = rows.select("*", low.alias("low0"), high.alias("high0"))
        return ends.withColumns({"low": F.col("low0") - widen, "high": F.col("high0") + widen}).drop("low0", "high0")

    def edge(i):
        inner = F.col("low") + i * ((F.col("high") - F.col("low")) / bins)
        return F.when(i == bins, F.col("high")).otherwise(inner)

    guess = F.floor((F.col("x") - F.col("low")) / (F.col("high") - F.col("low")) * bins)
    b = F.col("bin")
    moved = (
        F.when(F.col("x") < edge(b), b - 1)
        .when((b < bins - 1) & (F.col("x") >= edge(b + 1)), b + 1)
        .otherwise(b)
    )
    counts = (
        with_range(values)
        .withColumn("bin", F.least(guess, F.lit(bins - 1)))
        .select(moved.alias("bin"))
        .groupBy("bin")
        .agg(F.count("*").alias("n"))
    )
    frame = with_range(df.sparkSession.range(bins).withColumnRenamed("id", "bin"))
    return frame.join(counts, "bin", "left").select(
        b.cast("int").alias("bin"),
        edge(b).alias("bin_low"),
        edge(b + 1).alias("bin_high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    ).orderBy("bin")
