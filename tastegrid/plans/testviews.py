"""The test tables read as ratings data.

A line item is a rating of a part by the customer of its order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Declared, so that opening a table needs no job that reads file footers.
SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_quantity double, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string",
    "customer": "c_custkey bigint, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The columns of a test table that the views use."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _epoch_seconds(column: str) -> Column:
    """Seconds since 1970 of a zone-free timestamp, whatever the session zone."""
    days = F.unix_date(F.to_date(column)).cast("bigint")
    return days * 86400 + F.hour(column) * 3600 + F.minute(column) * 60 + F.second(column)


def _rating(column: str) -> Column:
    return ((F.col(column).cast("bigint") - 1) % 5 + 1).cast("int")


def item_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings without their user. Line items alone hold these columns, so
    queries about items need no join with orders."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(F.col("l_partkey").alias("item_id"), _rating("l_quantity").alias("rating"))


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        _rating("l_quantity").alias("rating"),
        _epoch_seconds("l_shipdate").alias("ts"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title"), F.split("p_name", " ").alias("genres")
    )


# Most words that part names may be made of; the category operators hold a
# counter for each.
MOST_WORDS = 64


def words(spark: SparkSession, sf_dir: str) -> tuple[str, ...]:
    """The words that part names are made of, in name order: the categories."""
    names = table(spark, sf_dir, "part").select(F.explode(F.split("p_name", " ")).alias("word"))
    found = [row.word for row in names.distinct().orderBy("word").limit(MOST_WORDS + 1).collect()]
    if len(found) > MOST_WORDS:
        raise ValueError(f"part names are made of more than {MOST_WORDS} words")
    return tuple(found)


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles; the account balance stands in for the age."""
    nations = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("nation"))
    customers = table(spark, sf_dir, "customer")
    return customers.join(nations, customers.c_nationkey == nations.n_nationkey).select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_mktsegment").alias("occupation"),
        F.col("c_acctbal").alias("balance"),
        "nation",
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User events in input order; ``event_id`` is the position."""
    return table(spark, sf_dir, "events")
