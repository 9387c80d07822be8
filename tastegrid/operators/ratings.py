"""Item averages, supported top lists and the data profile.

Items are keyed by ``item_id``. Ratings are summed per item before titles are
joined, so the join moves one row per item instead of one per rating.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def item_stats(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("item_id").agg(
        F.round(F.avg("rating"), 4).alias("avg_rating"), F.count("rating").alias("rating_count")
    )


def item_averages(ratings: DataFrame, items: DataFrame) -> DataFrame:
    """Mean (4 places) and count of every rated item."""
    return (
        item_stats(ratings)
        .join(items.select("item_id", "title"), "item_id")
        .select("item_id", "title", "avg_rating", "rating_count")
    )


def best_first():
    return F.desc("avg_rating"), F.asc("item_id")


def top_of(averages: DataFrame, min_ratings: int = 10, n: int = 10) -> DataFrame:
    """The ``n`` best items among those with at least ``min_ratings`` ratings."""
    return averages.where(F.col("rating_count") >= min_ratings).orderBy(*best_first()).limit(n)


def with_rank(averages: DataFrame, n: int) -> DataFrame:
    """The ``n`` best with rank and constant partition key; ``n`` bounds the
    one partition of the window."""
    ranks = F.row_number().over(Window.orderBy(*best_first()))
    return averages.orderBy(*best_first()).limit(n).withColumn("rank", ranks).withColumn("partition_key", F.lit(1))


def top_items(ratings: DataFrame, items: DataFrame, min_ratings: int = 10, n: int = 10) -> DataFrame:
    return top_of(item_averages(ratings, items), min_ratings, n)


def ranked_top_items(ratings: DataFrame, items: DataFrame, min_ratings: int = 10, n: int = 10) -> DataFrame:
    return with_rank(item_averages(ratings, items).where(F.col("rating_count") >= min_ratings), n)


def grand_mean(averages: DataFrame) -> DataFrame:
    """Mean of item means, each item counting once."""
    return averages.agg(F.avg("avg_rating").alias("mean_avg_rating"))


def popularity_quality(averages: DataFrame) -> DataFrame:
    return averages.select("item_id", "rating_count", "avg_rating")


def data_profile(ratings: DataFrame, min_per_user: int = 20) -> DataFrame:
    """Sizes and limits in one row. Ratings are grouped by user and by item in
    one pass, and the groups counted, so that no distinct set is gathered."""
    groups = ratings.groupingSets([["user_id"], ["item_id"]], "user_id", "item_id").agg(
        (F.grouping("user_id") == 0).alias("is_user"),
        F.count("*").alias("n"),
        F.min("rating").alias("low"),
        F.max("rating").alias("high"),
    )
    return groups.agg(
        F.count_if("is_user").alias("users"),
        F.count_if(~F.col("is_user")).alias("items"),
        F.coalesce(F.sum(F.when(F.col("is_user"), F.col("n"))), F.lit(0)).alias("ratings"),
        F.min("low").alias("min_rating"),
        F.max("high").alias("max_rating"),
        F.count_if(F.col("is_user") & (F.col("n") < min_per_user)).alias("users_below_minimum"),
    )
