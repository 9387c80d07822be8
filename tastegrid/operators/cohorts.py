"""User subsets and the items they rate best."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegrid.operators.ranking import salted_join


def users_below(users: DataFrame, limit: float, column: str = "age") -> DataFrame:
    """Strictly below ``limit``."""
    return users.where(F.col(column) < limit)


def users_of_group(users: DataFrame, occupation: str, low: float, high: float, column: str = "age") -> DataFrame:
    """One occupation, ``column`` within both bounds inclusive."""
    wanted = (F.col("occupation") == occupation) & F.col(column).between(low, high)
    return users.where(wanted)


def by_column(users: DataFrame, column: str = "age") -> DataFrame:
    """For showing: by ``column``, then id."""
    return users.orderBy(column, "user_id")


def ratings_of(ratings: DataFrame, users: DataFrame) -> DataFrame:
    """Ratings by any of ``users``, each rating once."""
    return salted_join(ratings, users.select("user_id"), "user_id", "item_id", "left_semi")


def cohort_top_items(
    ratings: DataFrame, users: DataFrame, items: DataFrame, min_support: int = 5, n: int = 10
) -> DataFrame:
    """Best items by the cohort's own unrounded mean."""
    per_item = ratings_of(ratings, users).groupBy("item_id")
    stats = per_item.agg(F.avg("rating").alias("avg_rating"), F.count("rating").alias("num_ratings"))
    return (
        stats.where(F.col("num_ratings") >= min_support)
        .join(items.select("item_id", "title"), "item_id")
        .select("item_id", "title", "avg_rating", "num_ratings")
        .orderBy(F.desc("avg_rating"), "item_id")
        .limit(n)
    )


def age_band(column: str, width: int) -> Column:
    return F.floor(F.col(column) / width)
