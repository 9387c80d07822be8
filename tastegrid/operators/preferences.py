"""Favourite category per user."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegrid.schemas import GENRES


# Labels that may have counters of their own, and rows in broadcasts by label.
MOST_LABELS = 1024


def item_categories(items: DataFrame) -> DataFrame:
    """One row per item and category; items without any are left out."""
    return items.select("item_id", "title", F.explode("genres").alias("genre"))


def active_users(ratings: DataFrame, min_ratings: int = 50) -> DataFrame:
    counts = ratings.groupBy("user_id").agg(F.count("*").alias("rating_count"))
    return counts.where(F.col("rating_count") >= min_ratings)


def category_counts(ratings: DataFrame, items: DataFrame) -> DataFrame:
    """Ratings per user and category; a rating counts once for each category of
    its item. The category array travels through the join and is exploded
    after it, right under the map-side count."""
    rated = ratings.join(items.select("item_id", "genres"), "item_id")
    per_category = rated.select("user_id", F.explode("genres").alias("genre"))
    return per_category.groupBy("user_id", "genre").agg(F.count("*").alias("genre_count"))


def _label_array(labels: Sequence[str]) -> Column:
    return F.lit(list(labels))


def with_flags(items: DataFrame, labels: Sequence[str], *keep: str) -> DataFrame:
    """``item_id``, the columns to ``keep``, and booleans ``is_0``, ``is_1``, …
    for the labels an item carries. A label outside the vocabulary stops the
    job, since it would be counted nowhere."""
    if len(labels) > MOST_LABELS:
        raise ValueError(f"{len(labels)} labels; favourite_of_many takes more than {MOST_LABELS}")
    known = _label_array(labels)
    places = F.transform("genres", lambda genre: F.array_position(known, genre))
    unknown = F.array_join(F.array_except("genres", known), ", ")
    problem = F.concat(F.lit("labels outside the vocabulary: "), unknown)
    checked = F.when(F.array_contains(places, F.lit(0)), F.raise_error(problem)).otherwise(places)
    flags = [f"array_contains(_places, {i + 1}) AS is_{i}" for i in range(len(labels))]
    return items.withColumn("_places", checked).selectExpr("item_id", *keep, *flags)


def with_favourite(per_user: DataFrame, counters: Sequence[str], labels: Sequence[str]) -> DataFrame:
    """Add the label with the largest counter, the first name among equals, its
    count and its place in ``labels``; users whose counters are zero drop out."""
    by_name = sorted(range(len(labels)), key=lambda i: labels[i])
    entries = [
        f"named_struct('genre_rating_count', {counters[i]}, 'minus_order', {-order}, 'label_index', {i})"
        for order, i in enumerate(by_name)
    ]
    best = per_user.withColumn("best", F.expr(f"array_max(array({', '.join(entries)}))"))
    return best.select(
        *per_user.columns,
        "best.genre_rating_count",
        "best.label_index",
        F.get(_label_array(labels), F.col("best.label_index")).alias("favorite_genre"),
    ).where("genre_rating_count > 0")


def favourite_category(
    ratings: DataFrame, items: DataFrame, min_ratings: int = 1, labels: Sequence[str] = GENRES
) -> DataFrame:
    """Most rated category of each user with at least ``min_ratings`` ratings;
    ties go to the first name.

    The activity test counts rating rows, also of items without category. With
    a known vocabulary each category is a counter of one aggregate by user:
    ratings are not multiplied by their categories, and a user who rates very
    much is one row per map task. From about a hundred labels on Spark leaves
    the counters out of its generated code: ``favourite_of_many`` is for those.
    """
    rated = ratings.select("user_id", "item_id").join(with_flags(items, labels), "item_id", "left")
    counters = [f"n_{i}" for i in range(len(labels))]
    per_user = rated.groupBy("user_id").agg(
        F.count("*").alias("rated"),
        *[F.expr(f"count_if(is_{i}) AS {name}") for i, name in enumerate(counters)],
    )
    active = per_user.where(F.col("rated") >= min_ratings)
    return with_favourite(active, counters, labels).select("user_id", "favorite_genre", "genre_rating_count")


def favourite_of_many(ratings: DataFrame, items: DataFrame, min_ratings: int = 1) -> DataFrame:
    """``favourite_category`` for a wide or unknown vocabulary: a row per user
    and category instead of a counter."""
    best = (
        category_counts(ratings, items)
        .groupBy("user_id")
        .agg(F.min(F.struct((-F.col("genre_count")).alias("less"), "genre")).alias("best"))
    )
    return best.join(active_users(ratings, min_ratings), "user_id").select(
        "user_id", F.col("best.genre").alias("favorite_genre"), (-F.col("best.less")).alias("genre_rating_count")
    )
