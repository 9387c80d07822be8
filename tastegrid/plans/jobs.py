"""Batch jobs from delimited files to stored results.

Each job writes its tables below ``out`` and returns their paths by name. All
results are written by the executors; none passes through the driver. What a
job stores on the way is removed when it ends, also if it fails.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegrid import schemas, sinks, sources
from tastegrid.functions.text import row_key
from tastegrid.operators import cohorts, lookup, preferences, recommend, reshape, splits, summaries
from tastegrid.operators import ratings as rating_ops
from tastegrid.session import fresh_path, scratch

Paths = dict[str, str]


def _job(function: Callable[..., Paths]) -> Callable[..., Paths]:
    @wraps(function)
    def run(spark: SparkSession, *args, **kwargs) -> Paths:
        with scratch(spark):
            return function(spark, *args, **kwargs)

    return run


def _store(out: str, name: str, df: DataFrame, key: list[str]) -> str:
    path = f"{out}/{name}"
    sinks.replace_keyed(df, path, key)
    return path


@_job
def average_ratings(
    spark: SparkSession, ratings: str, items: str, out: str, min_ratings: int = 10, n: int = 10
) -> Paths:
    """Mean per item, and the ranked top list. The list is taken from the
    stored means, so the ratings are read once."""
    means = rating_ops.item_averages(sources.read_ratings(spark, ratings), sources.read_items(spark, items))
    averages = _store(out, "avg_ratings", means, ["item_id"])
    stored = sources.read_table(spark, averages, schemas.ITEM_AVERAGE)
    top = rating_ops.with_rank(stored.where(F.col("rating_count") >= min_ratings), n)
    return {"avg_ratings": averages, "top_items": _store(out, "top_items", top, ["partition_key", "rank"])}


@_job
def user_tables(
    spark: SparkSession,
    ratings: str,
    items: str,
    users: str,
    out: str,
    min_ratings: int = 50,
    young_below: int = 20,
    occupation: str = "scientist",
    age_from: int = 30,
    age_to: int = 40,
) -> Paths:
    """Profiles, favourite categories of active users, and two cohorts."""
    rated, titles = sources.read_ratings(spark, ratings), sources.read_items(spark, items)
    paths = {"users": _store(out, "users", sources.read_users(spark, users), ["user_id"])}
    stored = sources.read_table(spark, paths["users"], schemas.USER)
    results = {
        "user_fav_genres": preferences.favourite_category(rated, titles, min_ratings),
        "young_users": cohorts.users_below(stored, young_below),
        "group_users": cohorts.users_of_group(stored, occupation, age_from, age_to),
    }
    for name, df in results.items():
        paths[name] = _store(out, name, df, ["user_id"])
    unknown = sources.outside_vocabulary(stored, "occupation", schemas.OCCUPATIONS)
    paths["unknown_occupations"] = _store(out, "unknown_occupations", unknown, ["occupation"])
    return paths


def _staged_ratings(spark: SparkSession, path: str) -> DataFrame:
    """The text parsed once into columns, for jobs that read it several times."""
    staged = fresh_path(spark, "ratings")
    sources.read_ratings(spark, path).write.parquet(staged)
    return sources.read_table(spark, staged, schemas.RATING)


def _best_unrated(spark, ratings, items, out, name, n, min_support, direction) -> DataFrame:
    def build() -> DataFrame:
        staged = _staged_ratings(spark, ratings)
        return recommend.best_unrated(staged, sources.read_items(spark, items), n, min_support, direction)

    params = {"ratings": ratings, "items": items, "n": n, "min_support": min_support}
    return sinks.materialize_or_load(spark, out, name, params, build, schemas.RECOMMENDATION, [ratings, items])


@_job
def recommendations(
    spark: SparkSession, ratings: str, items: str, out: str, n: int = 5, min_support: int = 5
) -> Paths:
    """Best unrated items per user as flat rows, computed once per set of
    parameters and inputs, and as wide rows."""
    flat = _best_unrated(spark, ratings, items, out, "recommendations", n, min_support, "desc")
    return {"wide_recommendations": _store(out, "wide_recommendations", reshape.to_wide(flat, n), ["row_key"])}


@_job
def exclusions(spark: SparkSession, ratings: str, items: str, out: str, n: int = 5, min_support: int = 5) -> Paths:
    """Worst unrated items per user as documents, keyed by user, and as a flat
    export; and the items that are kept from most users."""
    flat = _best_unrated(spark, ratings, items, out, "least_liked", n, min_support, "asc")
    paths = {"documents": _store(out, "exclusion_documents", reshape.to_documents(flat, n), ["user_id"])}
    documents = sources.read_table(spark, paths["documents"], schemas.EXCLUSION_DOCUMENT)
    lines = reshape.flatten_documents(documents)
    paths["export"] = f"{out}/exported_exclusions"
    sinks.write_export(lines, paths["export"])
    excluded = recommend.most_excluded(lines.withColumnRenamed("global_avg_rating", "avg_rating"))
    paths["most_excluded"] = _store(out, "most_excluded", excluded, ["item_id"])
    return paths


@_job
def rating_matrix(spark: SparkSession, ratings: str, out: str) -> Paths:
    """Sparse matrix rows, cut into segments of item ids."""
    matrix = reshape.rating_matrix(sources.read_ratings(spark, ratings))
    return {"rating_matrix": _store(out, "rating_matrix", matrix, ["user_id", "segment"])}


@_job
def cohort_summaries(
    spark: SparkSession,
    ratings: str,
    items: str,
    users: str,
    out: str,
    min_ratings: int = 50,
    min_support: int = 5,
    n: int = 10,
    young_below: int = 20,
    occupation: str = "scientist",
    age_from: int = 30,
    age_to: int = 40,
    bins: int = 30,
    top_k: int = 6,
) -> Paths:
    """Distribution of item means, favourite categories with their shares, and
    for two cohorts the best items and the counts by age and gender."""
    rated, titles = _staged_ratings(spark, ratings), sources.read_items(spark, items)
    profiles = sources.read_users(spark, users)
    averages = rating_ops.item_averages(rated, titles)
    favourites = preferences.favourite_category(rated, titles, min_ratings)
    counts = summaries.value_counts(favourites, "favorite_genre")
    paths = {
        "rating_histogram": _store(out, "rating_histogram", summaries.histogram(averages, "avg_rating", bins), ["bin"]),
        "grand_mean": _store(out, "grand_mean", rating_ops.grand_mean(averages), ["mean_avg_rating"]),
        "top_genres": _store(
            out, "top_genres", summaries.top_k_and_other(counts, "favorite_genre", top_k), ["is_rest", "favorite_genre"]
        ),
        "genre_shares": _store(out, "genre_shares", summaries.shares(counts, "favorite_genre"), ["favorite_genre"]),
    }
    groups = {
        "young": cohorts.users_below(profiles, young_below),
        "group": cohorts.users_of_group(profiles, occupation, age_from, age_to),
    }
    for name, cohort in groups.items():
        best = cohorts.cohort_top_items(rated, cohort, titles, min_support, n)
        paths[f"{name}_top_items"] = _store(out, f"{name}_top_items", best, ["item_id"])
        for column in ("age", "gender"):
            table = f"{name}_{column}_counts"
            paths[table] = _store(out, table, summaries.value_counts_in_order(cohort, column), [column])
    return paths


@_job
def evaluation_splits(
    spark: SparkSession,
    ratings: str,
    out: str,
    folds: int = 5,
    holdouts: Sequence[tuple[int, int]] = ((1, 10), (11, 20)),
    max_test: int = 0,
) -> Paths:
    """k folds and per-user holdouts of a ratings file in file order.

    Each split is stored once, by fold or role: fold i tests on partition i and
    trains on the others. Rows are sorted by user and item in each part.
    ``max_test`` limits the test rows of a holdout, 0 being no limit.
    """
    rows = sources.with_input_order(sources.read_ratings(spark, ratings))
    parts = {"folds": (splits.kfold_assign(rows, "line", folds), "fold")}
    for start, stop in holdouts:
        parts[f"holdout_{start}_{stop}"] = (splits.holdout(rows, "line", start, stop, max_test), "role")
    paths = {}
    for name, (df, part) in parts.items():
        paths[name] = f"{out}/{name}"
        sinks.write_clustered(df.drop("line"), paths[name], [part, "user_id", "item_id", "rating", "ts"], [part])
    return paths


def show_profiles(spark: SparkSession, table: str, user_ids: Sequence[int]) -> DataFrame:
    """Wide rows of the asked users as lines, one for each rank that the table
    holds; users who are absent have one line without."""
    keys = [f"user_{user_id:06d}" for user_id in user_ids]
    hits = reshape.wide_to_full_list(sources.read_ids(spark, table, "row_key", keys))
    asked = spark.createDataFrame([(key,) for key in keys], "row_key string")
    return lookup.lookup_each(hits, asked, "row_key").orderBy("row_key", "rank")


def show_documents(spark: SparkSession, table: str, user_ids: Sequence[int]) -> DataFrame:
    """Lines of the asked users' documents; one line for a user without."""
    documents = sources.read_ids(spark, table, "user_id", list(user_ids), schemas.EXCLUSION_DOCUMENT)
    found = reshape.flatten_documents(documents)
    return lookup.lookup(found, list(user_ids)).orderBy("user_id", "avoid_rank")


def show_rows(spark: SparkSession, table: str, user_ids: Sequence[int]) -> DataFrame:
    """Rows of any table keyed by user, such as favourites, with row keys."""
    found = lookup.lookup_stored(spark, table, list(user_ids))
    return found.withColumn("row_key", row_key("user_id")).orderBy("user_id")
