"""Ranked lists as wide rows, documents and map cells, and back again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegrid.functions.text import fixed4, or_default, row_key
from tastegrid.operators.ranking import salted_join

# Distinct items one map of the rating matrix can hold at most.
SEGMENT = 1024


def _cell(rank: int, name: str) -> str:
    return f"rank_{rank}_{name}"


def to_wide(recommendations: DataFrame, n: int = 5) -> DataFrame:
    """One text row per user: row key and three columns per rank 1..n."""
    cells = F.struct(
        F.col("item_id").cast("string").alias("movie_id"),
        F.col("title").alias("title"),
        fixed4("avg_rating").alias("avg_rating"),
    )
    by_rank = (
        recommendations.groupBy("user_id").pivot("rank", list(range(1, n + 1))).agg(F.first(cells, ignorenulls=True))
    )
    columns = [
        F.col(f"`{k}`.{name}").alias(_cell(k, name))
        for k in range(1, n + 1)
        for name in ("movie_id", "title", "avg_rating")
    ]
    return by_rank.select(row_key("user_id").alias("row_key"), *columns)


def _wide_ranks(wide: DataFrame, n: int) -> DataFrame:
    lines = [
        F.struct(
            F.lit(k).alias("rank"),
            F.col(_cell(k, "movie_id")).alias("movie_id"),
            F.col(_cell(k, "title")).alias("title"),
            F.col(_cell(k, "avg_rating")).alias("avg_rating"),
        )
        for k in range(1, n + 1)
    ]
    return wide.select("row_key", F.explode(F.array(*lines)).alias("line")).select("row_key", "line.*")


def stored_ranks(wide: DataFrame) -> int:
    """How many ranks the columns of wide rows hold."""
    return sum(name.startswith("rank_") and name.endswith("_title") for name in wide.columns)


def wide_to_list(wide: DataFrame) -> DataFrame:
    """Ranked lines of wide rows; ranks without a title are left out."""
    lines = _wide_ranks(wide, stored_ranks(wide)).where(F.col("title").isNotNull())
    return lines.select("row_key", "rank", F.col("movie_id").cast("bigint").alias("item_id"), "title", "avg_rating")


def wide_to_full_list(wide: DataFrame) -> DataFrame:
    """A line for every stored rank of a wide row, with defaults for what is
    missing."""
    return _wide_ranks(wide, stored_ranks(wide)).select(
        "row_key",
        "rank",
        or_default("movie_id", "N/A").alias("movie_id"),
        or_default("title", "Unknown Title").alias("title"),
        or_default("avg_rating", "N/A").alias("avg_rating"),
    )


def to_documents(exclusions: DataFrame, n: int = 5) -> DataFrame:
    """One document per user with its items of rank 1 to ``n`` in rank order."""
    entry = F.struct(
        F.col("rank").alias("avoid_rank"), "item_id", "title", F.col("avg_rating").alias("global_avg_rating")
    )
    per_user = exclusions.where(F.col("rank") <= n).groupBy("user_id").agg(
        F.first("fav_genre").alias("favorite_genre"),
        F.array_sort(F.collect_list(entry)).alias("blacklisted_movies"),
    )
    return per_user.select(row_key("user_id").alias("_id"), "user_id", "favorite_genre", "blacklisted_movies")


def flatten_documents(documents: DataFrame) -> DataFrame:
    """One line per array element; a document without array gives none."""
    entries = documents.select("user_id", "favorite_genre", F.explode("blacklisted_movies").alias("entry"))
    return entries.select("user_id", "favorite_genre", "entry.*")


def latest_cells(ratings: DataFrame) -> DataFrame:
    """One rating per user and item: the latest, and the highest among equals.
    Ratings may be of any type that can be ordered."""
    newest = F.max(F.struct("ts", "rating")).alias("newest")
    cells = ratings.groupBy("user_id", "item_id").agg(newest)
    return cells.select("user_id", "item_id", F.col("newest.rating").alias("rating"))


def segment_of(item_id: str) -> Column:
    return F.floor(F.col(item_id) / SEGMENT)


def rating_matrix(ratings: DataFrame) -> DataFrame:
    """Sparse matrix rows ``user_id, segment, {item_id: rating}``.

    A user's cells are cut into segments of consecutive item ids, so that no
    map outgrows ``SEGMENT`` entries however much a single user rates.
    """
    cells = latest_cells(ratings).withColumn("segment", segment_of("item_id"))
    entries = F.collect_list(F.struct("item_id", "rating"))
    return cells.groupBy("user_id", "segment").agg(F.map_from_entries(F.array_sort(entries)).alias("ratings"))


def matrix_cells(matrix: DataFrame) -> DataFrame:
    return matrix.select("user_id", F.explode("ratings").alias("item_id", "rating"))


def fetch_rows(matrix: DataFrame, users: Sequence[int]) -> DataFrame:
    """Cells of the asked users' rows. The ids reach the scan as a filter, so a
    matrix stored in key order reads only the row groups that can match."""
    return matrix_cells(matrix.where(F.col("user_id").isin(sorted(set(users)))))


def rows_of_ratings(ratings: DataFrame, users: DataFrame) -> DataFrame:
    """Cells of the asked users' rows from ratings that are in no matrix yet:
    other users' ratings are dropped before any is grouped."""
    asked = users.select("user_id")
    return matrix_cells(rating_matrix(salted_join(ratings, asked, "user_id", "item_id", "left_semi")))
