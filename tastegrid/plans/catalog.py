"""Queries over the test tables, one per operator, by name.

Each takes ``(spark, sf_dir)`` and returns a DataFrame; ``oracle`` holds the
SQL to compare with. Arrays and maps are returned as sorted text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegrid import schemas, sinks, sources
from tastegrid.functions import text
from tastegrid.operators import (
    cohorts,
    lookup,
    preferences,
    ranking,
    ratings as rating_ops,
    recommend as rec,
    reshape,
    splits,
    summaries,
)
from tastegrid.plans import testviews as views
from tastegrid.session import fresh_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

MIN_SUPPORT_TOP = 25
MIN_RATINGS_ACTIVE = 50
CAPPED_TEST_ROWS = 100
# Users to look up; the last one is none.
ASKED_USERS = (1, 50, 100, -1)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rating_ops.item_averages(views.item_ratings(spark, sf_dir), views.items(spark, sf_dir))


def _stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rating_ops.item_stats(views.item_ratings(spark, sf_dir))


def _active_favourites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preferences.favourite_category(
        views.ratings(spark, sf_dir), views.items(spark, sf_dir), MIN_RATINGS_ACTIVE, views.words(spark, sf_dir)
    )


def _low_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohorts.users_below(views.users(spark, sf_dir), 0, "balance")


def _segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohorts.users_of_group(views.users(spark, sf_dir), "MACHINERY", 3000, 4000, "balance")


def _entries_text(entries: str, show: Callable[[Column], Column], sep: str = ";") -> Column:
    return F.array_join(F.transform(entries, show), sep)


# Item averages and top lists


@query
def item_avg_rating(spark, sf_dir):
    return _averages(spark, sf_dir).orderBy(*rating_ops.best_first())


@query
def top_items_min_support(spark, sf_dir):
    return rating_ops.top_items(views.item_ratings(spark, sf_dir), views.items(spark, sf_dir), MIN_SUPPORT_TOP)


@query
def top_items_ranked(spark, sf_dir):
    return rating_ops.ranked_top_items(
        views.item_ratings(spark, sf_dir), views.items(spark, sf_dir), MIN_SUPPORT_TOP
    )


@query
def rating_grand_mean(spark, sf_dir):
    mean = rating_ops.grand_mean(_averages(spark, sf_dir))
    return mean.select(F.round("mean_avg_rating", 6).alias("mean_avg_rating"))


@query
def popularity_quality(spark, sf_dir):
    return rating_ops.popularity_quality(_averages(spark, sf_dir))


@query
def dataset_profile(spark, sf_dir):
    return rating_ops.data_profile(views.ratings(spark, sf_dir))


# Users and categories


@query
def users_low_balance(spark, sf_dir):
    return cohorts.by_column(_low_balance(spark, sf_dir), "balance")


@query
def users_segment_range(spark, sf_dir):
    return cohorts.by_column(_segment(spark, sf_dir), "balance")


@query
def items_exploded(spark, sf_dir):
    return preferences.item_categories(views.items(spark, sf_dir))


@query
def active_users(spark, sf_dir):
    return preferences.active_users(views.ratings(spark, sf_dir), MIN_RATINGS_ACTIVE)


@query
def user_genre_counts(spark, sf_dir):
    return preferences.category_counts(views.ratings(spark, sf_dir), views.items(spark, sf_dir))


@query
def favourite_genre_active(spark, sf_dir):
    return _active_favourites(spark, sf_dir).orderBy("user_id")


@query
def favourite_genre_all(spark, sf_dir):
    return preferences.favourite_category(
        views.ratings(spark, sf_dir), views.items(spark, sf_dir), 1, views.words(spark, sf_dir)
    )


@query
def favourite_genre_wide(spark, sf_dir):
    """Without a vocabulary."""
    return preferences.favourite_of_many(
        views.ratings(spark, sf_dir), views.items(spark, sf_dir), MIN_RATINGS_ACTIVE
    )


# Recommendations


@query
def genre_item_stats(spark, sf_dir):
    return rec.category_item_stats(_stats(spark, sf_dir), views.items(spark, sf_dir))


@query
def seen_pairs(spark, sf_dir):
    return rec.seen_pairs(views.ratings(spark, sf_dir))


@query
def unrated_candidates(spark, sf_dir):
    ratings, items = views.ratings(spark, sf_dir), views.items(spark, sf_dir)
    return rec.unrated_counts(ratings, items, stats=_stats(spark, sf_dir), labels=views.words(spark, sf_dir))


def _best_unrated(spark: SparkSession, sf_dir: str, direction: str, n: int = 5) -> DataFrame:
    ratings, items = views.ratings(spark, sf_dir), views.items(spark, sf_dir)
    return rec.best_unrated(ratings, items, n, 5, direction, _stats(spark, sf_dir), views.words(spark, sf_dir))


def _recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _best_unrated(spark, sf_dir, "desc")


def _exclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _best_unrated(spark, sf_dir, "asc")


@query
def recommend_top5(spark, sf_dir):
    return _recommendations(spark, sf_dir).orderBy("user_id", "rank")


@query
def exclude_bottom5(spark, sf_dir):
    return _exclusions(spark, sf_dir).orderBy("user_id", "rank")


@query
def most_excluded_items(spark, sf_dir):
    return rec.most_excluded(_exclusions(spark, sf_dir))


# Cohorts


@query
def cohort_top_items_low_balance(spark, sf_dir):
    return cohorts.cohort_top_items(
        views.ratings(spark, sf_dir), _low_balance(spark, sf_dir), views.items(spark, sf_dir), 5
    )


@query
def cohort_top_items_segment(spark, sf_dir):
    return cohorts.cohort_top_items(
        views.ratings(spark, sf_dir), _segment(spark, sf_dir), views.items(spark, sf_dir), 3
    )


# Summaries


@query
def favourite_genre_counts(spark, sf_dir):
    return summaries.value_counts(_active_favourites(spark, sf_dir), "favorite_genre")


@query
def age_like_counts(spark, sf_dir):
    users = views.users(spark, sf_dir).withColumn("band", cohorts.age_band("balance", 1000))
    return summaries.value_counts_in_order(users, "band")


@query
def genre_top6_other(spark, sf_dir):
    counts = summaries.value_counts(_active_favourites(spark, sf_dir), "favorite_genre")
    return summaries.top_k_and_other(counts, "favorite_genre", 6)


@query
def genre_top6_other_nulls(spark, sf_dir):
    """With a line for users who have no favourite, which is neither kept nor in the rest."""
    users = views.users(spark, sf_dir).select("user_id").join(_active_favourites(spark, sf_dir), "user_id", "left")
    counts = users.groupBy("favorite_genre").agg(F.count("*").alias("n"))
    return summaries.top_k_and_other(counts, "favorite_genre", 6)


@query
def genre_share_pct(spark, sf_dir):
    counts = summaries.value_counts(_active_favourites(spark, sf_dir), "favorite_genre")
    return summaries.shares(counts, "favorite_genre")


@query
def rating_histogram30(spark, sf_dir):
    return summaries.histogram(_averages(spark, sf_dir), "avg_rating", 30)


@query
def label_map(spark, sf_dir):
    return _averages(spark, sf_dir).select(
        "item_id",
        text.shortened("title", 7).alias("short_title"),
        text.support_label("avg_rating", "rating_count").alias("label"),
        text.short_support_label("avg_rating", "rating_count").alias("short_label"),
    )


# Shapes of stored results


@query
def recs_wide(spark, sf_dir):
    return reshape.to_wide(_recommendations(spark, sf_dir))


@query
def recs_wide_lookup(spark, sf_dir):
    return reshape.wide_to_list(reshape.to_wide(_recommendations(spark, sf_dir)))


@query
def recs_wide_lookup_defaults(spark, sf_dir):
    """Lists of three in rows for five, so that the last two ranks are missing."""
    return reshape.wide_to_full_list(reshape.to_wide(_best_unrated(spark, sf_dir, "desc", 3), 5))


@query
def recs_wide_ten(spark, sf_dir):
    """Ten ranks stored and ten shown."""
    return reshape.wide_to_full_list(reshape.to_wide(_best_unrated(spark, sf_dir, "desc", 10), 10))


@query
def wide_key_count(spark, sf_dir):
    path = fresh_path(spark, "wide")
    sinks.replace_table(reshape.to_wide(_recommendations(spark, sf_dir)), path, ["row_key"])
    return sources.read_table(spark, path).select("row_key").agg(F.count("*").alias("stored_users"))


@query
def exclusions_nested(spark, sf_dir):
    documents = reshape.to_documents(_exclusions(spark, sf_dir))
    entry = lambda e: F.format_string("%d:%d:%s:%.4f", e.avoid_rank, e.item_id, e.title, e.global_avg_rating)
    return documents.select(
        F.col("_id").alias("document_id"),
        "user_id",
        "favorite_genre",
        _entries_text("blacklisted_movies", entry).alias("blacklisted"),
    )


@query
def exclusions_flattened(spark, sf_dir):
    path = fresh_path(spark, "documents")
    reshape.to_documents(_exclusions(spark, sf_dir)).write.json(path)
    return reshape.flatten_documents(sources.read_documents(spark, path, schemas.EXCLUSION_DOCUMENT))


def _stored_documents(spark: SparkSession, sf_dir: str) -> str:
    path = fresh_path(spark, "documents")
    sinks.replace_keyed(reshape.to_documents(_exclusions(spark, sf_dir)), path, ["user_id"])
    return path


@query
def document_find(spark, sf_dir):
    """Documents of a list of users, one of whom does not exist."""
    path = _stored_documents(spark, sf_dir)
    found = lookup.lookup_stored(spark, path, ASKED_USERS, schema=schemas.EXCLUSION_DOCUMENT)
    return found.select("user_id", "found", "favorite_genre", F.size("blacklisted_movies").alias("entries"))


@query
def rating_matrix_map(spark, sf_dir):
    matrix = reshape.rating_matrix(views.ratings(spark, sf_dir))
    cell = lambda e: F.format_string("%d:%d", e.key, e.value)
    return matrix.withColumn("cells", F.array_sort(F.map_entries("ratings"))).select(
        "user_id", "segment", _entries_text("cells", cell).alias("cells")
    )


@query
def rating_matrix_row(spark, sf_dir):
    return reshape.rows_of_ratings(views.ratings(spark, sf_dir), _low_balance(spark, sf_dir))


@query
def rating_matrix_fetch(spark, sf_dir):
    """Rows of some users from a stored matrix."""
    path = fresh_path(spark, "matrix")
    sinks.replace_keyed(reshape.rating_matrix(views.ratings(spark, sf_dir)), path, ["user_id", "segment"])
    return reshape.fetch_rows(sources.read_ids(spark, path, "user_id", ASKED_USERS), ASKED_USERS)


@query
def rating_matrix_floats(spark, sf_dir):
    halves = views.ratings(spark, sf_dir).withColumn("rating", F.col("rating") / 2 - 1)
    return reshape.matrix_cells(reshape.rating_matrix(halves))


@query
def profile_lookup(spark, sf_dir):
    answers = lookup.lookup_each(_active_favourites(spark, sf_dir), views.users(spark, sf_dir))
    return answers.withColumn("row_key", text.row_key("user_id")).withColumn(
        "favorite_genre", text.or_default("favorite_genre", "Unknown")
    )


@query
def lookup_ids(spark, sf_dir):
    """Profiles of a list of ids, one of which does not exist."""
    path = fresh_path(spark, "users")
    sinks.replace_keyed(views.users(spark, sf_dir), path, ["user_id"])
    return lookup.lookup_stored(spark, path, ASKED_USERS)


# Tables and files


@query
def keyed_table_upsert(spark, sf_dir):
    path = fresh_path(spark, "latest")
    latest = [F.desc("ts"), F.desc("item_id"), F.desc("rating")]
    sinks.replace_table(views.ratings(spark, sf_dir), path, ["user_id"], latest)
    return sources.read_table(spark, path, schemas.RATING)


@query
def keyed_table_merge(spark, sf_dir):
    """Each user's latest rating, replaced by the latest of 4 or more if there is one."""
    path = fresh_path(spark, "merged")
    latest = [F.desc("ts"), F.desc("item_id"), F.desc("rating")]
    ratings = views.ratings(spark, sf_dir)
    sinks.replace_keyed(ratings, path, ["user_id"], latest)
    sinks.merge_keyed(ratings.where("rating >= 4"), path, ["user_id"], latest)
    return sources.read_keyed(spark, path, schemas.RATING)


@query
def clustered_table_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "by_genre")
    stats = rec.category_item_stats(_stats(spark, sf_dir), views.items(spark, sf_dir))
    ranked = ranking.ordinals(stats, "genre", list(rating_ops.best_first()), "rank")
    sinks.write_clustered(ranked, path, ["genre", "rank"])
    return sources.read_table(spark, path, ranked.schema)


@query
def table_readback_check(spark, sf_dir):
    """A stored table against the rows that went in, counted on both sides."""
    path = fresh_path(spark, "checked")
    averages = _averages(spark, sf_dir)
    sinks.replace_table(averages, path, ["item_id"])
    stored = sources.read_table(spark, path, schemas.ITEM_AVERAGE)
    differing = sinks.differences(stored, averages).agg(F.count("*")).scalar()
    return stored.agg(F.count("*").alias("stored_rows")).select("stored_rows", differing.alias("differing_rows"))


@query
def csv_export_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "averages")
    sinks.write_export(_averages(spark, sf_dir), path)
    return sources.read_export(spark, path, schemas.ITEM_AVERAGE)


def _padded(spark: SparkSession, sf_dir: str) -> DataFrame:
    blanks = F.repeat(F.lit(" "), (F.col("item_id") % 3).cast("int"))
    return _averages(spark, sf_dir).withColumn("title", F.concat(blanks, "title", F.lit('" '), blanks))


@query
def csv_export_padded(spark, sf_dir):
    """Blanks and quotes around titles survive."""
    path = fresh_path(spark, "averages")
    sinks.write_export(_padded(spark, sf_dir), path)
    return sources.read_export(spark, path, schemas.ITEM_AVERAGE)


@query
def cached_padded(spark, sf_dir):
    base = fresh_path(spark, "results")
    build = lambda: _padded(spark, sf_dir)
    return sinks.materialize_or_load(spark, base, "padded", {}, build, schemas.ITEM_AVERAGE, [f"{sf_dir}/part.parquet"])


@query
def export_inferred(spark, sf_dir):
    """An export read without a schema."""
    path = fresh_path(spark, "averages")
    sinks.write_export(_averages(spark, sf_dir), path)
    read = sources.read_export(spark, path)
    return read.withColumns({name: F.col(name).cast("bigint") for name in ("item_id", "rating_count")})


@query
def cached_result(spark, sf_dir):
    """Stored under its parameters by the first call, loaded by the second."""
    base = fresh_path(spark, "results")
    for _ in range(2):
        loaded = sinks.materialize_or_load(
            spark,
            base,
            "favourites",
            {"min_ratings": MIN_RATINGS_ACTIVE},
            lambda: _active_favourites(spark, sf_dir),
            schemas.FAVOURITE,
        )
    return loaded


def _write_lines(df: DataFrame, sep: str, name: str) -> str:
    path = fresh_path(df.sparkSession, name)
    columns = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    df.select(F.concat_ws(sep, *columns)).write.text(path)
    return path


@query
def scan_ratings_tsv(spark, sf_dir):
    path = _write_lines(views.ratings(spark, sf_dir), "\t", "ratings")
    found = sources.read_first_available([f"{path}-absent", path], lambda p: sources.read_ratings(spark, p))
    return found.withColumn("rating_value", F.col("rating").cast("double"))


@query
def scan_ratings_float(spark, sf_dir):
    halves = views.ratings(spark, sf_dir).withColumn("rating", F.col("rating") / 2 - 1)
    return sources.read_ratings(spark, _write_lines(halves, "\t", "ratings"), "double")


def _bad_ratings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Ratings in a file of which some lines have text for a number, a field
    too few or too many, or an empty one."""
    ratings = views.ratings(spark, sf_dir)
    lines = F.concat_ws("\t", *[F.col(name).cast("string") for name in ratings.columns])
    spoiled = (
        F.when(F.col("item_id") % 50 == 1, F.concat(F.lit("x"), lines))
        .when(F.col("item_id") % 50 == 2, F.regexp_replace(lines, "\t[^\t]*$", ""))
        .when(F.col("item_id") % 50 == 3, F.concat(lines, F.lit("\t0")))
        .when(F.col("item_id") % 50 == 4, F.regexp_replace(lines, "\t[^\t]*\t", "\t\t"))
        .otherwise(lines)
    )
    path = fresh_path(spark, "ratings")
    ratings.select(spoiled).write.text(path)
    return sources.split_bad_lines(spark, path, schemas.RATING, "\t")


@query
def good_lines(spark, sf_dir):
    return _bad_ratings(spark, sf_dir)[0]


@query
def bad_lines_set_aside(spark, sf_dir):
    bad = _bad_ratings(spark, sf_dir)[1]
    return bad.groupBy(F.size(F.split("_bad_line", "\t")).alias("fields")).agg(F.count("*").alias("n"))


def _item_lines(spark: SparkSession, sf_dir: str, labels) -> str:
    parts = views.table(spark, sf_dir, "part")
    words = F.split("p_name", " ")
    flags = [F.array_contains(words, word).cast("int").alias(f"flag_{word}") for word in labels]
    raw = parts.select("p_partkey", "p_name", "p_type", F.lit("").alias("video"), "p_brand", *flags)
    return _write_lines(raw, "|", "items")


@query
def scan_items_flags(spark, sf_dir):
    labels = views.words(spark, sf_dir)
    read = sources.read_items(spark, _item_lines(spark, sf_dir, labels), labels)
    return read.withColumn("genres", F.array_join("genres", " "))


@query
def scan_items_undated(spark, sf_dir):
    labels = views.words(spark, sf_dir)
    read = sources.read_items(spark, _item_lines(spark, sf_dir, labels), labels, with_date=False)
    return read.withColumn("genres", F.array_join("genres", " "))


@query
def scan_columns_subset(spark, sf_dir):
    """Two of four named columns."""
    path = _write_lines(views.ratings(spark, sf_dir), "\t", "ratings")
    return sources.read_delimited(spark, path, schemas.RATING, "\t", columns=["item_id", "rating"])


@query
def scan_users_pipe(spark, sf_dir):
    raw = views.table(spark, sf_dir, "customer").select(
        "c_custkey",
        (F.col("c_custkey") % 60 + 10).alias("age"),
        F.when(F.col("c_nationkey") < 12, "M").otherwise("F").alias("gender"),
        "c_mktsegment",
        F.format_string(" %05d ", F.col("c_custkey")).alias("zip"),
    )
    read = sources.read_users(spark, _write_lines(raw, "|", "users"))
    return read.withColumn("gender_label", text.gender_label("gender"))


@query
def vocabulary_check(spark, sf_dir):
    """Words of part names that are no part type."""
    exploded = preferences.item_categories(views.items(spark, sf_dir))
    types = views.table(spark, sf_dir, "part").select(F.lower("p_type").alias("genre")).distinct()
    return sources.outside_vocabulary(exploded, "genre", types)


@query
def occupation_check(spark, sf_dir):
    """Occupations that the fixed list lacks; one user in three has one of it."""
    listed = F.when(F.col("user_id") % 3 == 0, F.lit(schemas.OCCUPATIONS[0])).otherwise(F.col("occupation"))
    users = views.users(spark, sf_dir).withColumn("occupation", listed)
    return sources.outside_vocabulary(users, "occupation", schemas.OCCUPATIONS)


@query
def vocabulary_index(spark, sf_dir):
    exploded = preferences.item_categories(views.items(spark, sf_dir)).select("item_id", "genre")
    return exploded.join(sources.vocabulary(spark, views.words(spark, sf_dir)), "genre")


# Splits


@query
def kfold_split(spark, sf_dir):
    return splits.kfold_assign(views.events(spark, sf_dir), "event_id", 5)


@query
def kfold_sizes(spark, sf_dir):
    return splits.fold_sizes(splits.kfold_assign(views.events(spark, sf_dir), "event_id", 5), 5)


@query
def holdout_first10(spark, sf_dir):
    return splits.holdout(views.events(spark, sf_dir), "event_id", 1, 10)


@query
def holdout_next10(spark, sf_dir):
    return splits.holdout(views.events(spark, sf_dir), "event_id", 11, 20)


@query
def holdout_capped(spark, sf_dir):
    return splits.holdout(views.events(spark, sf_dir), "event_id", 1, 10, CAPPED_TEST_ROWS)


@query
def ratings_in_order(spark, sf_dir):
    return splits.in_rating_order(views.ratings(spark, sf_dir))


@query
def event_ordinals(spark, sf_dir):
    return ranking.with_ordinals(views.events(spark, sf_dir), "user_id", "event_id")
