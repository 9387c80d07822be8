"""Operators against brute force on small skewed data, over several plans."""

import random

import brute
import numpy as np
import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from tastegrid.functions import text
from tastegrid.operators import cohorts, lookup, preferences, ranking, recommend, reshape, splits, summaries
from tastegrid.operators import ratings as rating_ops

LABELS = ["Drama", "Action", "Comedy", "War", "unused"]
PLANS = {
    "default": {},
    "no broadcast": {"spark.sql.autoBroadcastJoinThreshold": "-1"},
    "no adaptive plan": {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"},
}


@pytest.fixture(params=PLANS)
def plan(spark, request):
    for key, value in PLANS[request.param].items():
        spark.conf.set(key, value)
    yield request.param
    for key in PLANS[request.param]:
        spark.conf.unset(key)
    spark.conf.set("spark.sql.adaptive.enabled", "true")


RATINGS, ITEMS = brute.skewed_ratings(), brute.labelled_items(LABELS)


@pytest.fixture(scope="module")
def ratings(spark):
    return spark.createDataFrame(RATINGS, "user_id bigint, item_id bigint, rating int, ts bigint").repartition(6)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id bigint, title string, genres array<string>")


def rows(df, *columns):
    return sorted(tuple(row) for row in df.select(*columns).collect())


def test_item_averages(plan, ratings, items):
    got = {r.item_id: (r.avg_rating, r.rating_count) for r in rating_ops.item_averages(ratings, items).collect()}
    assert got == brute.means(RATINGS)


def test_top_items_have_support_and_gapless_ranks(ratings, items):
    got = rating_ops.ranked_top_items(ratings, items, 8, 5).orderBy("rank").collect()
    want = sorted((-m, i) for i, (m, n) in brute.means(RATINGS).items() if n >= 8)[:5]
    assert [(-r.avg_rating, r.item_id) for r in got] == want
    assert [r["rank"] for r in got] == [1, 2, 3, 4, 5]


@pytest.mark.parametrize("min_ratings", [1, 18])
def test_favourites(plan, ratings, items, min_ratings):
    got = preferences.favourite_category(ratings, items, min_ratings, LABELS)
    want = brute.favourites(RATINGS, ITEMS, min_ratings)
    assert {r.user_id: (r.favorite_genre, r.genre_rating_count) for r in got.collect()} == want


def test_ratings_of_items_without_category_count_as_activity(spark, items):
    ratings = spark.createDataFrame([(1, 7, 3), (1, 999, 3), (1, 1, 3)], "user_id bigint, item_id bigint, rating int")
    got = preferences.favourite_category(ratings, items, 3, LABELS).collect()
    assert [(r.user_id, r.genre_rating_count) for r in got] == [(1, 1)]


def test_label_outside_the_vocabulary_fails(ratings, items):
    with pytest.raises(SparkRuntimeException, match="outside the vocabulary: War"):
        preferences.favourite_category(ratings, items, 1, ["Drama", "Action", "Comedy"]).collect()


def test_exploded_rows_add_up_to_the_arrays(items):
    assert preferences.item_categories(items).count() == sum(len(names) for _, _, names in ITEMS)


@pytest.mark.parametrize("direction, n, min_support", [("desc", 5, 5), ("asc", 5, 5), ("desc", 40, 1)])
def test_best_unrated(plan, ratings, items, direction, n, min_support):
    got = recommend.best_unrated(ratings, items, n, min_support, direction, labels=LABELS)
    want = brute.best_unrated(RATINGS, ITEMS, n, min_support, direction == "desc")
    assert rows(got, "user_id", "rank", "item_id", "title", "avg_rating", "fav_genre") == want
    assert 2 not in {row[0] for row in want}


def test_places_may_be_too_many_to_broadcast(plan, ratings, items, monkeypatch):
    monkeypatch.setattr(recommend, "MOST_BROADCAST", 0)
    got = recommend.best_unrated(ratings, items, 5, 5, labels=LABELS)
    want = brute.best_unrated(RATINGS, ITEMS, 5, 5, True)
    assert rows(got, "user_id", "rank", "item_id", "title", "avg_rating", "fav_genre") == want


def test_long_stretches_cross_ranking_blocks(plan, spark):
    """A user who has rated 500 of 600 items finds the open ones at the end."""
    items = [(i, f"t{i}", ["Drama"]) for i in range(1, 601)]
    ratings = [(1, i, 5 if i <= 500 else 1, i) for i in range(1, 501)]
    ratings += [(2, i, 5 if i <= 500 else 1, i) for i in range(1, 601)] + [(3, 1, 4, 1)]
    items_df = spark.createDataFrame(items, "item_id bigint, title string, genres array<string>")
    ratings_df = spark.createDataFrame(ratings, "user_id bigint, item_id bigint, rating int, ts bigint")
    got = recommend.best_unrated(ratings_df, items_df, 5, 1, labels=LABELS)
    want = brute.best_unrated(ratings, items, 5, 1, True)
    assert rows(got, "user_id", "rank", "item_id", "title", "avg_rating", "fav_genre") == want


def test_category_without_qualified_items_gives_no_list(spark, items):
    ratings = spark.createDataFrame([(1, 1, 5, 1), (1, 2, 4, 2)], "user_id bigint, item_id bigint, rating int, ts bigint")
    assert recommend.best_unrated(ratings, items, 5, 2, labels=LABELS).count() == 0


def test_ties_in_the_mean_go_to_the_smaller_item(spark):
    items = spark.createDataFrame([(i, f"t{i}", ["War"]) for i in range(1, 12)], "item_id bigint, title string, genres array<string>")
    ratings = spark.createDataFrame(
        [(u, i, 3, 1) for u in (1, 2) for i in range(1, 12) if (u, i) != (1, 4)] + [(3, 4, 3, 1), (4, 11, 3, 1)],
        "user_id bigint, item_id bigint, rating int, ts bigint",
    )
    for direction in ("asc", "desc"):
        got = recommend.best_unrated(ratings, items, 5, 1, direction, labels=["Drama", "War"])
        lists = {u: [r.item_id for r in got.orderBy("rank").collect() if r.user_id == u] for u in (1, 3, 4)}
        assert lists == {1: [4], 3: [1, 2, 3, 5, 6], 4: [1, 2, 3, 4, 5]}


@pytest.mark.parametrize("min_ratings", [1, 18])
def test_favourites_without_a_vocabulary(plan, ratings, items, min_ratings):
    got = preferences.favourite_of_many(ratings, items, min_ratings)
    want = brute.favourites(RATINGS, ITEMS, min_ratings)
    assert {r.user_id: (r.favorite_genre, r.genre_rating_count) for r in got.collect()} == want


def test_too_many_labels_for_counters(ratings, items):
    with pytest.raises(ValueError, match="favourite_of_many"):
        preferences.favourite_category(ratings, items, 1, [str(i) for i in range(2000)])


def test_labels_may_hold_any_character(spark):
    items = spark.createDataFrame([(1, "t", ["a\nb", "c"])], "item_id bigint, title string, genres array<string>")
    ratings = spark.createDataFrame([(1, 1, 5)], "user_id bigint, item_id bigint, rating int")
    got = preferences.favourite_category(ratings, items, 1, ["c", "a\nb"]).collect()
    assert [r.favorite_genre for r in got] == ["a\nb"]


def test_unrated_counts(plan, ratings, items):
    got = recommend.unrated_counts(ratings, items, 5, labels=LABELS)
    want = {}
    for user, *_ in brute.best_unrated(RATINGS, ITEMS, 10**6, 5, True):
        want[user] = want.get(user, 0) + 1
    assert {r.user_id: r.candidates for r in got.collect()} == want


def test_most_excluded(ratings, items):
    got = recommend.most_excluded(recommend.best_unrated(ratings, items, 5, 5, "asc", labels=LABELS)).collect()
    counts = {}
    for _, _, item, *_ in brute.best_unrated(RATINGS, ITEMS, 5, 5, False):
        counts[item] = counts.get(item, 0) + 1
    assert {r.item_id: r.excluded_for for r in got} == counts
    assert [r.excluded_for for r in got] == sorted(counts.values(), reverse=True)


def test_no_ratings_give_empty_results(spark, ratings, items):
    nothing = ratings.where("false")
    assert recommend.best_unrated(nothing, items, labels=LABELS).count() == 0
    assert preferences.favourite_category(nothing, items, 1, LABELS).count() == 0
    assert summaries.histogram(nothing, "rating", 3).agg(F.sum("n")).first()[0] == 0


def test_cohort_bounds(spark):
    users = spark.createDataFrame(
        [(7, 19, "student"), (8, 30, "scientist"), (9, 40, "scientist"), (10, 41, "scientist"), (11, 20, "student")],
        "user_id bigint, age int, occupation string",
    )
    assert [r.user_id for r in cohorts.users_below(users, 20).collect()] == [7]
    assert [r.user_id for r in cohorts.users_of_group(users, "scientist", 30, 40).collect()] == [8, 9]


def test_cohort_top_items(ratings, items):
    users = ratings.where("user_id between 1 and 9").select("user_id")
    got = cohorts.cohort_top_items(ratings, users, items, 3, 10).collect()
    by_item = {}
    for user, item, rating, _ in RATINGS:
        if user <= 9:
            by_item.setdefault(item, []).append(rating)
    want = sorted((-sum(v) / len(v), i, len(v)) for i, v in by_item.items() if len(v) >= 3)[:10]
    assert [(-r.avg_rating, r.item_id, r.num_ratings) for r in got] == want


def test_data_profile(ratings):
    got = rating_ops.data_profile(ratings, 20).first()
    users = [r[0] for r in RATINGS]
    below = sum(users.count(u) < 20 for u in set(users))
    assert tuple(got) == (len(set(users)), len({r[1] for r in RATINGS}), len(RATINGS), 1, 5, below)
    assert tuple(rating_ops.data_profile(ratings.where("false")).first()) == (0, 0, 0, None, None, 0)


def test_ranks_are_bounded_by_the_function(ratings, items):
    averages = rating_ops.item_averages(ratings, items)
    assert [r["rank"] for r in rating_ops.with_rank(averages, 3).orderBy("rank").collect()] == [1, 2, 3]


# Summaries


def test_other_is_dropped_if_empty_and_kept_apart_from_a_value_of_that_name(spark):
    few = spark.createDataFrame([("a", 3), ("b", 1)], "g string, n bigint")
    assert rows(summaries.top_k_and_other(few, "g", 6), "g", "n") == [("a", 3), ("b", 1)]
    named = spark.createDataFrame([("Other", 5), ("a", 3), ("b", 2), ("c", 1)], "g string, n bigint")
    got = summaries.top_k_and_other(named, "g", 2).collect()
    assert [(r.g, r.is_rest, r.n) for r in got] == [("Other", False, 5), ("a", False, 3), ("Other", True, 3)]


def test_rows_without_a_value_are_no_value(spark):
    values = [(None,)] * 5 + [("a",)] * 3 + [("b",)] * 2 + [("c",)]
    df = spark.createDataFrame(values, "g string")
    assert rows(summaries.value_counts(df, "g"), "g", "n") == [("a", 3), ("b", 2), ("c", 1)]
    with_nulls = df.groupBy("g").agg(F.count("*").alias("n"))
    got = summaries.top_k_and_other(with_nulls, "g", 2).collect()
    assert [(r.g, r.n) for r in got] == [("a", 3), ("b", 2), ("Other", 1)]


def test_small_shares_have_no_label(spark):
    counts = spark.createDataFrame([("a", 993), ("b", 7)], "g string, n bigint")
    assert rows(summaries.shares(counts, "g"), "g", "pct", "label") == [("a", 99.3, "99.3%"), ("b", 0.7, None)]


@pytest.mark.parametrize("seed", range(6))
def test_histogram_equals_numpy(spark, seed):
    rng = random.Random(seed)
    bins = rng.choice([1, 7, 30])
    values = [round(rng.choice([rng.uniform(1, 5), rng.randint(5, 25) / 5]), 4) for _ in range(300)] + [1.0, 5.0]
    if seed == 0:
        values, bins = [2.5] * 4, 30
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "x double")
    got = summaries.histogram(df, "x", bins).orderBy("bin").collect()
    want, edges = np.histogram(values, bins=bins)
    assert [r.n for r in got] == want.tolist()
    assert [r.bin_low for r in got] == edges[:-1].tolist()


# Ranking and splits


def test_dense_positions(plan, spark):
    df = spark.createDataFrame([(i * 7919 % 1009, 1) for i in range(1, 1009)], "k bigint, one int").repartition(5)
    got = ranking.dense_positions(df, ["k"]).orderBy("k").collect()
    assert [r.position for r in got] == list(range(1008))


def test_more_rows_per_key_than_spark_cuts(plan, spark):
    """A limit above Spark's own is numbered in parallel, with null keys too."""
    rows_in = [(None if i % 5 == 0 else i % 2, i) for i in range(4000)]
    df = spark.createDataFrame(rows_in, "k int, v bigint").repartition(6)
    got = ranking.top_n_per_key(df, ["k"], [F.desc("v")], 1500)
    by_key = {}
    for key, value in sorted(rows_in, key=lambda r: -r[1]):
        by_key.setdefault(key, []).append(value)
    want = {(k, v, i) for k, values in by_key.items() for i, v in enumerate(values[:1500], 1)}
    assert {tuple(r) for r in got.collect()} == want
    assert dict(got.dtypes)["rank"] == "int"


def hot_events(rows=400):
    rng = random.Random(5)
    return [(i, 1 if rng.random() < 0.4 else rng.randint(2, 30)) for i in rng.sample(range(10**6), rows)]


EVENTS = hot_events()


@pytest.fixture(scope="module")
def events(spark):
    return spark.createDataFrame(EVENTS, "event_id bigint, user_id bigint").repartition(4)


@pytest.mark.parametrize("start, stop, max_test", [(1, 10, 0), (11, 20, 0), (1, 10, 37), (1, 1200, 0), (1, 10, 9999)])
def test_holdout(plan, events, start, stop, max_test):
    got = splits.holdout(events, "event_id", start, stop, max_test)
    assert {r.event_id: r.role for r in got.collect()} == brute.holdout(EVENTS, start, stop, max_test)


def test_ordinals(plan, events):
    got = {r.event_id: r.ordinal for r in ranking.ordinals(events, "user_id", ["event_id"]).collect()}
    seen, want = {}, {}
    for event, user in sorted(EVENTS):
        want[event] = seen[user] = seen.get(user, 0) + 1
    assert got == want
    wide = events.withColumn("more", F.col("event_id") * 2)
    numbered = ranking.with_ordinals(wide, "user_id", "event_id")
    assert {r.event_id: (r.ordinal, r.more) for r in numbered.collect()} == {e: (n, 2 * e) for e, n in want.items()}


@pytest.mark.parametrize("k", [1, 5, 7])
def test_folds_are_blocks_of_equal_size(plan, events, k):
    assigned = splits.kfold_assign(events, "event_id", k)
    folds = [r.fold for r in assigned.orderBy("event_id").collect()]
    assert folds == sorted(folds) and set(folds) == set(range(1, k + 1))
    sizes = [folds.count(i) for i in range(1, k + 1)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(EVENTS)
    for fold in (1, k):
        test, base = splits.fold_split(assigned, fold)
        ids = {r.event_id for r in test.collect()}, {r.event_id for r in base.collect()}
        assert not ids[0] & ids[1] and len(ids[0]) + len(ids[1]) == len(EVENTS)


@pytest.mark.parametrize("low, high", [(0, 50), (0, 2**40), (-(2**63), 2**63 - 1), (-(2**20), 2**10), (2**62, 2**62 + 9000)])
def test_keys_at_positions_equal_the_sorted_list(spark, low, high):
    rng = random.Random(low + high)
    keys = [rng.randint(low, high) for _ in range(700)] + [low, high]
    df = spark.createDataFrame([(key,) for key in keys] + [(None,)], "k bigint").repartition(5)
    asked = [0, 1, 350, 351, 700, 701, 702, 5000]
    assert splits.keys_at_positions(df, "k", asked) == [sorted(keys)[at] for at in asked if at < len(keys)]
    assert splits.keys_at_positions(df.where("false"), "k", asked) == []


def test_holdout_of_rows_without_a_key(plan, spark):
    rows_in = [(i, None if i % 2 else 3) for i in range(40)]
    got = splits.holdout(spark.createDataFrame(rows_in, "event_id bigint, user_id bigint"), "event_id", 2, 4)
    assert {r.event_id for r in got.collect() if r.role == "test"} == {2, 3, 4, 5, 6, 7}


@pytest.mark.parametrize("n", [0, 1, 3, 5, 6])
def test_folds_of_few_rows(spark, n):
    events = spark.createDataFrame([(10 * i, 1) for i in range(n)], "event_id bigint, user_id bigint")
    got = splits.kfold_assign(events, "event_id", 5).orderBy("event_id").collect()
    assert [r.fold for r in got] == [i * 5 // n + 1 for i in range(n)]


# Shapes


@pytest.fixture(scope="module")
def flat(ratings, items):
    return recommend.best_unrated(ratings, items, 5, 5, "asc", labels=LABELS)


def test_wide_and_back(flat):
    wide = reshape.to_wide(flat)
    back = reshape.wide_to_list(wide)
    want = flat.select(
        text.row_key("user_id").alias("row_key"), "rank", "item_id", "title", text.fixed4("avg_rating").alias("m")
    )
    assert rows(back, "row_key", "rank", "item_id", "title", "avg_rating") == rows(want, "*")


def test_wide_lists_have_defaults(spark):
    flat = spark.createDataFrame(
        [(3, 1, 30, "x", 4.5, "War")],
        "user_id bigint, rank int, item_id bigint, title string, avg_rating double, fav_genre string",
    )
    for n in (3, 5, 10):
        got = rows(reshape.wide_to_full_list(reshape.to_wide(flat, n)), "rank", "movie_id", "title", "avg_rating")
        assert got[0] == (1, "30", "x", "4.5000")
        assert got[1:] == [(k, "N/A", "Unknown Title", "N/A") for k in range(2, n + 1)]


def test_documents_and_back(flat):
    documents = reshape.to_documents(flat)
    back = reshape.flatten_documents(documents)
    want = flat.select("user_id", "fav_genre", "rank", "item_id", "title", "avg_rating")
    assert rows(back, "*") == rows(want, "*")
    for row in documents.collect():
        assert [e.avoid_rank for e in row.blacklisted_movies] == list(range(1, len(row.blacklisted_movies) + 1))


def test_documents_of_one_user(flat):
    found = lookup.lookup(reshape.to_documents(flat), 1).collect()
    assert [(r._id, r.found) for r in found] == [("user_000001", True)]
    assert found[0].blacklisted_movies[0].avoid_rank == 1


def test_matrix_keeps_the_latest_cell_in_bounded_maps(plan, spark, ratings, monkeypatch):
    monkeypatch.setattr(reshape, "SEGMENT", 16)
    matrix = reshape.rating_matrix(ratings)
    assert matrix.select(F.max(F.size("ratings"))).first()[0] <= 16
    want = {(user, item): rating for user, item, rating, _ in sorted(RATINGS, key=lambda r: (r[3], r[2]))}
    got = {(r.user_id, r.item_id): r.rating for r in reshape.matrix_cells(matrix).collect()}
    assert got == want
    ones = {key: rating for key, rating in want.items() if key[0] == 1}
    fetched = {(r.user_id, r.item_id): r.rating for r in reshape.fetch_rows(matrix, [1, 777]).collect()}
    assert fetched == ones
    asked = spark.createDataFrame([(1,), (777,)], "user_id bigint")
    fetched = {(r.user_id, r.item_id): r.rating for r in reshape.rows_of_ratings(ratings, asked).collect()}
    assert fetched == ones


@pytest.mark.parametrize("kind", ["double", "int", "decimal(4,1)"])
def test_matrix_of_ratings_below_zero_and_between(spark, kind):
    cells = [(1, 5, -2.5, 10), (1, 5, 4.5, 10), (1, 5, 9.0, 9), (2, 7, -1.0, 1)]
    ratings = spark.createDataFrame(cells, "user_id bigint, item_id bigint, rating double, ts bigint")
    ratings = ratings.withColumn("rating", F.col("rating").cast(kind))
    got = {(r.user_id, r.item_id): float(r.rating) for r in reshape.matrix_cells(reshape.rating_matrix(ratings)).collect()}
    assert got == {(1, 5): 4.0 if kind == "int" else 4.5, (2, 7): -1.0}


def test_lookup_answers_for_every_id(flat):
    got = lookup.lookup(flat, [1, -1]).collect()
    assert {r.user_id: r.found for r in got} == {1: True, -1: False}
    assert {r.user_id for r in lookup.lookup(flat, 1).collect()} == {1}


# Text


def test_two_decimals_round_like_printf(spark):
    values = [3.125, 2.625, 3.025, 1.015, 1.005, 4.0, 4.995, 2.675, 1 / 3, 5.0, 3.135, 1.985, 14 / 3]
    values += [round(random.Random(3).uniform(1, 5), 3) for _ in range(200)]
    got = spark.createDataFrame([(v,) for v in values], "x double").select("x", text.fixed2("x").alias("t")).collect()
    assert [r.t for r in got] == [f"{r.x:.2f}" for r in got]


def test_keys_and_labels(spark):
    row = spark.range(1).select(
        text.row_key(F.lit(42)).alias("key"),
        text.fixed4(F.lit(1234.5)).alias("fixed"),
        text.support_label(F.lit(4.4911), F.lit(112)).alias("label"),
        text.gender_label(F.lit("M")).alias("m"),
        text.gender_label(F.lit("X")).alias("x"),
        text.shortened(F.lit("a" * 50)).alias("short"),
        text.or_default(F.lit(None).cast("string"), "N/A").alias("missing"),
    ).first()
    assert tuple(row) == ("user_000042", "1234.5000", "4.4911  (112 ratings)", "Male", "Female", "a" * 41, "N/A")
