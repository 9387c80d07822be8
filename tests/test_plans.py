"""Physical plans: what must be in them at scale, and what must not."""

import re

import pytest
from pyspark.sql import functions as F

from tastegrid import sinks, sources
from tastegrid.operators import cohorts, lookup, preferences, ranking, recommend, reshape, splits, summaries
from tastegrid.operators import ratings as rating_ops
from tastegrid.plans import testviews

SF_DIR = "/root/testdata/sf0.001"


def executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.fixture
def views(spark):
    return testviews.ratings(spark, SF_DIR), testviews.items(spark, SF_DIR), testviews.users(spark, SF_DIR)


def single_partition_windows(plan: str) -> int:
    """Windows over all rows that do not number partitions or a limited list."""
    return sum(
        "SinglePartition" in part and "_part" not in part and "TakeOrdered" not in part
        for part in re.split(r"(?=\bWindow \[)", plan)[1:]
    )


def test_filters_and_columns_reach_the_scan(spark, views):
    users = views[2]
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = cohorts.users_below(users, 0, "balance")._jdf.queryExecution().toString()
    assert "LessThan(c_acctbal,0.0)" in plan
    plan = cohorts.users_of_group(users, "MACHINERY", 3000, 4000, "balance")._jdf.queryExecution().toString()
    assert "EqualTo(c_mktsegment,MACHINERY)" in plan and "GreaterThanOrEqual(c_acctbal,3000.0)" in plan
    plan = rating_ops.item_stats(testviews.item_ratings(spark, SF_DIR))._jdf.queryExecution().toString()
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in plan


def test_recommendation_plan(spark, views, no_broadcast):
    ratings, items, _ = views
    words = testviews.words(spark, SF_DIR)
    plan = executed(recommend.best_unrated(ratings, items, labels=words))
    plan = plan.split("== Initial Plan ==")[0]
    assert "LeftAnti" not in plan and "Window" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    # Ratings of places in reach are folded to words before they are shuffled; none go by item and user.
    shuffles = re.findall(r"- Exchange hashpartitioning\(user_id#\d+L(.*?), \d+\)", plan)
    assert len([keys for keys in shuffles if keys.count("_groupingexpression") == 2]) == 1
    assert len([keys for keys in shuffles if re.fullmatch(r", genre#\d+", keys)]) == 2 and len(shuffles) == 3
    # The stored ranking is read for the titles and for the places of items, the stretches once.
    assert len(re.findall(r"FileScan parquet .*pinned-", plan)) == 3


def test_large_limits_leave_no_window_per_key(spark):
    events = testviews.events(spark, SF_DIR).select("user_id", "event_id")
    plan = executed(ranking.top_n_per_key(events, ["user_id"], [F.col("event_id")], 1500))
    windows = re.findall(r"Window \[.*", plan)
    assert windows and all("_part" in line or "_piece" in line for line in windows)


def test_cohort_joins_sort_nothing(spark, views):
    ratings, items, users = views
    cohort = cohorts.users_below(users, 0, "balance")
    plan = cohorts.cohort_top_items(ratings, cohort, items)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Sort [") == 1
    plan = reshape.rows_of_ratings(ratings, cohort)._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort [" not in plan and plan.index("Aggregate") < plan.index("LeftSemi")


def test_favourites_take_one_shuffle_after_the_item_join(spark, views):
    ratings, items, _ = views
    plan = executed(preferences.favourite_category(ratings, items, 50, testviews.words(spark, SF_DIR)))
    assert len(re.findall(r"- Exchange hashpartitioning\(user_id#", plan)) == 1
    assert "Generate" not in plan and "SortAggregate" not in plan


def test_averages_aggregate_before_the_join(spark):
    items, ratings = testviews.items(spark, SF_DIR), testviews.item_ratings(spark, SF_DIR)
    plan = executed(rating_ops.item_averages(ratings, items))
    assert plan.index("Join [item_id") < plan.index("functions=[avg(rating")
    top = executed(rating_ops.top_items(ratings, items))
    assert "TakeOrderedAndProject" in top


def test_folds_leave_the_rows_in_place(spark):
    events = testviews.events(spark, SF_DIR)
    assigned = splits.kfold_assign(events, "event_id", 5)
    plan = executed(assigned)
    assert "Exchange" not in plan and "Subquery" not in plan and "pinned-" not in plan


def test_holdout_cuts_before_the_shuffle(spark):
    plan = executed(splits.holdout(testviews.events(spark, SF_DIR), "event_id", 1, 10))
    assert plan.index("WindowGroupLimit") < plan.index("Exchange hashpartitioning(user_id")
    assert plan.count("WindowGroupLimit") == 2
    assert not re.search(r"Exchange hashpartitioning\([^)]*event_id", plan)


def test_summaries_reuse_the_counts(spark, views):
    counts = summaries.value_counts(views[2], "occupation")
    assert "ReusedExchange" in executed(summaries.top_k_and_other(counts, "occupation", 2))
    assert "ReusedExchange" in executed(summaries.shares(counts, "occupation"))


def test_lookup_filters_in_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.replace_table(spark.range(1000).withColumnRenamed("id", "user_id"), path, ["user_id"])
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = executed(lookup.lookup(sources.read_table(spark, path), [3, 5, 5000]))
    assert "PushedFilters: [In(user_id, [3,5,5000])" in plan


@pytest.fixture
def small_skew_limits(spark):
    sizes = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    for key, value in sizes.items():
        spark.conf.set(key, value)
    yield
    for key in sizes:
        spark.conf.unset(key)


def test_hot_user_is_spread_before_a_join_with_a_grouped_side(spark, no_broadcast):
    """No partition of the salted join holds a third of the rows."""
    n = 120_000
    ratings = spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 1000 + 2).alias("user_id"),
        (F.col("id") % 97).alias("item_id"),
        F.lit(3).alias("rating"),
    )
    active = preferences.active_users(ratings, 2)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    kept = cohorts.ratings_of(ratings, active)
    assert kept.columns == ratings.columns
    sizes = [r["count"] for r in kept.groupBy(F.spark_partition_id()).count().collect()]
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == n and max(sizes) < n / 3


def test_hot_item_is_split_in_the_join(spark, no_broadcast, small_skew_limits):
    """A third of the ratings name one item; the adaptive plan cuts its partition."""
    n = 200_000
    ratings = spark.range(0, n, 1, 8).select(
        (F.col("id") % 5000).alias("user_id"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 1000 + 2).alias("item_id"),
    )
    items = spark.range(1, 1003).select(
        F.col("id").alias("item_id"), F.array(F.when(F.col("id") == 1, "Hot").otherwise("Cold")).alias("genres")
    )
    result = preferences.favourite_category(ratings, items, 1, ["Hot", "Cold"])
    plan = executed(result)
    assert "skew=true" in plan
    assert result.count() == 5000
