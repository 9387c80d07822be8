"""Keyed tables with a manifest: what lookups open, and what merges write."""

import hashlib
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tastegrid import sinks, sources
from tastegrid.operators import lookup
from tastegrid.sinks.tables import CELLS

KEYED = "k int, word string, at int"


@pytest.fixture(autouse=True)
def several_files(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def files_of(path) -> dict[str, str]:
    return {one.name: hashlib.md5(one.read_bytes()).hexdigest() for one in Path(path).glob("*.parquet")}


def test_lookup_opens_the_files_that_can_match(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(1000).select(F.col("id").alias("user_id"), (F.col("id") * 2).alias("x"))
    sinks.replace_keyed(rows, path, ["user_id"])
    assert len(files_of(path)) > 4 and sources.read_table(spark, path).count() == 1000
    assert len(sources.read_ids(spark, path, "user_id", [500]).inputFiles()) == 1
    assert sources.read_ids(spark, path, "user_id", [5000]).inputFiles() == []
    found = lookup.lookup_stored(spark, path, [3, 999, 5000]).collect()
    assert {(r.user_id, r.x, r.found) for r in found} == {(3, 6, True), (999, 1998, True), (5000, None, False)}
    with pytest.raises(ValueError):
        sources.read_ids(spark, path, "x", [4])


def test_lookup_of_a_key_over_several_files_of_names_and_of_nulls(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(4000).selectExpr("IF(id < 3000, 'hot', IF(id < 3010, NULL, concat('n', id))) AS name", "id")
    sinks.replace_keyed(rows, path, ["name", "id"])
    assert sources.read_ids(spark, path, "name", ["hot"]).count() == 3000
    assert sources.read_ids(spark, path, "name", ["n3500"]).count() == 1
    empty = str(tmp_path / "e")
    sinks.replace_keyed(rows.limit(0), empty, ["name"])
    assert sources.read_ids(spark, empty, "name", ["hot"]).collect() == []


def test_lookup_without_a_manifest_filters_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.replace_table(spark.range(100), path, ["id"])
    assert [r.id for r in sources.read_ids(spark, path, "id", [7, 300]).collect()] == [7]


def merged_by_hand(base, changes):
    table = {row[0]: row for row in base}
    newest = {}
    for row in changes:
        if row[0] not in newest or row[2] > newest[row[0]][2]:
            newest[row[0]] = row
    return {**table, **newest}


def test_merge_replaces_by_key_and_leaves_other_files(spark, tmp_path):
    path = str(tmp_path / "t")
    base = [(k, f"old{k}", 5) for k in range(0, 2000, 2)]
    sinks.replace_keyed(spark.createDataFrame(base, KEYED), path, ["k"])
    before = files_of(path)
    # Older by time, yet written later; a new key between others; one key twice.
    changes = [(1000, "new", 1), (1001, "between", 1), (1001, "later", 2), (1002, "new", 9)]
    sinks.merge_keyed(spark.createDataFrame(changes, KEYED).repartition(3), path, ["k"], [F.desc("at")])
    after = files_of(path)
    assert len(before) > 4 and len(before.keys() - after.keys()) in (1, 2)
    assert all(before[name] == after[name] for name in before.keys() & after.keys())
    want = sorted(merged_by_hand(base, changes).values())
    for read in (sources.read_keyed(spark, path), sources.read_table(spark, path)):
        assert sorted(tuple(row) for row in read.collect()) == want
    listed = sources.read_manifest(spark, path)
    assert {row.file for row in listed.collect()} == after.keys()
    assert listed.agg(F.sum("rows")).first()[0] == len(want)


def test_merges_of_edges(spark, tmp_path):
    path = str(tmp_path / "t")
    newest = [F.desc("at")]
    frame = lambda rows: spark.createDataFrame(rows, KEYED)
    state, steps = {}, [
        [(5, "a", 1), (5, "b", 2), (9, "c", 1)],  # no table yet
        [],
        [(None, "none", 1), (-7, "first", 1), (100, "last", 1)],
        [(None, "other", 0), (5, None, 0)],
        [(k, "all", 3) for k in range(-20, 120)],
    ]
    for step in steps:
        sinks.merge_keyed(frame(step).select("word", "at", "k"), path, ["k"], newest)
        state = merged_by_hand(state.values(), step)
        got = {tuple(row) for row in sources.read_keyed(spark, path).select("k", "word", "at").collect()}
        assert got == set(state.values())


def test_merge_on_several_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    base = spark.range(900).selectExpr("id % 3 AS a", "id AS b", "'old' AS word", "0 AS at")
    sinks.replace_keyed(base, path, ["a", "b"])
    sinks.merge_keyed(base.where("b >= 450").withColumn("word", F.lit("new")), path, ["a", "b"], [F.desc("at")])
    words = {row.word: row["count"] for row in sources.read_keyed(spark, path).groupBy("word").count().collect()}
    assert words == {"old": 450, "new": 450}


def test_a_failed_merge_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.replace_keyed(spark.createDataFrame([(k, "old", 0) for k in range(50)], KEYED), path, ["k"])
    before, names = files_of(path), set(os.listdir(path))
    broken = spark.createDataFrame([(3, "x", 1)], KEYED).withColumn("word", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        sinks.merge_keyed(broken, path, ["k"], [F.desc("at")])
    assert files_of(path) == before and set(os.listdir(path)) == names
    # A file that a broken merge left behind goes with the next merge.
    spark.createDataFrame([(3, "stray", 1)], KEYED).coalesce(1).write.mode("append").parquet(path)
    sinks.merge_keyed(spark.createDataFrame([(4, "new", 1)], KEYED), path, ["k"], [F.desc("at")])
    assert sources.read_table(spark, path).where("word = 'stray'").count() == 0
    with pytest.raises(ValueError):
        plain = str(tmp_path / "plain")
        sinks.replace_table(spark.range(3), plain, ["id"])
        sinks.merge_keyed(spark.range(3), plain, ["id"], [F.desc("id")])


def test_equal_tables_are_told_by_checksums_alone(spark):
    rows = spark.range(5000).selectExpr("id % 700 AS a", "IF(id % 3 = 0, NULL, id / 7) AS b", "array(id, NULL) AS c")
    assert sinks.differences(rows.repartition(7), rows).isEmpty()
    plan = sinks.checksums(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_sum" in plan
    assert rows.count() and sinks.checksums(rows).count() <= CELLS


def test_differences_are_found_wherever_they_are(spark):
    kind = "a string, b string, c array<string>"
    one = [("x", None, ["p", None]), ("x", None, ["p", None]), ("y", "z", None)]
    for other in (
        [(None, "x", ["p", None]), one[1], one[2]],
        [("x", None, [None, "p"]), one[1], one[2]],
        [("x", None, []), one[1], one[2]],
        one[1:],
        [*one, one[2]],
        [],
    ):
        left, right = spark.createDataFrame(one, kind), spark.createDataFrame(other, kind)
        got = sorted(map(repr, sinks.differences(left, right).collect()))
        want = sorted(map(repr, left.exceptAll(right).unionAll(right.exceptAll(left)).collect()))
        assert got == want and got
