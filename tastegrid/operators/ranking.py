"""Top rows per key and dense positions, without one task holding a hot key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tastegrid.session import pin

# monotonically_increasing_id() puts the partition above bit 33, the row below.
ROW_BITS = 33


def group_limit(spark: SparkSession) -> int:
    """Largest number of rows per key that Spark cuts to before a shuffle."""
    return int(spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))


def top_n_per_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], n: int, name: str = "rank"
) -> DataFrame:
    """The first ``n`` rows of each key with their rank from 1.

    The filter sits right on the window, so Spark keeps ``n`` rows per key in
    each map task before the shuffle. It does so up to ``group_limit`` rows; for
    more the rows are numbered in parallel, and ``order_by`` must be unique.
    """
    if n > group_limit(df.sparkSession):
        numbered = ordinals(df, keys, order_by, name)
        return numbered.where(F.col(name) <= n).withColumn(name, F.col(name).cast("int"))
    ranks = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by))
    return df.withColumn(name, ranks).where(F.col(name) <= n)


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    return top_n_per_key(df, keys, order_by, 1, "_first").drop("_first")


def stored_in_order(df: DataFrame, order_by: Sequence[Column | str]) -> DataFrame:
    """Rows range-partitioned, sorted and stored, with ``_part``, the stored
    partition, and ``_slot``, which grows with the order inside of it."""
    ranged = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    pinned = pin(ranged.withColumn("_slot", F.monotonically_increasing_id()))
    return pinned.withColumn("_part", F.shiftright("_slot", ROW_BITS))


def _numbered(df: DataFrame, order_by: Sequence[Column | str], name: str) -> DataFrame:
    """Rows with their position and ``_part``, the stored partition they are in."""
    slots = stored_in_order(df, order_by)
    sizes = slots.groupBy("_part").agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    in_part = F.col("_slot").bitwiseAND((1 << ROW_BITS) - 1)
    placed = slots.join(F.broadcast(offsets), "_part")
    return placed.withColumn(name, F.col("_offset") + in_part).drop("_slot", "_offset")


def dense_positions(df: DataFrame, order_by: Sequence[Column | str], name: str = "position") -> DataFrame:
    """Number all rows 0, 1, 2, … in ``order_by`` order, in parallel.

    ``order_by`` must be unique. Rows are range-partitioned and sorted, and
    stored once so that the sizes and the numbering see the same partitions;
    pass only the columns that are needed. The offsets hold one row per
    partition, which bounds their broadcast.
    """
    return _numbered(df, order_by, name).drop("_part")


def ordinals(
    df: DataFrame, keys: str | Sequence[str], order_by: Sequence[Column | str], name: str = "ordinal"
) -> DataFrame:
    """Running number per key from 1, for keys too large for one window task.

    The start of each key is joined by key and stored partition, so the rows of
    a very large key stay as spread out as they were stored. All columns are
    stored: ``with_ordinals`` stores the keys and the order only.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    numbered = _numbered(df, [*keys, *order_by], "_position")
    pieces = numbered.groupBy("_part", *keys).agg(F.min("_position").alias("_piece"))
    starts = pieces.select(
        F.col("_part").alias("_start_part"),
        *[F.col(key).alias(f"_key{at}") for at, key in enumerate(keys)],
        F.min("_piece").over(Window.partitionBy(*keys)).alias("_start"),
    )
    same = [F.col("_part") == F.col("_start_part")]
    same += [F.col(key).eqNullSafe(F.col(f"_key{at}")) for at, key in enumerate(keys)]
    return (
        numbered.join(starts, reduce(and_, same))
        .withColumn(name, F.col("_position") - F.col("_start") + 1)
        .drop("_part", "_start_part", "_position", "_start", *[f"_key{at}" for at in range(len(keys))])
    )


def with_ordinals(df: DataFrame, key: str, order_by: str, name: str = "ordinal") -> DataFrame:
    """``df`` with the running number per key. Only the two columns are stored;
    the numbers come back by ``order_by``, which is unique."""
    numbers = ordinals(df.select(key, order_by), key, [order_by], name)
    return df.join(numbers.select(order_by, name), order_by)


def _small(df: DataFrame) -> bool:
    """Whether Spark's estimate lets it broadcast ``df`` by itself."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= limit


def salted_join(
    facts: DataFrame, keyed: DataFrame, key: str, spread: str, how: str = "inner", salts: int | None = None
) -> DataFrame:
    """Join by ``key`` when one key may hold much of ``facts``.

    A small ``keyed`` is left to Spark, which broadcasts it. Spark splits a hot
    key by itself if both sides are shuffled for the join. It cannot if
    ``keyed`` is partitioned by the key already, as the result of a group or
    join on it. So the key is salted: ``facts`` by the value of ``spread``,
    ``keyed``, the smaller side, once per salt. There are as many salts as the
    cluster has task slots, 32 at most, as each is a copy of ``keyed``.
    """
    if _small(keyed):
        return facts.join(keyed, key, how)
    salts = salts or max(2, min(32, facts.sparkSession.sparkContext.defaultParallelism))
    salt = F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")
    copies = keyed.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return facts.withColumn("_salt", salt).join(copies, [key, "_salt"], how).drop("_salt")
