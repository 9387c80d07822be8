"""Train and test splits for evaluation.

Both work by input order, given as a column that is unique per row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastegrid.operators.ranking import dense_positions, top_n_per_key
from tastegrid.session import pin

TEST, BASE = "test", "base"
# Values are counted by so many bits in one pass.
_RANGE_BITS = 12


def keys_at_positions(df: DataFrame, order_by: str, positions: Sequence[int]) -> list[int]:
    """The values of a unique column at 0-based positions of its ascending
    order, without sorting; positions beyond the rows are left out.

    Values are counted by their leading bits, then those that share their leading
    bits with a position that is asked for by the next bits, and so on. A pass
    reads one column, and sends a count per range from each task to the driver,
    ``2 ** _RANGE_BITS`` of them per position at most. Columns that hold no whole
    numbers, such as places in files, have no such bits and are sorted.
    """
    kind = df.schema[order_by].dataType
    if not isinstance(kind, T.IntegralType):
        numbered = dense_positions(df.select(order_by), [order_by])
        rows = numbered.where(F.col("position").isin(list(positions))).collect()
        return [row[order_by] for row in sorted(rows, key=lambda row: row["position"]) for _ in range(positions.count(row["position"]))]
    values = df.select(F.col(order_by).cast("bigint").alias("_key")).where("_key IS NOT NULL")
    total, least, most = values.agg(F.count("*"), F.min("_key"), F.max("_key")).first()
    asked = [position for position in positions if position < total]
    if not asked:
        return []
    bits = 64 if (least < 0) != (most < 0) else (least ^ most).bit_length()
    # Of each value that is asked for: its leading bits, and its position among
    # the values that begin with them.
    places: list[tuple[int | None, int]] = [(None, position) for position in asked]
    while True:
        shift = max(0, bits - _RANGE_BITS)
        known = {prefix for prefix, _ in places if prefix is not None}
        within = values.where(F.shiftright("_key", bits).isin(known)) if known else values
        ranges = sorted(within.groupBy(F.shiftright("_key", shift).alias("range")).count().collect())
        by_prefix: dict[int | None, list] = {}
        for start, rows in ranges:
            by_prefix.setdefault(start >> (bits - shift) if known else None, []).append((start, rows))
        places = [_range_at(by_prefix[prefix], position) for prefix, position in places]
        if not shift:
            return [value for value, _ in places]
        bits = shift


def _literal(df: DataFrame, column: str, value) -> Column:
    kind = df.schema[column].dataType
    if isinstance(kind, T.StructType):
        return F.struct(*[F.lit(value[field.name]).cast(field.dataType).alias(field.name) for field in kind])
    return F.lit(value).cast(kind)


def _range_at(ranges: list[tuple[int, int]], position: int) -> tuple[int, int]:
    """The range that holds a position, and the position within it."""
    for start, rows in ranges:
        if position < rows:
            return start, position
        position -= rows
    raise ValueError("the rows have changed while they were counted")


def kfold_assign(df: DataFrame, order_by: str, k: int = 5) -> DataFrame:
    """Add ``fold`` 1..k: row i of n, from 0, is in fold ``i * k // n + 1``, so
    folds are consecutive blocks whose sizes differ by one at most. With fewer
    rows than folds some folds are empty.

    Of a column of unique whole numbers nothing is sorted, stored or
    shuffled: counts of ranges single out the first key of each block, which then
    tells the fold of each row where it is.
    """
    total = df.agg(F.count(order_by)).first()[0]
    starts = keys_at_positions(df, order_by, [-(-block * total // k) for block in range(1, k)])
    passed = [(F.col(order_by) >= _literal(df, order_by, start)).cast("int") for start in starts]
    return df.withColumn("fold", F.coalesce(reduce(add, passed, F.lit(1)), F.lit(1)))


def fold_split(assigned: DataFrame, fold: int) -> tuple[DataFrame, DataFrame]:
    """Test and training rows of one fold."""
    rows = assigned.drop("fold")
    return rows.where(assigned["fold"] == fold), rows.where(assigned["fold"] != fold)


def fold_sizes(assigned: DataFrame, k: int = 5) -> DataFrame:
    """Rows per split and role, from one count per fold."""
    counts = assigned.groupBy("fold").agg(F.count("*").alias("n"))
    splits = counts.withColumn("split", F.explode(F.sequence(F.lit(1), F.lit(k))))
    role = F.when(F.col("split") == F.col("fold"), TEST).otherwise(BASE)
    return splits.groupBy("split", role.alias("role")).agg(F.sum("n").alias("n"))


def holdout(
    df: DataFrame, order_by: str, start: int, stop: int, max_test: int = 0, key: str = "user_id"
) -> DataFrame:
    """Add ``role``: test for the ``start``-th to ``stop``-th row of each key,
    as long as fewer than ``max_test`` test rows came before (0: no limit).

    Only the first ``stop`` rows per key are ranked, cut in each map task, so a
    key with very many rows is no burden. Their first and last ``order_by`` value,
    a unique one, are a range per key that tells the test rows of the table. So
    it is joined by key, by broadcast or in a shuffle that Spark can split, and
    not by its unique column. The limit is one more value, found by counting.
    """
    early = top_n_per_key(df.select(key, order_by), [key], [F.col(order_by)], stop, "ordinal")
    test = early.where(F.col("ordinal") >= start)
    if max_test > 0:
        test = pin(test)
        over = keys_at_positions(test, order_by, [max_test])
        test = test.where(F.col(order_by) < _literal(test, order_by, over[0])) if over else test
    ranges = test.groupBy(key).agg(F.min(order_by).alias("_first"), F.max(order_by).alias("_last"))
    # A struct is not null, so that rows without a key meet their range, too.
    ranges = ranges.select(F.struct(key).alias("_of"), "_first", "_last")
    ranged = df.withColumn("_of", F.struct(key)).join(ranges, "_of", "left")
    is_test = F.col(order_by).between(F.col("_first"), F.col("_last"))
    return ranged.withColumn("role", F.when(is_test, TEST).otherwise(BASE)).drop("_of", "_first", "_last")


def in_rating_order(split: DataFrame) -> DataFrame:
    """Sorted by user and item, then by the other columns."""
    rest = [name for name in split.columns if name not in ("user_id", "item_id")]
    return split.orderBy("user_id", "item_id", *rest)
