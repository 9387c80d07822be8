"""Writes with the key semantics of a keyed store, on plain files."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastegrid.operators.ranking import first_per_key
from tastegrid.session import remove_path

#: Cells that the rows of two tables are compared by.
CELLS = 1024


def keep_one_per_key(df: DataFrame, key: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """A later row with the same key replaces the earlier one."""
    return first_per_key(df, key, newest_first)


def swap_in(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Let ``write`` fill a folder beside ``path``, and put it in its place.

    A reader finds the old table or the new one, but for the moment between two
    renames, and a write that fails leaves the old one as it was.
    """
    mark = uuid.uuid4().hex
    fresh, old = f"{path.rstrip('/')}.new-{mark}", f"{path.rstrip('/')}.old-{mark}"
    try:
        write(fresh)
    except BaseException:
        remove_path(spark, fresh)
        raise
    to_path = spark._jvm.org.apache.hadoop.fs.Path
    files = to_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    replaced = files.exists(to_path(path)) and files.rename(to_path(path), to_path(old))
    files.mkdirs(to_path(path).getParent())
    if not files.rename(to_path(fresh), to_path(path)):
        raise RuntimeError(f"could not move {fresh} to {path}")
    if replaced:
        remove_path(spark, old)


def replace_table(
    df: DataFrame,
    path: str,
    key: Sequence[str],
    newest_first: Sequence[Column] = (),
    also: Callable[[str], None] | None = None,
) -> None:
    """Overwrite a keyed table, in key order, so that lookups skip row groups.

    Without ``newest_first`` the rows must be unique by ``key`` already. ``also``
    gets the folder before it is swapped in.
    """
    rows = keep_one_per_key(df, key, newest_first) if newest_first else df
    write_clustered(rows, path, key, also=also)


def write_clustered(
    df: DataFrame,
    path: str,
    key: Sequence[str],
    partition_by: Sequence[str] = (),
    also: Callable[[str], None] | None = None,
) -> None:
    """Rows in order of partition and clustering columns. Ranges, unlike
    hashes, split the rows of a very large partition over several files."""
    ordered = df.repartitionByRange(*key).sortWithinPartitions(*key)

    def write(fresh: str) -> None:
        ordered.write.partitionBy(*partition_by).parquet(fresh)
        if also:
            also(fresh)

    swap_in(df.sparkSession, path, write)


def write_export(df: DataFrame, path: str) -> None:
    """Headered CSV; quotes inside text are doubled, and blanks around it stay."""
    writer = df.write.option("header", True).option("escape", '"')
    for side in ("ignoreLeadingWhiteSpace", "ignoreTrailingWhiteSpace"):
        writer = writer.option(side, False)
    swap_in(df.sparkSession, path, writer.csv)


def _row_hashes(df: DataFrame) -> list[Column]:
    """Two 64-bit hashes of whole rows. Hashes pass over nulls, so the places of
    nulls are hashed too, and nested values as their text."""
    nested = (T.ArrayType, T.StructType)
    values = [
        F.to_json(F.struct(F.col(f"`{field.name}`"))) if isinstance(field.dataType, nested) else F.col(f"`{field.name}`")
        for field in df.schema
    ]
    values += [F.isnull(f"`{name}`") for name in df.columns]
    return [F.xxhash64(F.lit(seed), *values) for seed in (1, 2)]


def _cell(df: DataFrame) -> Column:
    return F.pmod(_row_hashes(df)[0], F.lit(CELLS)).cast("int")


def checksums(df: DataFrame) -> DataFrame:
    """(cell, rows, sum_a, sum_b): rows dealt to ``CELLS`` cells by their hash,
    and sums of their hashes, which do not depend on order and count duplicates.
    One pass; a map task passes on one row per cell."""
    first, second = (column.cast("decimal(20, 0)") for column in _row_hashes(df))
    summed = df.select(_cell(df).alias("cell"), first.alias("a"), second.alias("b")).groupBy("cell")
    return summed.agg(F.count("*").alias("rows"), F.sum("a").alias("sum_a"), F.sum("b").alias("sum_b"))


def differences(written: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows that only one side has, duplicates counted; empty if both agree.

    Checksums of both sides are compared at once, and only rows of cells whose
    checksums differ are shuffled and compared whole. If all agree, nothing is.
    """
    expected = expected.select(*[F.col(f"`{field.name}`").cast(field.dataType) for field in written.schema])
    both = checksums(written).unionAll(checksums(expected)).groupBy("cell", "rows", "sum_a", "sum_b")
    differing = both.agg(F.count("*").alias("sides")).where("sides = 1").select("cell").distinct()
    cells = [row.cell for row in differing.collect()]  # CELLS of them at most
    if not cells:
        return written.where(F.lit(False))
    if len(cells) < CELLS:
        written, expected = (side.where(_cell(side).isin(cells)) for side in (written, expected))
    return written.exceptAll(expected).unionAll(expected.exceptAll(written))
