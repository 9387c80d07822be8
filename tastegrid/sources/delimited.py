"""Headerless delimited files with declared schemas.

Fields are split on the separator alone (no quoting), as the input format has
none. One pattern per schema says which lines fit: the right number of fields,
numbers where numbers are due, and no empty field. The strict readers fail the
job at the first line that does not, whichever columns the query goes on to
use and whatever it filters by; ``split_bad_lines`` sets such lines aside.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastegrid import schemas
from tastegrid.functions.flags import labels_from_flags
from tastegrid.operators.ranking import dense_positions, salted_join
from tastegrid.session import pin

LATIN_1 = "ISO-8859-1"
BAD_LINE = "_bad_line"

# Fields by type; whole numbers are as long as every value of that length fits.
_FIELDS = {
    "int": r" *[+-]?[0-9]{1,9} *",
    "bigint": r" *[+-]?[0-9]{1,18} *",
    "double": r" *[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]{1,3})? *",
}


def line_pattern(schema: T.StructType, sep: str, required: bool = True) -> str:
    """Matches the lines that fit ``schema``; ``required`` rules out empty fields."""
    text = f"[^{re.escape(sep)}]+"
    fields = [_FIELDS.get(field.dataType.simpleString(), text) for field in schema]
    return "^" + re.escape(sep).join(f"({field})" if required else f"({field})?" for field in fields) + "$"


def _lines(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """Lines as text. The bytes of a line are kept by the text source as they
    are, and read here in their encoding."""
    lines = spark.read.text(path)
    if encoding == "UTF-8":
        return lines
    return lines.withColumn("value", F.decode(F.col("value").cast("binary"), encoding))


def _typed(lines: DataFrame, schema: T.StructType, sep: str) -> DataFrame:
    fields = F.split("value", f"\\Q{sep}\\E", -1)
    columns = [F.nullif(F.get(fields, F.lit(i)), F.lit("")) for i in range(len(schema))]
    return lines.select(*[c.cast(field.dataType).alias(field.name) for c, field in zip(columns, schema)])


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    sep: str,
    encoding: str = "UTF-8",
    columns: Sequence[str] | None = None,
    required: bool = False,
) -> DataFrame:
    """Named, typed read of a headerless file, optionally of some columns only.
    A line that does not fit fails the job; an empty field is null, or with
    ``required`` does not fit."""
    lines = _lines(spark, path, encoding)
    problem = F.concat(F.lit("line that does not fit the schema: "), "value")
    fits = F.col("value").rlike(line_pattern(schema, sep, required))
    # The check is on the line itself, so no later filter comes before it.
    checked = lines.where(F.when(fits, True).otherwise(F.raise_error(problem).cast("boolean")))
    df = _typed(checked, schema, sep)
    return df.select(*columns) if columns else df


def _strict(spark: SparkSession, path: str, schema: T.StructType, sep: str) -> DataFrame:
    return read_delimited(spark, path, schema, sep, LATIN_1, required=True)


def read_ratings(spark: SparkSession, path: str, rating_type: str = "int") -> DataFrame:
    """Tab-separated ``user_id, item_id, rating, ts``."""
    if rating_type == "int":
        return _strict(spark, path, schemas.RATING, "\t")
    return _strict(spark, path, schemas.FLOAT_RATING, "\t").withColumn("rating", F.col("rating").cast(rating_type))


def read_users(spark: SparkSession, path: str) -> DataFrame:
    """Pipe-separated user profiles. Zip codes stay text; only they are trimmed."""
    return _trimmed(_strict(spark, path, schemas.USER, "|"))


def _trimmed(users: DataFrame) -> DataFrame:
    return users.withColumn("zip_code", F.trim("zip_code")) if "zip_code" in users.columns else users


def read_items(
    spark: SparkSession, path: str, labels: Sequence[str] = schemas.GENRES, with_date: bool = True
) -> DataFrame:
    """Pipe-separated items: five text fields, then one 0/1 flag per label.

    A line may end early: the flags it lacks are unset. A line without a
    numeric id fails the job. Absent text reads as empty text.
    """
    flags = [f"flag_{i}" for i in range(len(labels))]
    columns = [*schemas.ITEM_TEXT_COLUMNS, *flags]
    raw = spark.read.csv(
        path,
        schema=T.StructType([T.StructField(name, T.StringType()) for name in columns]),
        sep="|",
        encoding=LATIN_1,
        quote="",
        mode="PERMISSIVE",
    )
    items = raw.select(
        _required_long("item_id"),
        F.coalesce("title", F.lit("")).alias("title"),
        F.coalesce("release_date", F.lit("")).alias("release_date"),
        labels_from_flags([F.col(name) for name in flags], labels).alias("genres"),
    )
    return items if with_date else items.drop("release_date")


def _required_long(name: str) -> Column:
    number = F.col(name).try_cast("bigint")
    problem = F.concat(F.lit(f"not a number in {name}: "), F.coalesce(name, F.lit("nothing")))
    return F.coalesce(number, F.raise_error(problem).cast("bigint")).alias(name)


def with_input_order(df: DataFrame, name: str = "line") -> DataFrame:
    """Add a sortable, unique place of each row in the files of a fresh scan:
    number of the file by path, piece of the file, row.

    The rows are stored with path, piece and row, as a second scan may cut the
    files in other pieces. Files are numbered from the paths that occur, which
    are read from the stored column alone.
    """
    placed = pin(
        df.select(
            "*",
            F.col("_metadata.file_path").alias("_path"),
            F.col("_metadata.file_block_start").alias("_piece"),
            F.monotonically_increasing_id().alias("_row"),
        )
    )
    files = dense_positions(placed.select("_path").distinct(), ["_path"], "_file")
    place = F.struct(F.col("_file").cast("int").alias("file"), F.col("_piece").alias("piece"), F.col("_row").alias("row"))
    return salted_join(placed, files, "_path", "_row").select(*df.columns, place.alias(name))


def split_bad_lines(
    spark: SparkSession, path: str, schema: T.StructType, sep: str, encoding: str = LATIN_1
) -> tuple[DataFrame, DataFrame]:
    """Rows that the strict readers take, and the raw lines at which they fail."""
    lines = _lines(spark, path, encoding)
    fits = F.col("value").rlike(line_pattern(schema, sep))
    good = _trimmed(_typed(lines.where(fits), schema, sep))
    return good, lines.where(~fits).select(F.col("value").alias(BAD_LINE))
