"""Reads of results: headered exports, documents, keyed tables, fallbacks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_export(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Headered CSV, matched to ``schema`` by position. Without one, types are
    inferred, which costs another pass over the file."""
    reader = spark.read.option("header", True).option("escape", '"')
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.option("enforceSchema", False).schema(schema).csv(path, mode="FAILFAST")


def read_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One JSON document per line; fields a document lacks are null."""
    return spark.read.schema(schema).json(path)


def read_table(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(*([path] if isinstance(path, str) else path))


def manifest_path(path: str) -> str:
    """Where a keyed table keeps the key ranges of its files; reads of the folder pass over it."""
    return f"{path.rstrip('/')}/_manifest"


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(file, rows, least, most) of the files of a keyed table."""
    return spark.read.parquet(manifest_path(path))


def read_keyed(
    spark: SparkSession, path: str, schema: T.StructType | None = None, files: Sequence[str] | None = None
) -> DataFrame:
    """A keyed table as its manifest has it, or the rows of some of its ``files``."""
    if files is None:
        files = [row.file for row in read_manifest(spark, path).select("file").toLocalIterator()]
    schema = schema or read_table(spark, path).schema
    if not files:
        return spark.createDataFrame([], schema)
    return read_table(spark, [f"{path.rstrip('/')}/{name}" for name in files], schema)


def read_ids(spark: SparkSession, path: str, key: str, ids: Sequence[int | str], schema: T.StructType | None = None) -> DataFrame:
    """Rows with ``key``, the first key column of a table, in ``ids``.

    Only files whose range of keys holds an id are opened. A table without a
    manifest is filtered by the scan.
    """
    wanted = F.col(key).isin(list(ids))
    if not path_exists(spark, manifest_path(path)):
        return read_table(spark, path, schema).where(wanted)
    ranges = read_manifest(spark, path)
    if ranges.schema["least"].dataType.names[0] != key:
        raise ValueError(f"the files of {path} are not in order of {key}")
    low, high = F.col("least")[key], F.col("most")[key]
    asked = F.array(*[F.lit(i) for i in ids])
    # A range that starts at null holds everything up to its end.
    hit = ranges.where(F.exists(asked, lambda i: F.coalesce(low <= i, F.lit(True)) & (i <= high)))
    files = [row.file for row in hit.select("file").toLocalIterator()]
    return read_keyed(spark, path, schema, files).where(wanted)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def files_below(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, modified) of the files in a folder and those in it, or of
    one file. Spark lists large folders in parallel, and opens none of the files."""
    # A session of its own, so that tasks are cut by the number of cores, not by
    # the bytes of files that are not read.
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 50))
    listed = own.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return listed.select("path", "length", F.col("modificationTime").alias("modified"))


def read_first_available(paths: Iterable[str], read: Callable[[str], DataFrame]) -> DataFrame | None:
    """``read`` of the first path that is there, or None if none is."""
    for path in paths:
        try:
            return read(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return None
