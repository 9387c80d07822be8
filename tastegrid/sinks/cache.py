"""Results stored once and read by later runs."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping, Sequence
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastegrid.sinks.tables import swap_in
from tastegrid.sources.stored import files_below, path_exists, read_table


def result_path(base: str, name: str, params: Mapping[str, object]) -> str:
    """The parameters are part of the path, so that a change of one computes
    anew instead of serving the old result."""
    parts = [f"{key}={quote(str(value), safe='')}" for key, value in sorted(params.items())]
    return "/".join([base.rstrip("/"), name, *parts])


def inputs_version(spark: SparkSession, paths: Sequence[str]) -> str:
    """Changes with the names, lengths and times of the files below ``paths``.
    Spark lists and sums them; the driver gets one row per path."""
    seen = hashlib.md5()
    for path in paths:
        try:
            hashes = [F.xxhash64(F.lit(seed), "path", "length", "modified").cast("decimal(20, 0)") for seed in (1, 2)]
            found = files_below(spark, path).agg(F.count("*"), *map(F.sum, hashes)).first()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            found = ()
        seen.update("\n".join([path, *map(str, found)]).encode())
    return seen.hexdigest()


def materialize_or_load(
    spark: SparkSession,
    base: str,
    name: str,
    params: Mapping[str, object],
    build: Callable[[], DataFrame],
    schema: T.StructType,
    inputs: Sequence[str] = (),
) -> DataFrame:
    """Load the stored result, or build and store it first. A write that did
    not finish has no success mark and is done again, as is one from
    ``inputs`` whose files have changed since."""
    version = {"inputs": inputs_version(spark, inputs)} if inputs else {}
    path = result_path(base, name, {**params, **version})
    if not path_exists(spark, f"{path}/_SUCCESS"):
        swap_in(spark, path, build().select(*schema.names).write.parquet)
    return read_table(spark, path, schema)
