"""Sharding by proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.llm.common import checkpointed
from tastegrid.operators.ranking import dense_positions, ordinals


def interleaved_shards(
    docs: DataFrame,
    shards: int = 8,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Deal all rows into ``shards`` shards that all match the mixture of sources.

    The rows of each source are shuffled by a seeded hash of their id and
    ranked; row r of n has the fraction (2r - 1) / 2n. All rows are sorted by
    that fraction and cut into runs whose lengths differ by one at most, so a
    run holds each source in proportion, to within a row or two.

    Returns (id, size, text_crc32, law, shard, slot, grown_shard): ``size`` is
    the text's UTF-8 bytes (null: none) and one, ``law`` is ``rows``, ``slot``
    counts from 0 in each shard, and ``grown_shard`` is null, as one more shard
    moves rows between all. A null source is a source of its own, and a null
    text has the checksum of an empty one. Equal fractions go by source;
    repeated rows are dealt like others. Other columns are left out; an empty
    table gives no row.

    Ranks and positions come from sorted ranges and their sizes, so a source
    that holds most rows is spread like any other.
    """
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    light = checkpointed(
        docs.select(
            docs[id_col].alias("_id"),
            (F.octet_length(text).cast("long") + 1).alias("_size"),
            F.crc32(text.cast("binary")).alias("_crc"),
            F.coalesce(F.concat(F.lit("="), docs[source_col].cast("string")), F.lit("")).alias("_source"),
            F.md5(F.concat_ws(":", F.lit(str(seed)), docs[id_col].cast("string")).cast("binary")).alias("_shuffle"),
        )
    )
    ranked = ordinals(light, "_source", ["_shuffle", "_id", "_crc", "_size"], "_rank")
    totals = checkpointed(light.groupBy("_source").agg(F.count("*").alias("_rows")))
    fraction = (2 * F.col("_rank") - 1) / (2 * F.col("_rows"))
    placed = dense_positions(
        ranked.join(totals, "_source").select("_id", "_size", "_crc", "_source", fraction.alias("_fraction"), "_rank"),
        ["_fraction", "_source", "_rank"],
        "_place",
    )
    rows = light.count()
    shard = F.expr(f"(_place * {shards}L) div {max(rows, 1)}L")
    first = F.expr(f"(_shard * {rows}L + {shards - 1}L) div {shards}L")
    return placed.withColumn("_shard", shard).select(
        F.col("_id").alias(id_col),
        F.col("_size").alias("size"),
        F.col("_crc").alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("_shard").cast("int").alias("shard"),
        (F.col("_place") - first).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
