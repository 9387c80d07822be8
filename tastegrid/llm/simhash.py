"""SimHash near-duplicates by pivot distance tables.

A table holds the Hamming distance of every fingerprint to many fixed reference
fingerprints, the pivots. Two fingerprints within ``d`` bits differ by at most
``d`` in every coordinate, so pairs with a larger difference are discarded and
only survivors are compared bit by bit.

The pivots are made of bands: each pivot is a pattern for every one of five
bands of the 64 bits, and its distance is the sum of the distances by band. Two
fingerprints within three bits agree in two bands at least, and there all their
partial coordinates are equal; that is the key on which pairs meet.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.llm.common import checkpointed, connected_components
from tastegrid.llm.tokens import string_column
from tastegrid.operators.ranking import first_per_key

_SEED = 42
_CHUNK = 1 << 16
_BANDS = 5
_PIVOTS = 24
# Fingerprints of one key that a task compares at once; larger keys are cut.
_TOGETHER = 1024
_POPULATION = np.array([bin(byte).count("1") for byte in range(256)], dtype=np.uint8)


def _shingle_hashes(words: list[bytes], size: int) -> list[int]:
    line = b" ".join(words)
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(line, _SEED)]
    ends = np.cumsum([len(word) + 1 for word in words])
    starts = np.concatenate([[0], ends[:-size]]).tolist()
    hashed = xxhash.xxh64_intdigest
    return [hashed(line[start:end], _SEED) for start, end in zip(starts, (ends[size - 1 :] - 1).tolist())]


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64 bits; bit i is 1 if more than half of the shingles' hashes have it.

    A-Z are lower-cased, words are runs between ASCII white space, a shingle is
    ``shingle`` words joined by a space, repeats counted. Fewer words are one
    shingle; a null text or one without words has 0.
    """
    words = (text or "").encode().lower().split()  # bytes.lower() changes A-Z only
    if not words:
        return 0
    hashes = np.array(_shingle_hashes(words, shingle), dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for first in range(0, len(hashes), _CHUNK):
        part = hashes[first : first + _CHUNK]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp) of every whole text, ``fp`` as a signed 64-bit number."""

    def hash_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(text.as_py(), shingle) for text in string_column(batch, "_text")]
            bits = np.array(found, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(bits)], names=["_id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (
        docs.select(docs[id_col].alias("_id"), docs[text_col].alias("_text"))
        .mapInArrow(hash_task, f"_id {kind}, fp long")
        .withColumnRenamed("_id", id_col)
    )


def _bits(values: np.ndarray) -> np.ndarray:
    """Number of bits set in each unsigned 64-bit value."""
    return _POPULATION[values.view(np.uint8)].reshape(*values.shape, 8).sum(axis=-1, dtype=np.int64)


def _pivots(seed: int = 1) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 64, size=_PIVOTS, dtype=np.uint64)


def _band_masks(bands: int) -> list[np.uint64]:
    cuts = [64 * band // bands for band in range(bands + 1)]
    return [np.uint64(((1 << high) - 1) ^ ((1 << low) - 1)) for low, high in zip(cuts, cuts[1:])]


def distance_table(values: np.ndarray, bands: int = _BANDS) -> np.ndarray:
    """Distances to the pivots by band: values x bands x pivots."""
    apart = values[:, None] ^ _pivots()[None, :]
    return np.stack([_bits(apart & mask) for mask in _band_masks(bands)], axis=1)


def _keyed(values: np.ndarray, bands: int, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """For each choice of bands that must agree, a key of their coordinates."""
    table = distance_table(values, bands).astype(np.uint64)
    powers = np.power(np.uint64(0x9E3779B97F4A7C15), np.arange(1, _PIVOTS + 1, dtype=np.uint64))
    mixed = (table * powers).sum(axis=2, dtype=np.uint64)  # one number for the coordinates of each band
    groups = list(combinations(range(bands), bands - distance))
    keys = np.zeros((len(values), len(groups)), dtype=np.uint64)
    for at, group in enumerate(groups):
        for band in group:
            keys[:, at] = (keys[:, at] ^ mixed[:, band]) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(band + 1)
    return np.tile(np.arange(len(groups), dtype=np.int32), len(values)), keys.reshape(-1)


def _joined(label: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """``label``, the least index of each one's group, after joining the pairs."""
    while True:
        a, b = label[left], label[right]
        apart = a != b
        if not apart.any():
            return label
        left, right, a, b = left[apart], right[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(label[label], label):
            label = label[label]


def _groups(values: np.ndarray, same: np.ndarray, distance: int) -> np.ndarray:
    """Least index that each index reaches by steps of at most ``distance`` bits
    among rows with equal ``same``, which lie together. Compares rows k apart for
    k = 1, 2, … until no run is as long; rows joined already are passed over, and
    the pairs of one k only are held."""
    coordinates = distance_table(values, 1)[:, 0, :].astype(np.int8)
    label = np.arange(len(values))
    at = np.arange(len(values))
    for step in range(1, len(values)):
        at = at[at + step < len(values)]
        at = at[same[at] == same[at + step]]
        if not len(at):
            break
        near = at[label[at] != label[at + step]]
        for pivot in range(_PIVOTS):
            column = coordinates[:, pivot]
            near = near[np.abs(column[near] - column[near + step]) <= distance]
        near = near[_bits(values[near] ^ values[near + step]) <= distance]
        label = _joined(label, near, near + step)
    return label


def similar_fingerprints(distinct: DataFrame, distance: int = 3) -> DataFrame:
    """Links (a, b) that join exactly the fingerprints ``fp`` of ``distinct``
    that a chain of steps of at most ``distance`` bits joins.

    A key held by more than ``_TOGETHER`` fingerprints is cut into chunks, and
    every two chunks meet in a task of their own; from each meeting only a
    spanning set of links is passed on, not all pairs.
    """
    bands = max(_BANDS, distance + 2)

    def key_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("fp").to_numpy().view(np.uint64)
            choice, keys = _keyed(values, bands, distance)
            repeated = np.repeat(values, len(keys) // max(len(values), 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(choice), pa.array(keys.view(np.int64)), pa.array(repeated.view(np.int64))],
                names=["choice", "key", "fp"],
            )

    keyed = checkpointed(distinct.select("fp").mapInArrow(key_task, "choice int, key long, fp long"))
    shared = checkpointed(keyed.groupBy("choice", "key").agg(F.count("*").alias("n")).where("n > 1"))
    chunks = F.ceil(F.col("n") / _TOGETHER).cast("int")
    own = F.pmod(F.xxhash64("fp", "choice"), F.col("chunks")).cast("int")
    dealt = (
        keyed.join(shared, ["choice", "key"])
        .withColumn("chunks", chunks)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select(
            F.xxhash64("choice", "key", F.least("own", "other"), F.greatest("own", "other")).alias("meeting"), "fp"
        )
    )

    def link_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        meeting, values = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
        for batch in batches:
            meeting = np.concatenate([meeting, batch.column("meeting").to_numpy()])
            values = np.concatenate([values, batch.column("fp").to_numpy().view(np.uint64)])
            if not len(meeting):
                continue
            whole = int(np.searchsorted(meeting, meeting[-1]))  # the last meeting may go on
            if whole:
                yield _links_of(values[:whole], meeting[:whole])
                meeting, values = meeting[whole:], values[whole:]
        if len(meeting):
            yield _links_of(values, meeting)

    def _links_of(values, meeting):
        label = _groups(values, meeting, distance)
        moved = np.flatnonzero(label != np.arange(len(values)))
        pairs = [values[moved].view(np.int64), values[label[moved]].view(np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(side) for side in pairs], names=["a", "b"])

    return (
        dealt.repartition("meeting").sortWithinPartitions("meeting").mapInArrow(link_task, "a long, b long").distinct()
    )


def near_duplicates(
    docs: DataFrame,
    shingle: int = 3,
    distance: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, fingerprint as 16 hex digits, component_id) of every document.

    ``component_id`` is the least id that links of at most ``distance`` bits
    reach. Equal fingerprints are one node, so copies add no pairs. Null and
    empty texts share fingerprint 0 and are linked like others; repeated rows
    stay; a null id is never the least unless the whole component has none.
    Other columns are left out.
    """
    hashed = checkpointed(fingerprints(docs, shingle, id_col, text_col))
    distinct = checkpointed(hashed.groupBy("fp").agg(F.min(id_col).alias("_first")))
    joined = connected_components(similar_fingerprints(distinct, distance))
    roots = checkpointed(
        distinct.join(joined.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
            "_root", F.coalesce("component", "fp")
        )
    )
    least = roots.groupBy("_root").agg(F.min("_first").alias("component_id"))
    found = checkpointed(roots.join(least, "_root").select("fp", "component_id"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return hashed.join(found, "fp").select(id_col, digits, "component_id")


def one_of_each_group(
    docs: DataFrame, shingle: int = 3, distance: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs``, all columns, with exactly one row of each group of
    near-duplicates: that of the least id, a null id being the last. Of rows that
    share it, one text stays, and of equal texts the row that comes first by its
    other columns. An empty table gives no row.

    Rows are told apart by id and 128 bits of their text. Copies of a row are cut
    to one in each map task before whole texts are shuffled.
    """
    no_id, text = F.isnull(docs[id_col]), docs[text_col].cast("string")
    names = [f"_row_hash_{at}_{len(docs.columns)}" for at in (1, 2)]
    keyed = docs.withColumns(
        {name: F.xxhash64(F.lit(at), no_id, docs[id_col], F.isnull(text), text) for at, name in enumerate(names)}
    )
    first, second = (F.col(name) for name in names)
    row = F.struct(no_id.alias("no_id"), docs[id_col].alias("id"), first.alias("h1"), second.alias("h2"))
    groups = near_duplicates(keyed.select(row.alias("row"), docs[text_col].alias("text")), shingle, distance, "row", "text")
    chosen = groups.where("row.h1 = component_id.h1 AND row.h2 = component_id.h2")
    chosen = chosen.select(F.col("row.h1").alias(names[0]), F.col("row.h2").alias(names[1])).distinct()
    others = [F.col(f"`{field.name}`") for field in docs.schema if field.name != text_col and field.dataType.typeName() != "map"]
    return first_per_key(keyed, names, others or [F.lit(0)]).join(chosen, names, "left_semi").drop(*names)
