"""Token files: independent zstandard frames with a trailing seek table.

A file is a row of zstandard frames, each decodable by itself, and a skippable
frame at the end that lists them, as in the public seekable format:

    skippable magic, size | per frame: packed size, size, checksum | number of
    frames, descriptor, seekable magic

all little-endian, the checksum being the low 32 bits of the XXH64 of the
unpacked frame. An unpacked frame holds whole documents: their number and the
bytes per id (u4, u4), then per document its id, whether it has one, its number
of ids (i8, u1, i8), then the ids of all of them.
"""

from __future__ import annotations

import re
import struct
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tastegrid.llm.tokens import WordEncoder, encoded_texts, string_column

# Fixed values of the seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

_HEAD = struct.Struct("<II")
_ENTRY = struct.Struct("<III")
_FOOT = struct.Struct("<IBI")
_FRAME_BYTES = 1 << 20
# Packed bytes that a task reads back, and characters that order texts of one id.
_READ_BYTES, _HEAD_CHARS = 64 << 20, 64
_INDEX = (
    "part int, path string, frame int, place long, packed long, docs long, first_doc long, "
    "last_doc long, start_in_part long, ids long"
)
_DOCUMENT = "doc_id long, start long, n_tokens long, ids binary"


class FrameWriter:
    """Writes documents to an open binary file, one frame at a time."""

    def __init__(self, out, id_bytes: int, frame_bytes: int = _FRAME_BYTES, level: int = 3):
        self._out, self._dtype, self._frame_bytes = out, f"<u{id_bytes}", frame_bytes
        self._packer = zstandard.ZstdCompressor(level=level)
        self._docs: list[tuple[int | None, np.ndarray]] = []
        self._held = self._place = self._ids = 0
        self._table: list[bytes] = []

    def add(self, doc: int | None, ids: np.ndarray) -> tuple | None:
        """Take a document; returns the index row of a frame that it filled."""
        self._docs.append((doc, ids.astype(self._dtype)))
        self._held += self._docs[-1][1].nbytes
        return self.flush() if self._held >= self._frame_bytes else None

    def flush(self) -> tuple | None:
        """(frame, place, packed size, documents, first and last id, ids before it, ids)."""
        if not self._docs:
            return None
        names = [doc for doc, _ in self._docs]
        known = [doc for doc in names if doc is not None]
        sizes = np.array([len(ids) for _, ids in self._docs], dtype="<i8")
        payload = b"".join(
            [
                _HEAD.pack(len(names), np.dtype(self._dtype).itemsize),
                np.array([doc or 0 for doc in names], dtype="<i8").tobytes(),
                np.array([doc is not None for doc in names], dtype="u1").tobytes(),
                sizes.tobytes(),
                *(ids.tobytes() for _, ids in self._docs),
            ]
        )
        packed = self._packer.compress(payload)
        self._out.write(packed)
        total = int(sizes.sum())
        row = (
            len(self._table), self._place, len(packed), len(names),
            min(known, default=None), max(known, default=None), self._ids, total,
        )
        self._table.append(_ENTRY.pack(len(packed), len(payload), xxhash.xxh64_intdigest(payload) & 0xFFFFFFFF))
        self._place += len(packed)
        self._ids += total
        self._docs, self._held = [], 0
        return row

    def close(self) -> None:
        """Write the seek table; call ``flush`` before."""
        body = b"".join(self._table) + _FOOT.pack(len(self._table), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self._out.write(_HEAD.pack(SKIPPABLE_MAGIC, len(body)) + body)


def read_seek_table(source) -> list[tuple[int, int, int, int]]:
    """(place, packed size, size, checksum) of each frame of an open file."""
    length = source.seek(0, 2)
    source.seek(length - _FOOT.size)
    frames, flags, magic = _FOOT.unpack(source.read(_FOOT.size))
    if magic != SEEKABLE_MAGIC or not flags & CHECKSUM_FLAG:
        raise ValueError("no seek table with checksums at the end of the file")
    source.seek(length - _FOOT.size - frames * _ENTRY.size)
    entries = list(_ENTRY.iter_unpack(source.read(frames * _ENTRY.size)))
    places = np.cumsum([0] + [packed for packed, _, _ in entries]).tolist()
    return [(place, *entry) for place, entry in zip(places, entries)]


def read_frame(source, entry: tuple[int, int, int, int]) -> Iterator[tuple[int | None, np.ndarray]]:
    """(document, ids) of one frame, whose checksum must hold."""
    place, packed, size, checksum = entry
    source.seek(place)
    payload = zstandard.ZstdDecompressor().decompress(source.read(packed), max_output_size=size)
    if xxhash.xxh64_intdigest(payload) & 0xFFFFFFFF != checksum:
        raise ValueError(f"checksum of the frame at {place} does not hold")
    count, width = _HEAD.unpack_from(payload)
    at = _HEAD.size
    docs = np.frombuffer(payload, "<i8", count, at).tolist()
    known = np.frombuffer(payload, "u1", count, at + 8 * count).tolist()
    sizes = np.frombuffer(payload, "<i8", count, at + 9 * count).tolist()
    ids = np.frombuffer(payload, f"<u{width}", -1, at + 17 * count)
    end = 0
    for doc, has_id, length in zip(docs, known, sizes):
        yield (doc if has_id else None), ids[end : end + length]
        end += length


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder or file, given as a path or URI."""
    if "://" in folder and not folder.startswith("file:"):
        return fs.FileSystem.from_uri(folder)
    return fs.LocalFileSystem(), re.sub(r"^(file:)?/+", "/", folder)


def _qualified(spark: SparkSession, folder: str) -> str:
    """The folder as a URI of the file system that Spark takes it to be in, so
    that executors open the same one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Encode all texts and write them to ``folder`` in ascending id order.

    ``folder`` must be one that all executors share. Rows are dealt by ranges and
    sorted, and each range is one file. A null id comes first; a repeated id
    keeps all its rows, by how their texts begin, and may be spread over files,
    as may even equal rows. A null text counts as
    empty: it has ``end_id`` only. Other columns are left out. A task writes
    under a name of its own and renames the file when it is whole, so a task
    that is run again replaces its file by an equal one. An empty table gives
    no file.

    Returns the index, a row for each frame, which is stored in ``folder`` too.
    """

    def write_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rows = TaskContext.get().partitionId(), []
        store, root = _opened(folder)
        name, whole = f"{root}/.{uuid.uuid4().hex}", f"{root}/part-{part:06d}.zst"
        writer = out = None
        for batch in batches:
            names = batch.column("_id").to_pylist()
            for row, ids in encoded_texts(string_column(batch, "_text"), tokenizer, end_id):
                if writer is None:
                    store.create_dir(root, recursive=True)
                    out = store.open_output_stream(name)
                    writer = FrameWriter(out, WordEncoder.load(tokenizer).id_bytes)
                rows.append(writer.add(names[row], ids))
        if writer is None:
            return
        rows.append(writer.flush())
        writer.close()
        out.close()
        store.move(name, whole)
        listed = [(part, f"{folder}/part-{part:06d}.zst", *row) for row in rows if row]
        fields = [pa.int32(), pa.string(), pa.int32()] + [pa.int64()] * 7
        yield pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(zip(*listed), fields)],
            names=[field.split()[0] for field in _INDEX.split(", ")],
        )

    spark = docs.sparkSession
    folder = _qualified(spark, folder)
    rows = docs.select(docs[id_col].cast("long").alias("_id"), docs[text_col].alias("_text"))
    head = F.substring("_text", 1, _HEAD_CHARS)
    dealt = rows.withColumns({"_head": head, "_salt": F.rand(7)})
    ranged = dealt.repartitionByRange("_id", "_head", "_salt").sortWithinPartitions("_id", "_head", "_salt")
    ranged.select("_id", "_text").mapInArrow(write_task, _INDEX).write.parquet(f"{folder}/index")
    return spark.read.schema(_INDEX).parquet(f"{folder}/index")


def read_token_files(index: DataFrame, doc_ids: Iterable[int] | None = None) -> DataFrame:
    """Documents of the frames that ``index`` lists, in parallel by frame: as many
    tasks as their packed bytes call for, or as there are slots for.

    Returns (doc_id, start, n_tokens, ids as little-endian u4); ``start`` is the
    number of ids of all documents before. With ``doc_ids`` only frames whose
    range of ids holds one of them are read and unpacked.
    """
    totals = index.groupBy("part").agg(F.sum("ids").alias("_ids"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("_ids").over(earlier), F.lit(0)).alias("_base"))
    start = (F.col("_base") + F.col("start_in_part")).alias("start")
    frames = index.join(bases, "part").select("path", "frame", start, "first_doc", "last_doc", "packed")
    wanted = None if doc_ids is None else {int(doc) for doc in doc_ids}
    if wanted is not None:
        asked = F.array(*[F.lit(doc).cast("long") for doc in sorted(wanted)])
        frames = frames.where(F.exists(asked, lambda doc: doc.between(F.col("first_doc"), F.col("last_doc"))))

    def read_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, source, table = None, None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["path"] != path:
                    path = row["path"]
                    store, local = _opened(path)
                    source = store.open_input_file(local)
                    table = read_seek_table(source)
                out, start = [], row["start"]
                for doc, ids in read_frame(source, table[row["frame"]]):
                    if wanted is None or doc in wanted:
                        out.append((doc, start, len(ids), ids.astype("<u4").tobytes()))
                    start += len(ids)
                if out:
                    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(column, kind) for column, kind in zip(zip(*out), kinds)],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )

    listed, packed = frames.agg(F.count("*"), F.coalesce(F.sum("packed"), F.lit(0))).first()
    slots = 2 * index.sparkSession.sparkContext.defaultParallelism
    tasks = max(min(listed, slots), -(-packed // _READ_BYTES), 1)
    dealt = frames.repartitionByRange(tasks, "path", "frame").sortWithinPartitions("path", "frame")
    return dealt.select("path", "frame", "start").mapInArrow(read_task, _DOCUMENT)


def read_token_table(spark: SparkSession, folder: str, doc_ids: Iterable[int] | None = None) -> DataFrame:
    """``read_token_files`` of a folder that ``write_token_files`` has filled."""
    return read_token_files(spark.read.schema(_INDEX).parquet(f"{folder}/index"), doc_ids)


def with_checksum(documents: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of documents that were read back."""
    return documents.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


