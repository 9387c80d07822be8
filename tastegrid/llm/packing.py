"""Sum-of-squares packing of documents into windows of a fixed length."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tastegrid.llm.tokens import encoded_texts, string_column

_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_ROWS_OUT = 8192
# The task is above this bit of a sequence id, its own count of sequences below.
_SEQUENCE_BITS = 33


class Levels:
    """Partially filled windows by fill level.

    ``counts[h]`` is the number of open windows that hold ``h`` ids. A piece of
    ``s`` ids goes to the level that makes the sum of the squared counts least
    (Csirik et al., 2006): moving a window from ``h`` to ``h + s`` changes it by
    ``2 * (counts[h + s] - counts[h] + 1)``, opening one by ``2 * counts[s] + 1``
    and completing one by ``1 - 2 * counts[h]``. Of equals the fullest is taken.
    """

    def __init__(self, size: int):
        self.size = size
        self.counts = np.zeros(size + 1, dtype=np.int64)
        self._open: dict[int, list[int]] = defaultdict(list)
        self._next = 0

    def new_window(self) -> int:
        self._next += 1
        return self._next - 1

    def place(self, length: int) -> tuple[int, int]:
        """Window and offset for a piece of ``length`` ids, 0 < length < size."""
        top = self.size - length
        before, after = self.counts[1 : top + 1], self.counts[length + 1 : self.size + 1]
        change = 2 * (after - before + 1)
        change[-1] = 1 - 2 * before[-1]
        change[before == 0] = np.iinfo(np.int64).max
        best = len(change) - 1 - int(np.argmin(change[::-1]))
        level = best + 1 if change[best] < 2 * self.counts[length] + 1 else 0
        window = self._open[level].pop() if level else self.new_window()
        self.counts[level] -= level > 0
        if level + length < self.size:
            self.counts[level + length] += 1
            self._open[level + length].append(window)
        return window, level

    def still_open(self) -> list[tuple[int, int]]:
        """Windows and their fill, the fullest first."""
        return [(window, level) for level in sorted(self._open, reverse=True) for window in self._open[level]]


def pack(documents: Iterable[tuple[object, np.ndarray]], size: int) -> Iterator[tuple]:
    """Pieces (id, start, length, crc32, document's length, window, offset).

    Documents are cut into full windows and a rest; rests are placed by
    ``Levels``. At the end the windows still open are joined: the gap of the
    fullest is filled with ids cut from the emptiest, so that one at most is
    left with a gap. Only the pieces of open windows are held.
    """
    levels = Levels(size)
    held: dict[int, list[tuple]] = defaultdict(list)

    def piece(doc, start, ids, total, window, offset):
        return doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, window, offset

    for doc, ids in documents:
        total = len(ids)
        whole = total - total % size
        for start in range(0, whole, size):
            yield piece(doc, start, ids[start : start + size], total, levels.new_window(), 0)
        if whole < total:
            window, offset = levels.place(total - whole)
            held[window].append((doc, whole, ids[whole:].copy(), total))
            if offset + total - whole == size:
                yield from _pieces(held.pop(window), window, piece)

    left = [(window, level, held[window]) for window, level in levels.still_open()]
    full, empty = 0, len(left) - 1
    while full < empty:
        window, level, mine = left[full]
        giver, others_level, theirs = left[empty]
        doc, start, ids, total = theirs.pop()
        take = min(size - level, len(ids))
        mine.append((doc, start + len(ids) - take, ids[len(ids) - take :], total))
        if take < len(ids):
            theirs.append((doc, start, ids[: len(ids) - take], total))
        left[full] = (window, level + take, mine)
        left[empty] = (giver, others_level - take, theirs)
        full += level + take == size
        empty -= not theirs
    for window, _, mine in left:
        yield from _pieces(mine, window, piece)


def _pieces(parts: list[tuple], window: int, piece) -> Iterator[tuple]:
    offset = 0
    for doc, start, ids, total in parts:
        yield piece(doc, start, ids, total, window, offset)
        offset += len(ids)


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    size: int = 2048,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pack the ids of all documents into sequences of at most ``size`` ids.

    Each task packs the rows it reads, without a shuffle, and leaves one
    sequence at most that is not full. A text counts its ids and ``end_id``;
    a null or empty text has ``end_id`` only. Repeated rows and null ids are
    packed like others; other columns are left out. An empty table gives no
    row. A task that is run again reads the same rows if ``docs`` is a stored
    table, and so repeats its result.
    """

    def pack_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()

        def documents():
            for batch in batches:
                names = batch.column("_id").to_pylist()
                for row, ids in encoded_texts(string_column(batch, "_text"), tokenizer, end_id):
                    yield names[row], ids

        rows = []
        for doc, start, length, crc, total, window, offset in pack(documents(), size):
            rows.append((doc, start, length, crc, total, (task << _SEQUENCE_BITS) + window, offset))
            if len(rows) == _ROWS_OUT:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)

    def _batch(rows):
        names = [field.split()[0] for field in _SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)

    return docs.select(docs[id_col].cast("long").alias("_id"), docs[text_col].alias("_text")).mapInArrow(
        pack_task, _SCHEMA
    )
