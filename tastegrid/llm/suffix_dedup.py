"""Removal of repeated byte strings by difference-cover suffix sorting.

Every string of ``length`` bytes that also starts earlier is removed. Sorting
all suffixes of a corpus moves each byte many times, so the text is first cut,
without loss, into pieces that may be sorted apart:

* Each window of ``length`` bytes has an anchor, the place in it whose 32-byte
  gram has the least hash. It depends on the window alone, so equal windows
  have equal anchors. The windows with one anchor are a context, some 130 bytes.
* A window repeats only if its anchor's gram does. Contexts that are equal as a
  whole are one entry of the text to sort; all but the first are repeats.
  What is left open are different contexts with one gram.
* Their windows are sorted by the difference cover {1, 2} modulo 3: windows
  whose distance to the anchor is in the cover are named by sorting triples of
  names, recursively (11, 33, 99 bytes); the others follow from their first
  byte and the name of the next window. Neighbours with equal names are equal
  windows, and all but the first of them are repeats.

The names span 99 bytes, so ``length`` is 100. Positions are ordered by
document id, a 64-bit hash of the text and start. Documents with one id are told
apart by that hash and 16 bits of another checksum.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.llm.common import checkpointed, slices_by_bytes
from tastegrid.llm.tokens import string_column

LENGTH = 100
_GRAM = 32
_BLOCK = 11
_TEXT_BYTES = 1 << 18
_SORTED_BYTES = 1 << 20
# Contexts of one gram that a task sorts together; more are cut.
_TOGETHER = 512
_BLOCK_WIDTH = 16
_MOST_BROADCAST = 2_000_000
_NO_ID = -(1 << 63)

_WORD = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_PART = 0xC2B2AE3D27D4EB4F
_TABLE, _OTHER_TABLE = np.random.default_rng(11).integers(0, 1 << 64, size=(2, 256), dtype=np.uint64)

# A position: checksum of the text, start of the context, distance of the anchor
# from it, windows less one; so that positions of one id sort by start.
_TAG, _START, _ANCHOR = 46, 14, 7


def _packed(tag, start, anchor, windows):
    return (tag << _TAG) | (start << _START) | (anchor << _ANCHOR) | (windows - 1)


def _unpacked(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return place >> _TAG, (place >> _START) & 0xFFFFFFFF, (place >> _ANCHOR) & 127, (place & 127) + 1


class _Powers:
    """Powers of the hash base and of its inverse, kept as far as was needed."""

    up = down = np.ones(1, dtype=np.uint64)

    @classmethod
    def to(cls, count: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < count:
            steps = np.full((2, count), _BASE, dtype=np.uint64)
            steps[1] = pow(_BASE, -1, 1 << 64)
            steps[:, 0] = 1
            cls.up, cls.down = np.cumprod(steps, axis=1, dtype=np.uint64)
        return cls.up, cls.down


def contexts(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Contexts of the texts that lie in ``raw`` one after the other.

    Returns first window, last window and anchor as places in ``raw``, the hash
    of the anchor's gram and that of the context's bytes.
    """
    empty = np.empty(0, dtype=np.int64)
    if len(raw) < LENGTH:
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    grams, span, power = _TABLE[raw], 1, _BASE
    while span < _GRAM:
        grams = grams[:-span] * np.uint64(power) + grams[span:]
        span, power = 2 * span, power * power & _WORD
    grams ^= grams >> np.uint64(32)
    grams *= np.uint64(0xD6E8FEB86659FD93)
    grams ^= grams >> np.uint64(32)
    # Least gram of each window: the low byte holds how far it is, so that the
    # first of equals is taken.
    least, span, all_grams = grams & np.uint64(_WORD ^ 255), 1, LENGTH - _GRAM + 1
    while span < all_grams:
        step = min(span, all_grams - span)
        least = np.minimum(least[:-step], least[step:] + np.uint64(step))
        span += step
    anchor = np.arange(len(least)) + (least & np.uint64(255)).astype(np.int64)

    sizes = np.diff(ends, prepend=0)
    long = sizes >= LENGTH
    inside = np.zeros(len(raw) + 1, dtype=np.int8)
    inside[(ends - sizes)[long]] += 1
    inside[ends[long] - LENGTH + 1] -= 1
    inside = np.cumsum(inside, dtype=np.int8)[: len(least)].astype(bool)
    moved = anchor[1:] != anchor[:-1]
    first = np.flatnonzero(inside & np.concatenate([[True], moved | ~inside[:-1]]))
    last = np.flatnonzero(inside & np.concatenate([moved | ~inside[1:], [True]]))
    up, down = _Powers.to(len(raw) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_OTHER_TABLE[raw] * up[: len(raw)], dtype=np.uint64)])
    return first, last, anchor[first], grams[anchor[first]], (sums[last + LENGTH] - sums[first]) * down[first]


def _spans(
    ids: np.ndarray, texts: np.ndarray, tags: np.ndarray, starts: np.ndarray, ends: np.ndarray
) -> list[np.ndarray]:
    """Spans joined where they touch, per document."""
    order = np.lexsort((starts, tags, texts, ids))
    ids, texts, tags, starts, ends = ids[order], texts[order], tags[order], starts[order], ends[order]
    if not len(ids):
        return [ids, texts, tags, starts, ends]
    other = np.concatenate([[True], (ids[1:] != ids[:-1]) | (texts[1:] != texts[:-1]) | (tags[1:] != tags[:-1])])
    # The furthest end so far, per document: documents are set apart by an offset.
    offset = (np.cumsum(other) - 1) << 33
    reach = np.maximum.accumulate(ends + offset) - offset
    new = other | np.concatenate([[True], starts[1:] > reach[:-1]])
    at = np.flatnonzero(new)
    return [ids[at], texts[at], tags[at], starts[at], reach[np.concatenate([at[1:], [len(ids)]]) - 1]]


_CONTEXT = ["gram", "body", "id", "text", "place", "end"]
_FOUND = ["gram", "variant", "id", "text", "place", "end"]


def _batch(columns: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64, copy=False)) for c in columns], names=names)


def _longs(names: list[str]) -> str:
    return ", ".join(f"{name} long" for name in names)


def _tagged(raw: bytes) -> int:
    return zlib.crc32(raw) & 0xFFFF


def _folded(
    gram: np.ndarray, body: np.ndarray, ids: np.ndarray, texts: np.ndarray, place: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """The first of each gram and body, and the spans that the others cover."""
    order = np.lexsort((place, texts, ids, body, gram))
    gram, body, ids, texts, place = gram[order], body[order], ids[order], texts[order], place[order]
    new = np.concatenate([[True], (gram[1:] != gram[:-1]) | (body[1:] != body[:-1])])[: len(gram)]
    kept = np.flatnonzero(new)
    yield _batch([gram[kept], body[kept], ids[kept], texts[kept], place[kept], np.full(len(kept), -1)], _CONTEXT)
    lead = kept[np.cumsum(new) - 1] if len(kept) else kept
    again = np.flatnonzero(~new & ((ids != ids[lead]) | (texts != texts[lead]) | (place != place[lead])))
    yield _known(ids[again], texts[again], place[again])


def _known(ids: np.ndarray, texts: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    """Spans of contexts or pieces all of whose windows repeat others."""
    tags, starts, _, windows = _unpacked(place)
    return _known_spans(*_spans(ids, texts, tags, starts, starts + windows + LENGTH - 1))


def _known_spans(
    ids: np.ndarray, texts: np.ndarray, tags: np.ndarray, starts: np.ndarray, ends: np.ndarray
) -> pa.RecordBatch:
    return _batch([ids ^ texts, tags, ids, texts, _packed(tags, starts, 0, 1), ends], _CONTEXT)


def _context_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first of equal contexts of a batch (``end`` -1) and, for the rest,
    which repeat it for certain, the spans they cover (``end`` 0 or more)."""
    for batch in batches:
        texts, names = string_column(batch, "_text"), batch.column("_id").to_numpy()
        hashes = batch.column("_hash").to_numpy()
        parts = []
        for start, count in slices_by_bytes(texts, _TEXT_BYTES):
            raws = [(text.as_py() or "").encode() for text in texts.slice(start, count)]
            ends = np.cumsum([len(raw) for raw in raws])
            first, last, anchor, gram, body = contexts(np.frombuffer(b"".join(raws), dtype=np.uint8), ends)
            row = np.searchsorted(ends, first, side="right")
            tag = np.array([_tagged(raw) for raw in raws], dtype=np.int64)[row]
            begin = first - (ends - [len(raw) for raw in raws])[row]
            place = _packed(tag, begin, anchor - first, last - first + 1)
            parts.append([gram.view(np.int64), body.view(np.int64), names[start + row], hashes[start + row], place])
        if not parts:
            continue
        yield from _folded(*(np.concatenate(column) for column in zip(*parts)))


def _resolve_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts sorted by gram, body and position: spans of those that are not
    the first of their kind (variant -1), and the first ones of grams with two
    bodies or more, numbered. Holds one row per gram across batches."""
    gram_before = body_before = None
    first_before = lone = (0, 0, 0)
    variant_before = 0
    for batch in batches:
        gram, body, ids, texts, place, end = (batch.column(name).to_numpy() for name in _CONTEXT)
        known = end >= 0
        if known.any():
            variant = np.full(known.sum(), -1)
            yield _batch([gram[known], variant, ids[known], texts[known], place[known], end[known]], _FOUND)
            gram, body, ids, texts, place = gram[~known], body[~known], ids[~known], texts[~known], place[~known]
        rows = len(gram)
        if not rows:
            continue
        at = np.arange(rows)
        new_gram = np.concatenate([[gram_before is None or gram[0] != gram_before], gram[1:] != gram[:-1]])
        new_body = new_gram | np.concatenate([[body_before is None or body[0] != body_before], body[1:] != body[:-1]])
        gram_at = np.maximum.accumulate(np.where(new_gram, at, -1))
        body_at = np.maximum.accumulate(np.where(new_body, at, -1))
        bodies = np.cumsum(new_body)
        variant = np.where(gram_at >= 0, bodies - bodies[gram_at], bodies + variant_before)
        lead_id = np.where(body_at >= 0, ids[body_at], first_before[0])
        lead_text = np.where(body_at >= 0, texts[body_at], first_before[1])
        lead_place = np.where(body_at >= 0, place[body_at], first_before[2])
        again = ~new_body & ((ids != lead_id) | (texts != lead_text) | (place != lead_place))
        tags, starts, _, windows = _unpacked(place[again])
        ends = starts + windows + LENGTH - 1
        at_start = _packed(tags, starts, 0, 1)
        yield _batch([gram[again], np.full(len(ends), -1), ids[again], texts[again], at_start, ends], _FOUND)
        second = np.flatnonzero(new_body & (variant == 1))
        own = gram_at[second]
        first_ids = np.where(own >= 0, ids[own], lone[0])
        first_texts = np.where(own >= 0, texts[own], lone[1])
        first_places = np.where(own >= 0, place[own], lone[2])
        more = np.flatnonzero(new_body & (variant >= 1))
        yield _batch(
            [
                np.concatenate([gram[second], gram[more]]),
                np.concatenate([np.zeros(len(second), np.int64), variant[more]]),
                np.concatenate([first_ids, ids[more]]),
                np.concatenate([first_texts, texts[more]]),
                np.concatenate([first_places, place[more]]),
                np.full(len(second) + len(more), -1),
            ],
            _FOUND,
        )
        if gram_at[-1] >= 0:
            lone = (ids[gram_at[-1]], texts[gram_at[-1]], place[gram_at[-1]])
        first_before, variant_before = (lead_id[-1], lead_text[-1], lead_place[-1]), int(variant[-1])
        gram_before, body_before = gram[-1], body[-1]


def _rank(*keys: np.ndarray) -> np.ndarray:
    """Names of tuples of numbers below 2^32, in the order of the tuples."""
    names = keys[0]
    for key in keys[1:]:
        names = np.unique((names.astype(np.uint64) << np.uint64(32)) | key.astype(np.uint64), return_inverse=True)[1]
    return names


def repeated_windows(
    raw: np.ndarray, begins: np.ndarray, windows: np.ndarray, anchors: np.ndarray, groups: np.ndarray
) -> np.ndarray:
    """Whether each window repeats one before it, for the windows of all contexts
    in order. Contexts lie in ``raw`` from ``begins`` on, in the order of their
    positions; only those of one group, which share a gram, have equal windows.
    ``anchors`` is the distance of the anchor from the context's first window.
    """
    context = np.repeat(np.arange(len(begins)), windows)
    within = np.arange(len(context)) - np.repeat(np.cumsum(windows) - windows, windows)
    start, distance = begins[context] + within, anchors[context] - within
    covered = distance % 3 != 0
    raw = np.concatenate([raw, np.zeros(3 * LENGTH, dtype=np.uint8)]).astype(np.uint64)
    wide = (raw[:-3] << np.uint64(24)) | (raw[1:-2] << np.uint64(16)) | (raw[2:-1] << np.uint64(8)) | raw[3:]
    last = _BLOCK - 8
    tail = wide[8 : len(raw) - LENGTH - 8 + 8] >> np.uint64(8 * (4 - last))
    blocks = _rank(wide[: len(tail)], wide[4 : len(tail) + 4], tail)  # names of 11 bytes

    named = np.zeros(len(blocks), dtype=bool)
    sampled = np.unique(np.concatenate([start[covered], start[~covered] + 1]))
    for step in (0, 3 * _BLOCK, 6 * _BLOCK):
        named[sampled + step] = True
    at = np.flatnonzero(named)
    thirds = np.zeros(len(blocks), dtype=np.int64)  # names of 33 bytes
    thirds[at] = _rank(blocks[at], blocks[at + _BLOCK], blocks[at + 2 * _BLOCK])
    names = np.zeros(len(blocks), dtype=np.int64)  # names of 99 bytes
    names[sampled] = _rank(thirds[sampled], thirds[sampled + 3 * _BLOCK], thirds[sampled + 6 * _BLOCK])

    name = np.where(covered, names[start], names[start + 1]).astype(np.uint64)
    byte = np.where(covered, raw[start + LENGTH - 1], raw[start])
    group = np.unique(groups, return_inverse=True)[1][context].astype(np.uint64)
    place = distance.astype(np.uint64) << np.uint64(36)
    key = (group << np.uint64(43)) | place | (byte << np.uint64(28)) | name
    order = np.argsort(key, kind="stable")
    repeats = np.zeros(len(key), dtype=bool)
    repeats[order[1:]] = key[order[1:]] == key[order[:-1]]
    return repeats


def _signed(word: int) -> int:
    word &= _WORD
    return word - (1 << 64) if word >> 63 else word


_PIECE = "cell long, id long, text long, place long, piece binary"


def _piece_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the open contexts of each document, by cell: equal windows are
    in one cell, and cells are sorted apart. A gram's contexts are one cell,
    but a gram with too many is cut by blocks of distances to the anchor, and
    these by a hash of the bytes that all windows of a block share. Of equal
    pieces of such a cell the first goes on; the others repeat it and go without
    their bytes, to any cell."""
    for batch in batches:
        texts, names = string_column(batch, "_text"), batch.column("_id").to_pylist()
        out: list[tuple] = []
        leads: dict[tuple[int, bytes], tuple[int, int, int]] = {}
        hashes = batch.column("_hash").to_pylist()
        for text, name, own, open_ones in zip(texts, names, hashes, batch.column("open")):
            raw = (text.as_py() or "").encode()
            tag = _tagged(raw)
            for one in open_ones.as_py():
                _, start, anchor, windows = (int(x) for x in _unpacked(np.int64(one["place"])))
                parts = -(-one["variants"] // _TOGETHER)
                width = 128 if parts == 1 else _BLOCK_WIDTH
                step = 0
                while step < windows:
                    block = (anchor - step) // width
                    stop = min(windows, anchor - block * width + 1)
                    cell = one["gram"]
                    if parts > 1:
                        first = start + anchor - block * width
                        shared = zlib.crc32(raw[first : first - width + 1 + LENGTH])
                        cell = _signed(cell ^ (block * _BASE) ^ (shared % parts * _PART))
                    piece = raw[start + step : start + stop + LENGTH - 1]
                    place = int(_packed(tag, start + step, anchor - step, stop - step))
                    step = stop
                    if parts == 1:
                        out.append((cell, name, own, place, piece))
                        continue
                    lead = leads.setdefault((cell, piece), (name, own, place))
                    if lead != (name, own, place):
                        leads[cell, piece] = min(lead, (name, own, place))
                        again = max(lead, (name, own, place))
                        out.append((_signed(again[1] ^ again[2] * _PART), *again, None))
        out += [(cell, *lead, piece) for (cell, piece), lead in leads.items()]
        if out:
            kinds = [*[pa.int64()] * 4, pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*out), kinds)],
                names=["cell", "id", "text", "place", "piece"],
            )


def _sort_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of the windows that repeat others (``end`` 0 or more), from pieces
    sorted by cell, bytes and position. Equal pieces are one entry.

    Holds ``_SORTED_BYTES`` and a batch at most: the windows of a cell with more
    different pieces are given one by one, by a hash of their bytes (``end`` -1).
    """
    held: list[pa.RecordBatch] = []
    size = 0
    crowded = None  # the cell that is given by windows
    lead: tuple | None = None  # cell, bytes and position of the last different piece
    for batch in batches:
        bare = batch.column("piece").is_null()
        if bare.true_count:
            given = batch.filter(bare)
            yield _known(*(given.column(name).to_numpy() for name in ("id", "text", "place")))
            batch = batch.filter(pa.compute.invert(bare))
        if not batch.num_rows:
            continue
        cells, ids, texts, places = (batch.column(name).to_numpy() for name in ("cell", "id", "text", "place"))
        pieces = batch.column("piece")
        same = pa.compute.equal(pieces.slice(1), pieces.slice(0, len(pieces) - 1)).to_numpy(zero_copy_only=False)
        goes_on = lead is not None and lead[:2] == (cells[0], pieces[0].as_py())
        new = np.concatenate([[not goes_on], ~same.astype(bool) | (cells[1:] != cells[:-1])])
        lead_at = np.maximum.accumulate(np.where(new, np.arange(len(new)), -1))
        lead_ids = np.where(lead_at >= 0, ids[lead_at], lead[2] if lead else 0)
        lead_texts = np.where(lead_at >= 0, texts[lead_at], lead[3] if lead else 0)
        lead_places = np.where(lead_at >= 0, places[lead_at], lead[4] if lead else 0)
        again = ~new & ((ids != lead_ids) | (texts != lead_texts) | (places != lead_places))
        if again.any():
            yield _known(ids[again], texts[again], places[again])
        lead = (cells[-1], pieces[len(pieces) - 1].as_py(), lead_ids[-1], lead_texts[-1], lead_places[-1])
        batch = batch.filter(pa.array(new))
        if crowded is not None:
            inside = int(np.searchsorted(cells[new], crowded, side="right"))
            yield from _single_windows(batch.slice(0, inside))
            batch = batch.slice(inside)
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.nbytes
        if size < _SORTED_BYTES:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        cells = table.column("cell").to_numpy()
        whole = int(np.searchsorted(cells, cells[-1]))  # the last cell may go on
        if whole:
            yield _sorted_spans(table.slice(0, whole))
        rest = table.slice(whole).combine_chunks()
        held, size = rest.to_batches(), rest.nbytes
        if size >= _SORTED_BYTES:
            crowded = cells[-1]
            for part in held:
                yield from _single_windows(part)
            held, size = [], 0
    if held:
        yield _sorted_spans(pa.Table.from_batches(held))


def _single_windows(pieces: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Windows of the pieces by a 128-bit hash: the first of equal ones, and the
    spans that the others cover."""
    for start in range(0, pieces.num_rows, _TOGETHER):
        part = pieces.slice(start, _TOGETHER)
        tags, starts, _, windows = _unpacked(part.column("place").to_numpy())
        hashes = b"".join(
            hashlib.blake2b(piece[at : at + LENGTH], digest_size=16).digest()
            for piece, count in zip(part.column("piece").to_pylist(), windows.tolist())
            for at in range(count)
        )
        piece = np.repeat(np.arange(len(windows)), windows)
        within = np.arange(len(piece)) - np.repeat(np.cumsum(windows) - windows, windows)
        gram, body = np.frombuffer(hashes, dtype=np.int64).reshape(-1, 2).T
        place = _packed(tags[piece], starts[piece] + within, 0, 1)
        ids, texts = (part.column(name).to_numpy()[piece] for name in ("id", "text"))
        yield from _folded(gram, body, ids, texts, place)


def _sorted_spans(table: pa.Table) -> pa.RecordBatch:
    table = table.combine_chunks()
    cells, ids, texts, places = (table.column(name).to_numpy() for name in ("cell", "id", "text", "place"))
    order = np.lexsort((places, texts, ids))
    pieces = table.column("piece").take(pa.array(order)).to_pylist()
    cells, ids, texts, places = cells[order], ids[order], texts[order], places[order]
    tags, starts, anchors, windows = _unpacked(places)
    sizes = np.array([len(piece) for piece in pieces], dtype=np.int64)
    raw = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    repeats = repeated_windows(raw, np.cumsum(sizes) - sizes, windows, anchors, cells)
    context = np.repeat(np.arange(len(ids)), windows)
    within = np.arange(len(context)) - np.repeat(np.cumsum(windows) - windows, windows)
    at = np.flatnonzero(repeats)
    begin, of = starts[context[at]] + within[at], context[at]
    return _known_spans(*_spans(ids[of], texts[of], tags[of], begin, begin + LENGTH))


def repeated_spans(texts: DataFrame, most_broadcast: int = _MOST_BROADCAST) -> DataFrame:
    """(id, hash, tag, start, end) of spans of ``texts`` (_id long, _text) that repeat;
    they may touch and overlap.

    The list of open contexts is broadcast to the texts up to ``most_broadcast``
    rows, and joined by a shuffle beyond.
    """
    texts = texts.withColumn("_hash", _hash_of("_text"))
    resolved = checkpointed(
        texts.mapInArrow(_context_task, _longs(_CONTEXT))
        .repartition("gram")
        .sortWithinPartitions("gram", "body", "id", "text", "place")
        .mapInArrow(_resolve_task, _longs(_FOUND))
    )
    undecided = resolved.where("variant >= 0")
    count = undecided.count()
    crowded = undecided.groupBy("gram").agg((F.max("variant") + 1).alias("variants")).where(F.col("variants") > _TOGETHER)
    # One row for ``_TOGETHER`` open contexts at most, and no hot gram in a join.
    few = count // _TOGETHER <= most_broadcast
    sized = undecided.join(F.broadcast(crowded) if few else crowded, "gram", "left").select(
        "id",
        F.col("text").alias("hash"),
        F.shiftright("place", _TAG).alias("tag"),
        F.struct("gram", "place", F.coalesce("variants", F.lit(1)).alias("variants")).alias("one"),
    )
    per_text = sized.groupBy("id", "hash", "tag").agg(F.collect_list("one").alias("open"))
    at_hand = texts.withColumn("_tag", _tag_of("_text"))
    open_texts = at_hand.join(
        F.broadcast(per_text) if count <= most_broadcast else per_text,
        _same_text(),
    ).select("_id", "_hash", "_text", "open")
    pieces = open_texts.mapInArrow(_piece_task, _PIECE)
    found = (
        pieces.repartition("cell")
        .sortWithinPartitions("cell", "piece", "id", "text", "place")
        .mapInArrow(_sort_task, _longs(_CONTEXT))
        .repartition("gram")
        .sortWithinPartitions("gram", "body", "id", "text", "place")
        .mapInArrow(_resolve_task, _longs(_FOUND))
    )
    return resolved.unionByName(found).where("variant < 0").select(
        "id",
        F.col("text").alias("hash"),
        F.shiftright("place", _TAG).alias("tag"),
        F.shiftright("place", _START).bitwiseAND(0xFFFFFFFF).alias("start"),
        "end",
    )


def _same_text():
    return (F.col("_id") == F.col("id")) & (F.col("_hash") == F.col("hash")) & (F.col("_tag") == F.col("tag"))


def _hash_of(text: str):
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def _tag_of(text: str):
    return F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).bitwiseAND(0xFFFF)


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    as_text: bool = False,
    carried: Sequence[str] = (),
) -> DataFrame:
    """Every document without the bytes that an earlier 100-byte string covers.

    Returns (id, n_bytes, n_removed, n_spans, kept) and the ``carried`` columns:
    ``kept`` is the remaining bytes, or with ``as_text`` a string without the
    characters that a cut went through. Strings are judged on the input and do not cross documents;
    overlapping ones count. A null text is empty; texts under 100 bytes stay
    whole. A null id comes first in the order. Rows that agree in id and text
    are one document: each of them gets the same result. Rows with one id and
    other texts are ordered by a hash of the text. Columns not carried are left out.
    """
    rest = F.struct(F.lit(0).alias("_none"), *[docs[name].alias(f"c{at}") for at, name in enumerate(carried)])
    texts = docs.select(
        F.coalesce(docs[id_col].cast("long"), F.lit(_NO_ID)).alias("_id"),
        docs[text_col].cast("string").alias("_text"),
        rest.alias("_rest"),
    )
    found = repeated_spans(texts.select("_id", "_text")).groupBy("id", "hash", "tag")
    spans = found.agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    joined = (
        texts.withColumn("_tag", _tag_of("_text"))
        .withColumn("_hash", _hash_of("_text"))
        .join(spans, _same_text(), "left")
        .select("_id", "_text", "spans", "_rest")
    )

    def cut_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                _cut((text.as_py() or "").encode(), spans.as_py() or [])
                for text, spans in zip(string_column(batch, "_text"), batch.column("spans"))
            ]
            if not rows:
                continue
            sizes, removed, counts, kept = zip(*rows)
            if as_text:
                kept = [part.decode("utf-8", "ignore") for part in kept]
            kinds = [pa.int64()] * 3 + [pa.string() if as_text else pa.binary()]
            columns = [pa.array(column, kind) for column, kind in zip((sizes, removed, counts, kept), kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), *columns, batch.column("_rest")],
                names=["_id", "n_bytes", "n_removed", "n_spans", "kept", "_rest"],
            )

    kind, rest_kind = "string" if as_text else "binary", texts.schema["_rest"].dataType.simpleString()
    cut = joined.mapInArrow(
        cut_task, f"_id long, n_bytes long, n_removed long, n_spans long, kept {kind}, _rest {rest_kind}"
    )
    return cut.select(
        F.nullif("_id", F.lit(_NO_ID)).cast(docs.schema[id_col].dataType).alias(id_col),
        "n_bytes", "n_removed", "n_spans", "kept",
        *[F.col("_rest")[f"c{at}"].alias(name) for at, name in enumerate(carried)],
    )


def _cut(raw: bytes, spans: list[dict]) -> tuple[int, int, int, bytes]:
    kept, end, count = [], 0, 0
    covered = -1
    for start, stop in sorted((span["start"], span["end"]) for span in spans):
        if start > covered:
            count += 1
            kept.append(raw[end:start])
        covered = end = max(covered, stop)
    kept.append(raw[end:])
    left = b"".join(kept)
    return len(raw), len(raw) - len(left), count, left
