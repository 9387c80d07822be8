"""Word-wise encoding, packing and token files."""

import io
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from cases import edge_docs, edge_rows, empty_docs
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tastegrid.llm.packing import Levels, pack, pack_documents
from tastegrid.llm.token_files import (
    FrameWriter,
    read_frame,
    read_seek_table,
    read_token_table,
    with_checksum,
    write_token_files,
)
from tastegrid.llm.tokens import WordEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(PATH)


def whole_ids(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids + [1]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("aZé' .,!?#\t\n\x0b\x1c\xa0̸́=<|>sİß日Ω0９ﬁ")), st.text(max_size=30))))
def test_words_apart_give_the_ids_of_the_whole_text(texts):
    ids, counts = WordEncoder.load(PATH).encode(pa.array(texts, pa.string()))
    want = [WHOLE.encode(text or "", add_special_tokens=False).ids for text in texts]
    assert counts.tolist() == [len(own) for own in want]
    assert ids.tolist() == [one for own in want for one in own]


@pytest.mark.parametrize("text", ["<|endoftext|> don't", "x<|startoftext|>.y", "we'll I'M 'S", "ẛ̣ a.̸ ≠", "é. H̱!"])
def test_special_and_composed_words(text):
    ids, _ = WordEncoder.load(PATH).encode(pa.array([text]))
    assert ids.tolist() == whole_ids(text)[:-1]


def slow_place(counts: Counter, length: int, size: int) -> int:
    """Level with the least sum of squares after the placing, the fullest of equals."""

    def squares(level):
        after = Counter(counts)
        after[level] -= level > 0
        if level + length < size:
            after[level + length] += 1
        return sum(n * n for n in after.values())

    open_levels = [0] + [level for level, n in counts.items() if n and level + length <= size]
    return min(open_levels, key=lambda level: (squares(level), -level))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 11), max_size=60))
def test_placing_minimises_the_sum_of_squares(lengths):
    levels, counts, fill = Levels(12), Counter(), defaultdict(int)
    for length in lengths:
        want = slow_place(counts, length, 12)
        window, offset = levels.place(length)
        assert offset == want == fill[window]
        fill[window] += length
        counts[want] -= want > 0
        counts[want + length] += want + length < 12


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 70), max_size=40))
def test_packing_is_whole_and_leaves_one_gap(sizes):
    docs = [(at, np.arange(size, dtype=np.uint32) + 100 * at) for at, size in enumerate(sizes)]
    pieces, windows, seen = list(pack(docs, 16)), defaultdict(list), defaultdict(list)
    for doc, start, length, crc, total, window, offset in pieces:
        ids = docs[doc][1]
        assert total == len(ids) and crc == zlib.crc32(ids[start : start + length].astype("<u4").tobytes())
        windows[window].append((offset, length))
        seen[doc] += range(start, start + length)
    for parts in windows.values():
        parts.sort()
        assert [offset for offset, _ in parts] == [sum(length for _, length in parts[:k]) for k in range(len(parts))]
    fills = [sum(length for _, length in parts) for parts in windows.values()]
    assert all(fill <= 16 for fill in fills) and sum(fill < 16 for fill in fills) <= 1
    assert all(sorted(seen[at]) == list(range(size)) for at, size in enumerate(sizes))


def test_pack_documents_on_edge_rows(spark):
    found = pack_documents(edge_docs(spark).coalesce(1), PATH).collect()
    lengths = Counter()
    for row in found:
        lengths[row.doc_id] += row.length
    want = Counter()
    for name, text, *_ in edge_rows():
        want[name] += len(whole_ids(text))
    assert lengths == want
    assert pack_documents(empty_docs(spark), PATH).collect() == []


@pytest.mark.parametrize("scheme", ["file://", "file:", ""])
def test_token_files_round_trip(spark, tmp_path, scheme):
    folder = f"{scheme}{tmp_path}/tokens"
    docs = edge_docs(spark).repartition(5)
    write_token_files(docs, folder, PATH)
    found = with_checksum(read_token_table(spark, folder)).collect()
    found.sort(key=lambda row: row.start)
    order = sorted(edge_rows(), key=lambda row: (row[0] is not None, row[0] or 0))
    start = 0
    for row, (name, text, *_) in zip(found, order, strict=True):
        ids = np.array(whole_ids(text), dtype="<u4")
        assert tuple(row) == (name, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    asked = read_token_table(spark, folder, [7, 12]).collect()
    assert sorted(row.doc_id for row in asked) == [7, 7, 12]


def test_token_files_of_an_empty_table(spark, tmp_path):
    folder = f"file://{tmp_path}/none"
    assert write_token_files(empty_docs(spark), folder, PATH).count() == 0
    assert read_token_table(spark, folder).collect() == []


def test_frames_are_independent_and_checked():
    out = io.BytesIO()
    writer = FrameWriter(out, 2, frame_bytes=100)
    docs = [(at, np.arange(at * 13, dtype=np.uint32)) for at in range(12)] + [(None, np.array([1], dtype=np.uint32))]
    rows = [row for row in (writer.add(*doc) for doc in docs) if row] + [writer.flush()]
    writer.close()
    table = read_seek_table(out)
    assert len(table) == len(rows) > 3
    back = [doc for entry in reversed(table) for doc in reversed(list(read_frame(out, entry)))][::-1]
    assert [(name, ids.tolist()) for name, ids in back] == [(name, ids.tolist()) for name, ids in docs]
    with pytest.raises(ValueError, match="checksum"):
        list(read_frame(out, (*table[1][:3], table[1][3] ^ 1)))
    with pytest.raises(ValueError, match="seek table"):
        read_seek_table(io.BytesIO(b"\0" * 40))
