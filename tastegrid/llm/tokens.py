"""Token ids of many texts, each distinct word encoded once."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tastegrid.llm.common import slices_by_bytes

_TEXT_BYTES = 4 << 20
# Words kept for later batches: so many bytes of them, twice that with the older
# ones, and none that is longer, as a text without spaces is one word.
_KEPT_BYTES = 48 << 20
_LONGEST_KEPT = 64
_ENTRY_BYTES = 200
# Latin letters (but dotted I, whose small form ends in a mark) before marks that
# no contraction and no composed letter holds:
# every tokenizer of this kind cuts there.
_CUT = r"([A-Za-z\x{00C0}-\x{00D6}\x{00D8}-\x{00F6}\x{00F8}-\x{012F}\x{0131}-\x{017F}])([.,!?#$%&*;:]+)"
_LOADED: dict[tuple[type, str], "WordEncoder"] = {}


class WordEncoder:
    """Encodes texts with a tokenizer file that drops white space and cuts
    between letters and marks.

    Such a tokenizer never joins what ASCII white space separates, nor a letter
    and the full stop behind it, so the ids of a text are those of such words
    in turn. Each distinct word of a batch is encoded by the tokenizers library
    once; recent short ones are kept for later batches, ``2 * _KEPT_BYTES`` and
    the words of a batch at most.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._words: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._held = 0

    @classmethod
    def load(cls, path: str) -> WordEncoder:
        """The encoder of this worker process."""
        if (cls, path) not in _LOADED:
            _LOADED[cls, path] = cls(path)
        return _LOADED[cls, path]

    @property
    def id_bytes(self) -> int:
        return 2 if self._tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4

    def _learn(self, words: list[str]) -> Iterator[bytes]:
        """Ids of new words, many in one call; a token belongs to the word it starts in."""
        for first in range(0, len(words), 4096):
            part = words[first : first + 4096]
            starts = np.cumsum([0] + [len(word) + 1 for word in part])
            encoded = self._tokenizer.encode(" ".join(part), add_special_tokens=False)
            ids = np.array(encoded.ids, dtype="<u4").tobytes()
            begins = np.fromiter((begin for begin, _ in encoded.offsets), dtype=np.int64, count=len(encoded))
            cuts = (4 * np.searchsorted(begins, starts)).tolist()
            yield from (ids[a:b] for a, b in zip(cuts, cuts[1:]))

    def _keep(self, word: str, ids: bytes) -> None:
        self._words[word] = ids
        self._held += _ENTRY_BYTES + len(word) + len(ids)

    def _ids_of(self, words: list[str]) -> list[bytes]:
        if self._held > _KEPT_BYTES:
            self._words, self._older, self._held = {}, self._words, 0
        known, older = self._words, self._older
        new, long = [], {}
        for word in words:
            if word not in known:
                if word in older:
                    self._keep(word, older[word])
                else:
                    new.append(word)
        for word, ids in zip(new, self._learn(new)):
            if len(word) <= _LONGEST_KEPT:
                self._keep(word, ids)
            else:
                long[word] = ids
        return [known[word] if word in known else long[word] for word in words]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the number of ids of each text (null: none)."""
        cut = pc.replace_substring_regex(pc.fill_null(texts, ""), _CUT, r"\1 \2")
        words = pc.ascii_split_whitespace(cut)
        coded = pc.dictionary_encode(words.flatten())
        which, found = coded.indices.to_numpy(), self._ids_of(coded.dictionary.to_pylist())
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        table = np.frombuffer(b"".join(found), dtype="<u4")
        sizes_before = np.concatenate([[0], np.cumsum(sizes)])
        counts = sizes[which]
        ends = np.concatenate([[0], np.cumsum(counts)])
        places = np.arange(ends[-1]) + np.repeat(sizes_before[which] - ends[:-1], counts)
        offsets = words.offsets.to_numpy()
        return table[places], np.diff(ends[offsets - offsets[0]])


def encoded_texts(texts: pa.Array, path: str, end_id: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and ids, with ``end_id`` behind them, of every text."""
    encoder = WordEncoder.load(path)
    for start, length in slices_by_bytes(texts, _TEXT_BYTES):
        ids, counts = encoder.encode(texts.slice(start, length))
        end = 0
        for row, count in enumerate(counts.tolist(), start):
            yield row, np.append(ids[end : end + count], np.uint32(end_id))
            end += count


def string_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    column = batch.column(name)
    return column if pa.types.is_string(column.type) else column.cast(pa.string())
