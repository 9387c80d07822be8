"""Token counts of a unigram tokenizer without making the tokens.

An Aho-Corasick automaton lists the vocabulary's matches in a word; a dynamic
program over their ends carries the best score and the number of pieces of the
best path, and nothing else.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from tastegrid.llm.tokens import string_column

_SPACE = "▁"
# What an unknown character costs below the worst piece, in unigram tokenizers.
_UNKNOWN_PENALTY = 10.0
# Counts kept for later words: so many bytes of them, and none of a longer word,
# as a text without spaces is one word.
_KEPT_BYTES = 64 << 20
_LONGEST_KEPT = 64
_ENTRY_BYTES = 150
_LOADED: dict[str, "UnigramCounter"] = {}


class UnigramCounter:
    """Counts the tokens of texts under a unigram vocabulary of (piece, score).

    The tokenizer's rules: a space becomes U+2581, one is put before a text that
    does not begin with one, and the text is cut before each. Within a word the
    path with the greatest sum of scores wins; of paths that reach a place with
    equal sums, the one whose last piece begins first. A character that is no
    piece scores ``_UNKNOWN_PENALTY`` below the least piece. With ``byte_pieces``
    each byte of unknown characters is a token, else a run of them is one.
    """

    def __init__(self, vocabulary: Iterable[tuple[str, float]], byte_pieces: bool = True):
        self._automaton = ahocorasick.Automaton()
        scores = []
        for piece, score in vocabulary:
            if piece:
                self._automaton.add_word(piece, (len(piece), score))
                scores.append(score)
        self._automaton.make_automaton()
        self._unknown = min(scores) - _UNKNOWN_PENALTY
        self._byte_pieces = byte_pieces
        self._counts: dict[str, int] = {}
        self._held = 0

    @classmethod
    def of_file(cls, path: str) -> UnigramCounter:
        """The counter of this worker process for a sentencepiece model's pieces.
        Control pieces and byte pieces are not matched in texts."""
        if path not in _LOADED:
            from sentencepiece import SentencePieceProcessor

            model = SentencePieceProcessor(model_file=path)
            ids = range(model.get_piece_size())
            plain = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
            _LOADED[path] = cls(
                [(model.id_to_piece(i), model.get_score(i)) for i in plain], any(model.is_byte(i) for i in ids)
            )
        return _LOADED[path]

    def word(self, word: str) -> int:
        """Tokens of one word; matches come by end, the longest first."""
        size = len(word)
        ending: list[list[tuple[int, float]]] = [[] for _ in range(size)]
        for end, match in self._automaton.iter(word):
            ending[end].append(match)
        best, pieces, unknown_run = [0.0] * (size + 1), [0] * (size + 1), [False] * (size + 1)
        for end in range(1, size + 1):
            top = None
            for length, score in ending[end - 1]:
                start = end - length
                total = best[start] + score
                if top is None or total > top:
                    top, count = total, pieces[start] + 1
            whole = bool(ending[end - 1]) and ending[end - 1][-1][0] == 1
            if not whole and (top is None or best[end - 1] + self._unknown > top):
                top, unknown_run[end] = best[end - 1] + self._unknown, True
                if self._byte_pieces:
                    count = pieces[end - 1] + len(word[end - 1].encode("utf-8", "surrogatepass"))
                else:
                    count = pieces[end - 1] + (not unknown_run[end - 1])
            best[end], pieces[end] = top, count
        return pieces[size]

    def _keep(self, word: str, count: int) -> None:
        if self._held > _KEPT_BYTES:
            self._counts.clear()
            self._held = 0
        self._counts[word] = count
        self._held += _ENTRY_BYTES + len(word)

    def text(self, text: str | None) -> int:
        """Tokens of a whole text; none for a null or empty one."""
        if not text:
            return 0
        known = self._counts
        parts = text.replace(_SPACE, " ").split(" ")
        first = 1 if not parts[0] else 0
        total = 0
        for part in parts[first:]:
            count = known.get(part)
            if count is None:
                count = self.word(_SPACE + part)
                if len(part) <= _LONGEST_KEPT:
                    self._keep(part, count)
            total += count
        return total


def count_tokens(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens) of every whole text. A null or empty text has none;
    repeated rows and null ids stay; other columns are left out; an empty table
    gives no row. A word of any length is counted whole; counts of short words
    are kept for later texts, within a bound in bytes."""

    def count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = UnigramCounter.of_file(model)
        for batch in batches:
            counts = [counter.text(text.as_py()) for text in string_column(batch, "_text")]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(counts, pa.int64())], names=["_id", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (
        docs.select(docs[id_col].alias("_id"), docs[text_col].alias("_text"))
        .mapInArrow(count_task, f"_id {kind}, n_tokens long")
        .withColumnRenamed("_id", id_col)
    )
