"""Byte-pair encoding by a trie of distinct words, and decoding.

A row of tokens is the encoding of its text if and only if each two neighbours
are the encoding of theirs. So the encoding of a prefix is its last token and
the encoding of what stands before that, and it needs one token as state. The
distinct words of a batch form a trie; a walk in depth finds the last token at
each node from those of its ancestors, and what many words begin with is encoded
once.
"""

from __future__ import annotations

import json
import re
import struct
from array import array
from collections.abc import Iterable, Iterator
from math import inf

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tastegrid.llm.common import slices_by_bytes
from tastegrid.llm.tokens import WordEncoder, string_column

_TEXT_BYTES = 4 << 20
_KEPT_PAIRS = _KEPT_STEPS = 200_000
_TOKEN_BITS = 32
# The last symbol of a word is another one than inside of it.
_LAST = 0x10000


class MergeTable:
    """Tokens and merges of a byte-pair vocabulary.

    ``merges`` are (left, right, result) token ids, the first to be applied
    first. Each must join what symbols or earlier merges give, and give what no
    other gives, as training makes them.
    """

    def __init__(self, symbols: dict[str, int], merges: list[tuple[int, int, int]]):
        made = {token: -1 for token in symbols.values()}
        text = {token: symbol for symbol, token in symbols.items()}
        self._rank: dict[tuple[int, int], int] = {}
        self._parts: dict[int, tuple[int, int, int]] = {}
        for rank, (left, right, result) in enumerate(merges):
            if left not in made or right not in made or result in made:
                raise ValueError(f"merge {rank} does not join results of earlier merges to a new token")
            made[result], text[result] = rank, text[left] + text[right]
            self._rank[left, right] = rank
            self._parts[result] = left, right, rank
        self._spines: dict[tuple[int, bool], list[tuple[int, float]]] = {}
        self._fits: dict[int, bool] = {}
        self.size = {token: len(symbol) for token, symbol in text.items()}
        # A token that its own symbols are not encoded to is in no encoding.
        whole = set(symbols.values())
        for token, (left, right, rank) in self._parts.items():
            if left in whole and right in whole and not self._merged_across(left, right, rank):
                whole.add(token)
        self._build_automaton({text[token]: token for token in whole})

    def _build_automaton(self, tokens: dict[str, int]) -> None:
        """States are the beginnings of tokens; ``_ending`` lists the tokens that
        end what a state stands for, the longest first."""
        self._next: list[dict[str, int]] = [{}]
        self._more_steps = 0
        self._shorter, self._ending = [0], [()]
        for symbols, token in tokens.items():
            state = 0
            for symbol in symbols:
                below = self._next[state].get(symbol)
                if below is None:
                    below = self._next[state][symbol] = len(self._next)
                    self._next.append({})
                    self._shorter.append(0)
                    self._ending.append(())
                state = below
            self._ending[state] = ((token, len(symbols)),)
        row = list(self._next[0].values())
        while row:
            below_row = []
            for state in row:
                self._ending[state] += self._ending[self._shorter[state]]
                for symbol, below in self._next[state].items():
                    self._shorter[below] = self._step(self._shorter[state], symbol)
                    below_row.append(below)
            row = below_row
        self._more_steps = _KEPT_STEPS

    def _step(self, state: int, symbol: str) -> int:
        """The state after one more symbol, kept for the next time."""
        at, below = state, self._next[state].get(symbol)
        while below is None and at:
            at = self._shorter[at]
            below = self._next[at].get(symbol)
        if at != state and self._more_steps:
            self._next[state][symbol] = below or 0
            self._more_steps -= 1
        return below or 0

    def _spine(self, token: int, right: bool) -> list[tuple[int, float]]:
        """What the last (first) symbol of a token is part of while it is built,
        from the symbol on, each with the rank of the merge that takes it up."""
        found = self._spines.get((token, right))
        if found is None:
            found, taken, at = [], inf, token
            while at in self._parts:
                found.append((at, taken))
                taken = self._parts[at][2]
                at = self._parts[at][1 if right else 0]
            found.append((at, taken))
            found.reverse()
            self._spines[token, right] = found
        return found

    def _merged_across(self, left: int, right: int, before: float) -> bool:
        """Whether a merge of a rank under ``before`` joins symbols of both. It
        does if both of its parts are there at its rank; of equal merges the one
        further left goes first."""
        for a, a_taken in self._spine(left, True):
            for b, b_taken in self._spine(right, False):
                rank = self._rank.get((a, b))
                if rank is not None and rank < before and rank < a_taken and rank <= b_taken:
                    return True
        return False

    def encode_words(self, words: Iterable[str]) -> Iterator[tuple[str, bytes]]:
        """Each word, a text of symbols, with its token ids as little-endian u4.

        Sorted words are the walk of their trie in depth: what a word shares with
        the one before is the path down to where it branches off, whose states
        are kept, and the rest of it are new nodes, each visited once. For each
        node of the path ``last`` has the last token of its encoding: of the
        tokens that end there, the one that goes with the last token of what
        stands before it. So memory is that of the longest word.
        """
        follows, ending, fits = self._next, self._ending, self._fits
        before, states, last = "", [0], [0]
        for word in sorted(words):
            shared = _shared_prefix(before, word)
            del states[shared + 1 :], last[shared + 1 :]
            state, before = states[shared], word
            for depth in range(shared + 1, len(word) + 1):
                symbol = word[depth - 1]
                below = follows[state].get(symbol)
                state = self._step(state, symbol) if below is None else below
                states.append(state)
                for token, size in ending[state]:
                    if size == depth:
                        break
                    pair = last[depth - size] << _TOKEN_BITS | token
                    fit = fits.get(pair)
                    if fit is None:
                        fit = self._judge(pair)
                    if fit:
                        break
                else:
                    raise ValueError(f"{symbol!r} is no token")
                last.append(token)
            yield word, self._tokens(last)

    def _judge(self, pair: int) -> bool:
        """Whether two tokens in turn are the encoding of their symbols."""
        if len(self._fits) >= _KEPT_PAIRS:
            self._fits.clear()
        left, right = pair >> _TOKEN_BITS, pair & (1 << _TOKEN_BITS) - 1
        fit = self._fits[pair] = not self._merged_across(left, right, inf)
        return fit

    def _tokens(self, last: list[int]) -> bytes:
        """The encoding of a whole path, read back to front."""
        at = len(last) - 1
        found = array("I")
        while at:
            found.append(last[at])
            at -= self.size[last[at]]
        found.reverse()
        return found.tobytes()


def _shared_prefix(a: str, b: str) -> int:
    """Number of symbols that two words begin with alike."""
    if b.startswith(a):
        return len(a)
    for at, (one, other) in enumerate(zip(a, b)):
        if one != other:
            return at
    return min(len(a), len(b))


class TrieEncoder(WordEncoder):
    """Encodes and decodes with a tokenizer file whose model is byte-pair merges
    with word ends. The library's rules cut texts into words; the ids come from
    the trie. Special tokens in a text are kept as such."""

    def __init__(self, path: str):
        super().__init__(path)
        with open(path, encoding="utf-8") as file:
            plan = json.load(file)
        model, added = plan["model"], plan["added_tokens"]
        odd = [model.get(name) for name in ("continuing_subword_prefix", "dropout", "byte_fallback", "ignore_merges")]
        plain = not any(token["lstrip"] or token["rstrip"] or token["single_word"] or token["normalized"] for token in added)
        if model["type"] != "BPE" or any(odd) or not plain or not model.get("end_of_word_suffix"):
            raise ValueError(f"{path} is not a byte-pair model with word ends and plain special tokens")
        ids, suffix = model["vocab"], model["end_of_word_suffix"]
        pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
        made = {a + b for a, b in pairs}
        symbols = {}
        for token, number in ids.items():
            if token not in made:
                bare = token.removesuffix(suffix)
                if len(bare) == 1:
                    symbols[bare if bare == token else chr(ord(bare) + _LAST)] = number
        self._merges = MergeTable(symbols, [(ids[a], ids[b], ids[a + b]) for a, b in pairs])
        self._special = {token["content"]: token["id"] for token in added}
        longest_first = sorted(map(re.escape, self._special), key=len, reverse=True)
        self._cut_special = re.compile(f"({'|'.join(longest_first)})") if longest_first else None
        self._joined_by_space = plan["decoder"] is None
        self._names = {number: token for token, number in {**ids, **self._special}.items()}

    def _normalised(self, texts: list[str]) -> list[str]:
        """Normal forms; words of ASCII have no white space inside and go together."""
        normal = self._tokenizer.normalizer.normalize_str
        plain = [text for text in texts if text.isascii()]
        together = normal(" ".join(plain)).split(" ") if plain else []
        if len(together) != len(plain):
            return [normal(text) for text in texts]
        ready = iter(together)
        return [next(ready) if text.isascii() else normal(text) for text in texts]

    def _learn(self, words: list[str]) -> Iterator[bytes]:
        """Special tokens are cut out first; the rest is normalised and cut."""
        if self._cut_special is None or not self._cut_special.search(" ".join(words)):
            parts, owners = words, range(len(words))
        else:
            split = [(part, at) for at, word in enumerate(words) for part in self._cut_special.split(word)]
            parts, owners = zip(*split)
        bare = self._normalised(["" if part in self._special else part for part in parts])
        cut = self._tokenizer.pre_tokenizer.pre_tokenize_str(" ".join(bare))
        marked = [piece[:-1] + chr(ord(piece[-1]) + _LAST) for piece, _ in cut]
        coded = dict(self._merges.encode_words(set(marked)))
        begins = [begin for _, (begin, _) in cut]
        ids: list[list[bytes]] = [[] for _ in words]
        at = end = 0
        for part, own, owner in zip(parts, bare, owners):
            end += len(own) + 1
            if part in self._special:
                ids[owner].append(struct.pack("<I", self._special[part]))
            while at < len(begins) and begins[at] < end:
                ids[owner].append(coded[marked[at]])
                at += 1
        return map(b"".join, ids)

    def decode(self, ids: list[int]) -> str:
        """As the library decodes with special tokens; unknown ids are left out."""
        if self._joined_by_space:
            names = self._names
            return " ".join([names[one] for one in ids if one in names])
        return self._tokenizer.decode(ids, skip_special_tokens=False)


def encode_texts(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False
) -> DataFrame:
    """(id, ids) of every whole text, an array of its token ids in order.

    ``decoded`` adds the text that the ids give back, as a column of that name.
    A null or empty text has no ids and gives back an empty text. Repeated rows
    and null ids stay; other columns are left out; an empty table gives no row.
    A word of any length is encoded whole. Words are encoded once per batch and
    short ones kept, within a bound in bytes.
    """
    names = ["_id", "ids", *(["decoded"] if decoded else [])]

    def encode_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TrieEncoder.load(tokenizer)
        for batch in batches:
            texts = string_column(batch, "_text")
            for start, length in slices_by_bytes(texts, _TEXT_BYTES):
                ids, counts = encoder.encode(texts.slice(start, length))
                ends = np.concatenate([[0], np.cumsum(counts)])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int32)))
                columns = [batch.column("_id").slice(start, length), lists]
                if decoded:
                    columns.append(pa.array((encoder.decode(own) for own in lists.to_pylist()), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"_id {kind}, ids array<int>" + (", decoded string" if decoded else "")
    return (
        docs.select(docs[id_col].alias("_id"), docs[text_col].alias("_text"))
        .mapInArrow(encode_task, schema)
        .withColumnRenamed("_id", id_col)
    )


def decode_ids(encoded: DataFrame, tokenizer: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, decoded) of every array of token ids, special tokens included. A
    null or empty array gives an empty text, and ids that the vocabulary does
    not have are left out, as null ones are."""

    def decode_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TrieEncoder.load(tokenizer)
        for batch in batches:
            texts = [encoder.decode([one for one in own or () if one is not None]) for own in batch.column("_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(texts, pa.string())], names=["_id", "decoded"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return (
        encoded.select(encoded[id_col].alias("_id"), encoded[ids_col].alias("_ids"))
        .mapInArrow(decode_task, f"_id {kind}, decoded string")
        .withColumnRenamed("_id", id_col)
    )
