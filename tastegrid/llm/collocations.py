"""Phrase collocations by prefix-free parsing.

Pieces of text are cut into chunks where the words themselves call for it, so
equal passages give equal chunks wherever they stand. A chunk overhangs into the
next one by as many words as a phrase can reach, and each phrase belongs to the
chunk that it begins in. So phrases are counted inside the distinct chunks only,
each weighted by how often its chunk occurs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegrid.llm.common import checkpointed, slices_by_bytes
from tastegrid.llm.tokens import string_column
from tastegrid.operators.ranking import top_n_per_key
from tastegrid.session import pin

_TEXT_BYTES, _FOLDED_BYTES = 4 << 20, 12 << 20
# One in so many pairs of neighbouring words begins a chunk.
_CHUNK_WORDS = 32
# Bits of the hashes that words and pairs are counted by at first.
_HASH_BITS = 40
# Bits per frequent hash in the filter, and the most that it may have: 32 MB.
_BITS_EACH, _LEAST_BITS, _MOST_BITS = 32, 1 << 20, 1 << 28
# Bits of a row of Spark's bitmap functions.
_BITMAP_BITS = 32768
# Between the language and the words of a window. The least character, so that in
# the order of windows those that begin with a phrase are neighbours.
_PART = "\0"
# Windows of several words in a batch.
_WINDOWS_EACH = 1 << 17
UNKNOWN = "und"

_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(_ODD[0])
    return values ^ (values >> np.uint64(29))


def _word_hashes(words: pa.Array) -> np.ndarray:
    coded = pc.dictionary_encode(words)
    if not len(words):
        return np.zeros(0, dtype=np.uint64)
    hashes = np.array([xxhash.xxh64_intdigest(word) for word in coded.dictionary.to_pylist()], dtype=np.uint64)
    return hashes[coded.indices.to_numpy()]


def _pair_hashes(hashes: np.ndarray) -> np.ndarray:
    """Of each word and the next; one less than there are words."""
    return _mixed(hashes[:-1] * np.uint64(_ODD[1]) + _mixed(hashes[1:]))


def _offsets(lists: pa.ListArray) -> np.ndarray:
    offsets = lists.offsets.to_numpy()
    return offsets - offsets[0]


def _starts(hashes: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Places where chunks begin: the first word of each piece, and before
    certain pairs of words of one piece."""
    begins = np.zeros(len(hashes), dtype=bool)
    if len(hashes) > 1:
        begins[:-1] = _mixed(_pair_hashes(hashes)) % np.uint64(_CHUNK_WORDS) == 0
    # A pair over the end of a piece is none.
    ends = firsts[1:] - 1
    begins[ends] = False
    if len(hashes):
        begins[-1] = False
    begins[firsts] = True
    return np.flatnonzero(begins)


def _chunks(texts: pa.Array, longest: int) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Row of the text, words joined by a space, and number of words that belong
    to it, of each chunk."""
    lower = pc.ascii_lower(pc.fill_null(texts, ""))
    pieces = pc.split_pattern_regex(lower, r"[.,;:!?\x0A-\x0D]")
    rows = np.repeat(np.arange(len(texts)), np.diff(_offsets(pieces)))
    split = pc.split_pattern_regex(pieces.flatten(), r"[\x20\x09]+")
    flat, owner = split.flatten(), np.repeat(np.arange(len(split)), np.diff(_offsets(split)))
    real = pc.not_equal(flat, "")
    words, owner = flat.filter(real), owner[real.to_numpy(zero_copy_only=False)]
    if not len(words):
        return np.zeros(0, dtype=np.int64), pa.array([], pa.string()), np.zeros(0, dtype=np.int64)
    firsts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    starts = _starts(_word_hashes(words), firsts)
    ends = np.append(starts[1:], len(words))
    piece_ends = np.append(firsts[1:], len(words))[np.searchsorted(firsts, starts, side="right") - 1]
    lengths = np.minimum(ends + longest - 1, piece_ends) - starts
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    places = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], lengths)
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), words.take(pa.array(places))), " ")
    return rows[owner[starts]], joined, ends - starts


def parse(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = 5) -> DataFrame:
    """The dictionary of the parse: (lang, chunk, own, times), a row for each
    distinct chunk. ``own`` is the number of its first words that belong to it;
    the up to ``longest`` - 1 words behind them begin in the next chunk."""

    def parse_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = string_column(batch, "_text")
            for start, length in slices_by_bytes(texts, _TEXT_BYTES):
                rows, chunks, own = _chunks(texts.slice(start, length), longest)
                langs = batch.column("_lang").take(pa.array(rows + start))
                yield pa.RecordBatch.from_arrays(
                    [langs, chunks, pa.array(own.astype(np.int32))], names=["lang", "chunk", "own"]
                )

    lang = F.coalesce(docs[lang_col].cast("string"), F.lit(UNKNOWN))
    chunks = docs.select(lang.alias("_lang"), docs[text_col].alias("_text")).mapInArrow(
        parse_task, "lang string, chunk string, own int"
    )
    return chunks.groupBy("lang", "chunk", "own").agg(F.count("*").alias("times"))


def _lang_hashes(langs: pa.Array) -> np.ndarray:
    return _mixed(_word_hashes(langs) ^ np.uint64(_ODD[2]))


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches put together to about ``_FOLDED_BYTES``, so that more folds."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= _FOLDED_BYTES:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def _chunk_words(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words of all chunks, the chunk of each, and its place in the chunk."""
    split = pc.split_pattern(string_column(batch, "chunk"), " ")
    offsets = _offsets(split)
    sizes = np.diff(offsets)
    owner = np.repeat(np.arange(len(split)), sizes)
    return split.flatten(), owner, np.arange(offsets[-1]) - np.repeat(offsets[:-1], sizes)


def _lang_hashes_of(words: pa.Array, owner: np.ndarray, langs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, within a language, of each word and of each pair of neighbours."""
    hashes = _word_hashes(words)
    lang = _lang_hashes(langs)[owner]
    pairs = _pair_hashes(hashes) if len(words) > 1 else np.zeros(0, dtype=np.uint64)
    least = np.uint64(64 - _HASH_BITS)
    return _mixed(hashes + lang) >> least, _mixed(pairs ^ lang[: len(pairs)]) >> least


def _frequent_hashes(dictionary: DataFrame, least: int) -> DataFrame:
    """Hashes of words and of word pairs with ``least`` occurrences or more. Those
    of one hash count together, so nothing that is frequent is missing."""

    def hash_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches):
            words, owner, place = _chunk_words(batch)
            of_words, of_pairs = _lang_hashes_of(words, owner, batch.column("lang"))
            begins = place < batch.column("own").to_numpy()[owner]
            paired = begins[:-1] & (owner[1:] == owner[:-1])
            times = batch.column("times").to_numpy()[owner]
            counted = np.concatenate([of_words[begins], of_pairs[paired]])
            hashes, where = np.unique(counted, return_inverse=True)
            sums = np.zeros(len(hashes), dtype=np.int64)
            np.add.at(sums, where, np.concatenate([times[begins], times[:-1][paired]]))
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(sums)], names=["hash", "times"])

    hashes = dictionary.mapInArrow(hash_task, "hash long, times long")
    return hashes.groupBy("hash").agg(F.sum("times").alias("times")).where(F.col("times") >= least).select("hash")


def _filter_of(spark: SparkSession, hashes: DataFrame):
    """A bitmap over hashes, on every executor. Its size follows their number up
    to a fixed bound; what it lets through too much is counted and found too
    rare later."""
    bits, wanted = _LEAST_BITS, _BITS_EACH * hashes.count()
    while bits < min(_MOST_BITS, wanted):
        bits *= 2
    bit = F.col("hash").bitwiseAND(F.lit(bits - 1)) + 1
    rows = (
        hashes.groupBy(F.bitmap_bucket_number(bit).alias("at"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
        .collect()  # 32 MB at most, as _MOST_BITS says
    )
    bitmap = np.zeros(bits // 8, dtype=np.uint8)
    for row in rows:
        first = (row["at"] - 1) * (_BITMAP_BITS // 8)
        bitmap[first : first + len(row["bits"])] = np.frombuffer(row["bits"], dtype=np.uint8)
    return spark.sparkContext.broadcast(bitmap)


def _may_be_frequent(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bit = hashes & np.uint64(8 * len(bitmap) - 1)
    return (bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _escaped(texts: pa.Array) -> pa.Array:
    """Texts without zero characters, which part the words of a window."""
    return pc.replace_substring(pc.replace_substring(texts, "\x01", "\x01\x02"), _PART, "\x01\x01")


def _unescaped(text: str) -> str:
    return text.replace("\x01\x01", _PART).replace("\x01\x02", "\x01")


def _joined(words: pa.Array, at: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The ``sizes`` words from each place of ``at`` on."""
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    places = np.arange(offsets[-1]) + np.repeat(at - offsets[:-1], sizes)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), words.take(pa.array(places))), _PART)


def _windows(batch: pa.RecordBatch, bitmap: np.ndarray, longest: int) -> Iterator[pa.RecordBatch]:
    """(key, times) of each place where a phrase may begin: the language and the
    words from there on as long as each pair of neighbours may be frequent. Equal
    windows of one word, which are most, are put together."""
    words, owner, place = _chunk_words(batch)
    if not len(words):
        return
    langs, times = batch.column("lang"), batch.column("times").to_numpy()
    of_words, of_pairs = _lang_hashes_of(words, owner, langs)
    at = np.flatnonzero((place < batch.column("own").to_numpy()[owner]) & _may_be_frequent(bitmap, of_words))
    hopeful = _may_be_frequent(bitmap, of_pairs) & (owner[1:] == owner[:-1])
    last = np.append(np.flatnonzero(~hopeful), len(words) - 1)
    sizes = np.minimum(last[np.searchsorted(last, at)] - at + 1, longest)
    if any(pc.any(pc.match_substring(column, mark)).as_py() for column in (words, langs) for mark in (_PART, "\x01")):
        words, langs = _escaped(words), _escaped(langs)
    lone = at[sizes == 1]
    table = pa.table({"lang": langs.take(pa.array(owner[lone])), "word": words.take(pa.array(lone)), "times": times[owner[lone]]})
    folded = table.group_by(["lang", "word"]).aggregate([("times", "sum")]).combine_chunks()
    for part in folded.to_batches():
        keys = pc.binary_join_element_wise(part.column("lang"), part.column("word"), _PART)
        yield pa.RecordBatch.from_arrays([keys, part.column("times_sum")], names=["key", "times"])
    at, sizes = at[sizes > 1], sizes[sizes > 1]
    for start in range(0, len(at), _WINDOWS_EACH):
        some = at[start : start + _WINDOWS_EACH]
        keys = pc.binary_join_element_wise(
            langs.take(pa.array(owner[some])), _joined(words, some, sizes[start : start + _WINDOWS_EACH]), _PART
        )
        yield pa.RecordBatch.from_arrays([keys, pa.array(times[owner[some]])], names=["key", "times"])


def _counted_rows(found: list[tuple[str, int]], words: int) -> pa.RecordBatch:
    parts = [key.split(_PART) for key, _ in found]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([_unescaped(part[0]) for part in parts], pa.string()),
            pa.array([words] * len(found), pa.int32()),
            pa.array([_unescaped(" ".join(part[1:])) for part in parts], pa.string()),
            pa.array([times for _, times in found], pa.int64()),
        ],
        names=["lang", "words", "phrase", "times"],
    )


def _prefix_counts(batches: Iterator[pa.RecordBatch], least: int, longest: int) -> Iterator[pa.RecordBatch]:
    """Counts of the phrases that windows begin with; windows come in order of
    their keys, so those of a phrase are neighbours. Only the first and the last
    phrase of each length can go on in another task: they are given whatever
    their count, others from ``least`` on."""
    # By length: the phrase that the last windows began with, its count, and
    # whether it was the first of the task.
    held: dict[int, tuple[str, int, bool]] = {}
    for batch in _gathered(batches):
        split = pc.split_pattern(string_column(batch, "key"), _PART)
        offsets, flat, times = _offsets(split), split.flatten(), batch.column("times").to_numpy()
        sizes = np.diff(offsets) - 1
        for size in range(1, longest + 1):
            rows = np.flatnonzero(sizes >= size)
            if not len(rows):
                continue
            phrases = _joined(flat, offsets[rows], np.full(len(rows), size + 1))
            changed = pc.not_equal(phrases.slice(1), phrases.slice(0, len(rows) - 1)).to_numpy(zero_copy_only=False)
            starts = np.concatenate([[0], np.flatnonzero(changed) + 1])
            sums = np.add.reduceat(times[rows], starts)
            first, found = phrases[0].as_py(), []
            begun = size not in held
            if not begun and held[size][0] == first:
                sums[0] += held[size][1]
                begun = held[size][2]
            elif not begun and (held[size][2] or held[size][1] >= least):
                found.append(held[size][:2])
            given = sums >= least
            given[0] |= begun
            given[-1] = False
            where = np.flatnonzero(given)
            found += zip(phrases.take(pa.array(starts[where])).to_pylist(), sums[where].tolist(), strict=True)
            held[size] = (phrases[int(starts[-1])].as_py(), int(sums[-1]), begun and len(starts) == 1)
            if found:
                yield _counted_rows(found, size)
    for size, (phrase, count, _) in held.items():
        yield _counted_rows([(phrase, count)], size)


def phrase_counts(
    docs: DataFrame, least: int = 100, longest: int = 5, text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """Occurrences of each word and phrase of up to ``longest`` words that has
    ``least`` of them or more.

    Returns (lang, words, phrase, times, n), ``n`` being all words of the
    language. A first pass over the dictionary finds frequent words and pairs of
    neighbours by hash; the second gives one window from each place, the words up
    to the first pair that is not among them, as no phrase over it can be
    frequent. Windows in order are counted by all their beginnings, word by word
    (SUFFIX-sigma, Berberich and Bedathur, 2013, but by ranges of whole windows,
    so that a very frequent first word is spread).
    """
    spark = docs.sparkSession
    dictionary = pin(parse(docs, text_col, lang_col, longest))
    bitmap = _filter_of(spark, checkpointed(_frequent_hashes(dictionary, least)))

    def window_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches):
            yield from _windows(batch, bitmap.value, longest)

    def prefix_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _prefix_counts(batches, least, longest)

    windows = dictionary.mapInArrow(window_task, "key string, times long").groupBy("key").agg(F.sum("times").alias("times"))
    ordered = windows.repartitionByRange("key").sortWithinPartitions("key")
    counted = ordered.mapInArrow(prefix_task, "lang string, words int, phrase string, times long")
    counts = counted.groupBy("lang", "words", "phrase").agg(F.sum("times").alias("times"))
    totals = dictionary.groupBy("lang").agg(F.sum(F.col("own") * F.col("times")).alias("n"))
    return counts.where(F.col("times") >= least).join(totals, "lang")


def _exact(name: str):
    return F.col(name).cast("decimal(19,0)")


def scored_phrases(counts: DataFrame) -> DataFrame:
    """(lang, phrase, words, a, l, r, n, score) of each frequent phrase that no
    longer one covers; ``counts`` as ``phrase_counts`` gives them, stored.

    The score is that of the weakest cut into a first part and a rest, the first
    such cut of equals. A phrase is covered by one that has it inside and occurs
    as often; as counts only fall with more words, there is then one with a
    single word more.
    """
    phrases = counts.where("words > 1").select("lang", "phrase", "words", F.col("times").alias("a"), "n")
    parts = F.split("phrase", " ")

    def joined(first, size):
        return F.array_join(F.slice(parts, first, size), " ")

    inner = F.array(joined(F.lit(1), F.col("words") - 1), joined(F.lit(2), F.col("words") - 1))
    covering = (
        phrases.where("words > 2")
        .select("lang", F.explode(inner).alias("phrase"), "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("covered"))
    )
    kept = phrases.join(covering, ["lang", "phrase"], "left").where("covered IS NULL OR covered < a").drop("covered")
    cuts = kept.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "*", joined(F.lit(1), F.col("cut")).alias("left"), joined(F.col("cut") + 1, F.col("words") - F.col("cut")).alias("right")
    )
    left = counts.select("lang", F.col("phrase").alias("left"), F.col("times").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("right"), F.col("times").alias("r"))
    known = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"])
    known = known.withColumn("_over", _exact("a") * _exact("n")).withColumn("_under", _exact("l") * _exact("r"))
    # Whole thousands, digit by digit, so that no product passes 38 digits.
    whole = F.expr("_over div _under")
    rest = F.expr("((_over % _under) * 1000) div _under")
    scored = known.withColumn("score", (whole * 1000 + rest).cast("long"))
    best = F.min(F.struct("score", "cut", "l", "r")).alias("_best")
    weakest = scored.groupBy("lang", "phrase", "words", "a", "n").agg(best)
    return weakest.select("lang", "phrase", "words", "a", "_best.l", "_best.r", "n", "_best.score")


def collocations(
    docs: DataFrame,
    least: int = 100,
    longest: int = 5,
    most: int = 2000,
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """The ``most`` strongest phrases of each language.

    Texts are lower-cased in A-Z and cut into pieces at marks and line breaks,
    these into words at spaces and tabs. A phrase is 2 to ``longest`` words of
    one piece with ``least`` occurrences or more; what ``scored_phrases`` says
    gives its score. Languages are apart, a null one being ``und``. Null and
    empty texts have no words; repeated rows count each time; ids and other
    columns are not read; an empty table gives no row. Ties go by more
    occurrences, then by the phrase in byte order.

    Returns (lang, rank, phrase, a, l, r, n, score).
    """
    # What has ``least`` or more is at most the words by ``least``.
    counts = checkpointed(phrase_counts(docs, least, longest, text_col, lang_col))
    scored = scored_phrases(counts)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    return top_n_per_key(scored, ["lang"], order, most).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
