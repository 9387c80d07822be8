"""Benchmark decontamination by spaced seeds, in DataFrame functions only.

A mask names the places of a span of words that a seed hashes; the others may
differ. Seeds of the documents meet seeds of the benchmark, which gives pairs
of texts and how far one is shifted against the other. Around such a hit the
words of both are compared along that shift, so substituted words are allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegrid.llm.common import checkpointed

#: Places of a span of 7 words. Every run of 16 words with up to 3 substituted
#: holds a hit of one of them, which the tests enumerate.
MASKS = ((0, 1, 3, 5, 6), (0, 1, 2, 3, 6))
WINDOW, EQUAL = 16, 13
_SPAN = max(mask[-1] for mask in MASKS) + 1
#: Items of so few words are equal as a whole or not at all, and are one seed.
_WHOLE = 4
_CLOSE = ((0, 1, 2, 4, 5), (0, 1, 2, 3, 4))
#: What shorter items need besides, by their number of words, to be hit with up
#: to a fifth of the words substituted; the tests enumerate these, too.
SHORT_MASKS = {
    **{words: (tuple(range(words)),) for words in range(1, _WHOLE + 1)},
    5: ((0, 1, 2, 3), (0, 2, 3, 4), (0, 1, 3, 4), (0, 1, 2, 4)),
    6: ((0, 1, 2, 3), (0, 1, 4, 5)),
    7: _CLOSE,
    8: _CLOSE[:1],
    10: _CLOSE,
    11: _CLOSE[:1],
    15: _CLOSE[:1],
}
#: Seeds, or ids of documents with hits, that may be sent to every executor
#: (some 32 bytes each).
MOST_BROADCAST = 1_000_000


def words_of(text: Column) -> Column:
    """Lower-cased runs of letters and digits; none for a null text."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda word: word != "")


def masks_for(lengths: set[int]) -> list[tuple[int, ...]]:
    """All masks that items of these numbers of words need."""
    short = {mask for words in lengths for mask in SHORT_MASKS.get(words, ())}
    return [*MASKS, *sorted(short - set(MASKS))]


def _least_span(masks: list[tuple[int, ...]]) -> int:
    return min(mask[-1] for mask in masks) + 1


def _needs(mask: tuple[int, ...], words: Column) -> Column:
    """Whether an item of so many words is searched by the mask."""
    short = [F.lit(count) for count, masks in SHORT_MASKS.items() if mask in masks]
    return words >= _SPAN if mask in MASKS else words.isin(short)


def _seeds(hashes: Column, masks: list[tuple[int, ...]], of_items: bool) -> Column:
    """Seeds of all masks at all places, those of one mask after the other's;
    null where a mask does not fit or an item does not need it."""
    least = _least_span(masks)
    count = F.size(hashes) - least + 1
    places = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))

    def seed(number: int, mask: tuple[int, ...]):
        def at_place(at: Column) -> Column:
            value = F.xxhash64(F.lit(number), *[F.get(hashes, at + place) for place in mask])
            if mask[-1] + 1 > least:
                value = F.when(at + mask[-1] < F.size(hashes), value)
            return F.when(_needs(mask, F.size(hashes)), value) if of_items else value

        return at_place

    return F.concat(*[F.transform(places, seed(number, mask)) for number, mask in enumerate(masks)])


def _seed_rows(texts: DataFrame, key: str, place: str, masks: list[tuple[int, ...]], *kept: str) -> DataFrame:
    """(key, place, seed, kept), a row for each mask and place."""
    hashed = texts.select(
        key, *kept, F.transform(words_of(F.col("_text")), lambda word: F.xxhash64(word)).alias("_hashes")
    )
    places = F.greatest(F.size("_hashes") - _least_span(masks) + 1, F.lit(1)).alias("_places")
    # Outer, as Spark else computes the seeds once more to skip empty arrays;
    # the array itself must not be asked for behind the explode, or every row
    # would carry a copy. The row without a seed meets nothing.
    seeds = _seeds(F.col("_hashes"), masks, of_items=bool(kept)).alias("_seeds")
    rows = hashed.select(key, *kept, places, seeds).select(
        key, *kept, "_places", F.posexplode_outer("_seeds").alias("_at", "seed")
    )
    return rows.select(key, (F.col("_at") % F.col("_places")).alias(place), "seed", *kept)


def text_key(text: Column) -> Column:
    """128 bits that tell texts apart; equal texts are judged once."""
    whole = F.coalesce(text.cast("string"), F.lit(""))
    return F.struct(F.xxhash64(F.lit(1), whole).alias("h1"), F.xxhash64(F.lit(2), whole).alias("h2"))


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    most_broadcast: int = MOST_BROADCAST,
) -> DataFrame:
    """Pairs of a document and a benchmark item that overlap.

    They overlap if, at one shift, 13 of 16 consecutive words are equal; for an
    item of fewer than 16 words, all of it counts and up to a fifth of the words
    may differ, so one of fewer than 5 words must be there as it is.

    Returns (id, item, item_words, window_words, equal_words), a row per pair:
    the most equal words in a window, and in the whole item at one shift. Case
    and marks do not count. Null and empty texts overlap with nothing. Texts are
    compared one by one; of rows that share an id, or have none, those that
    overlap give one row per item together. Empty tables give no row. Other
    columns are left out.

    The seeds of the benchmark, and then the texts with a hit, are broadcast up
    to ``most_broadcast`` rows and joined by a shuffle beyond, with the same
    result.
    """
    found, few = _overlaps(docs[text_col], docs, benchmark, item_col, item_text_col, most_broadcast)
    named = docs.select(docs[id_col].alias("_id"), text_key(docs[text_col]).alias("_doc"))
    return (
        named.join(F.broadcast(found) if few else found, "_doc")
        .groupBy(F.col("_id").alias(id_col), F.col("_item").alias(item_col))
        .agg(*[F.max(name).alias(name) for name in ("item_words", "window_words", "equal_words")])
    )


def _overlaps(
    text: Column, docs: DataFrame, benchmark: DataFrame, item_col: str, item_text_col: str, most_broadcast: int
) -> tuple[DataFrame, bool]:
    """(_doc, _item, item_words, window_words, equal_words) by text key, stored,
    and whether its rows may be broadcast."""
    texts = docs.select(text_key(text).alias("_doc"), text.cast("string").alias("_text"))
    items = benchmark.select(benchmark[item_col].alias("_item"), benchmark[item_text_col].cast("string").alias("_text"))
    # Lengths from 16 on are one, so there are some 16 rows at most.
    length = F.least(F.size(words_of(F.col("_text"))), F.lit(WINDOW))
    items = items.withColumn("_length", length)
    masks = masks_for({row[0] for row in items.select("_length").distinct().collect()})
    tests = _seed_rows(items, "_item", "_item_at", masks, "_length").where("seed IS NOT NULL")
    small = tests.count() <= most_broadcast
    hits = _seed_rows(texts, "_doc", "_doc_at", masks).join(F.broadcast(tests) if small else tests, "seed")
    # The hits of an item that is one seed are all alike, and one of them will do.
    shift, whole = F.col("_doc_at") - F.col("_item_at"), F.col("_length") <= _WHOLE
    shifts = checkpointed(
        hits.groupBy("_doc", "_item", F.when(whole, F.col("_length")).alias("_alike"), F.when(~whole, shift).alias("_apart"))
        .agg(F.min(shift).alias("_shift"))
        .select("_doc", "_item", "_shift")
    )
    few = shifts.count() <= most_broadcast
    # Only texts with a hit are cut into words again, and moved.
    hit = shifts.select("_doc").distinct()
    hit_texts = texts.join(F.broadcast(hit) if few else hit, "_doc", "left_semi")
    doc_words = hit_texts.groupBy("_doc").agg(F.first("_text").alias("_text")).select(
        "_doc", words_of(F.col("_text")).alias("_words")
    )
    item_words = items.select(F.col("_item").alias("_of"), words_of(F.col("_text")).alias("_test"))
    both = (
        shifts.join(F.broadcast(item_words) if small else item_words, F.col("_item").eqNullSafe(F.col("_of")))
        .join(doc_words, "_doc")
        .select(
            "_doc", "_item", F.size("_test").alias("item_words"), _equal_at("_test", "_words", "_shift").alias("_equal")
        )
    )
    window = F.least(F.lit(WINDOW), F.col("item_words"))
    ends = F.sequence(F.lit(0), F.col("item_words") - window)
    sums = F.transform(ends, lambda at: _total(F.slice("_equal", at + 1, window)))
    needed = F.when(F.col("item_words") >= WINDOW, F.lit(EQUAL)).otherwise(window - F.floor(window / 5).cast("int"))
    best, equal = F.array_max(sums).alias("_best"), _total(F.col("_equal")).alias("_all")
    found = both.select("_doc", "_item", "item_words", best, equal, needed.alias("_needed")).where("_best >= _needed")
    best_of = found.groupBy("_doc", "_item").agg(
        F.max("item_words").alias("item_words"), F.max("_best").alias("window_words"), F.max("_all").alias("equal_words")
    )
    stored = checkpointed(best_of)
    return stored, few and stored.count() <= most_broadcast


def _equal_at(test: str, words: str, shift: str) -> Column:
    """1 where the word of the item equals the document's at that shift, else 0."""
    return F.transform(
        F.col(test),
        lambda word, at: F.coalesce((F.get(F.col(words), at + F.col(shift)) == word).cast("int"), F.lit(0)),
    )


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda total, value: total + value)


def decontaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    most_broadcast: int = MOST_BROADCAST,
) -> DataFrame:
    """``docs``, all columns, without the rows whose text overlaps with an item,
    as ``contaminated`` tells it. Ids are not read: each row goes or stays by its
    own text, so repeated rows go together, and rows that share an id or have none
    do not. Null and empty texts stay; an empty benchmark takes nothing."""
    found, few = _overlaps(docs[text_col], docs, benchmark, item_col, item_text_col, most_broadcast)
    leaks = found.select(F.col("_doc").alias("_leak")).distinct()
    return docs.join(F.broadcast(leaks) if few else leaks, text_key(docs[text_col]) == F.col("_leak"), "left_anti")
