"""Best and worst unrated items in each user's favourite category.

A user who gave ``c`` ratings in a category finds the ``n`` best unrated items
of it among its first ``n + c`` places. So categories are ranked once, and the
places that a user has rated there become bits of 64-place words; the items are
the first ``n`` bits that are not set. No list of candidates is made, and no
pair of user and item is compared.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegrid.operators.preferences import favourite_category, with_favourite, with_flags
from tastegrid.operators.ranking import stored_in_order
from tastegrid.operators.ratings import item_stats
from tastegrid.schemas import GENRES
from tastegrid.session import pin

# Places of a word of bits.
WORD_PLACES = 64
# Places in reach that may be sent to every executor, some 40 bytes each.
MOST_BROADCAST = 500_000


def category_item_stats(stats: DataFrame, items: DataFrame, min_support: int = 5) -> DataFrame:
    """Mean and count per category and item with enough ratings. An item's
    figures are the same in each of its categories, so they are made once."""
    supported = stats.where(F.col("rating_count") >= min_support)
    joined = supported.join(items.select("item_id", "title", "genres"), "item_id")
    return joined.select(F.explode("genres").alias("genre"), "item_id", "title", "avg_rating", "rating_count")


def seen_pairs(ratings: DataFrame) -> DataFrame:
    """Distinct user-item pairs; the map-side step folds repeated pairs."""
    return ratings.select("user_id", "item_id").distinct()


def best_unrated(
    ratings: DataFrame,
    items: DataFrame,
    n: int = 5,
    min_support: int = 5,
    direction: str = "desc",
    stats: DataFrame | None = None,
    labels: Sequence[str] = GENRES,
) -> DataFrame:
    """Per user the first ``n`` unrated items of the favourite category, by
    rounded mean in ``direction`` and then item id. ``stats`` takes item means
    that are already at hand.

    Ratings of places that are beyond every user's reach do not matter. The
    others are folded to a word of bits per user, category and 64 places, which
    spreads a user with very many ratings. What is used twice is stored. Places
    in reach are broadcast up to ``MOST_BROADCAST`` of them; more are stored, too,
    so that Spark knows their size and can split a hot item.
    """
    stats = item_stats(ratings) if stats is None else stats
    ranking, sizes = category_ranking(category_item_stats(stats, items, min_support), direction)
    favourites = favourite_category(ratings, items, 1, labels).withColumnRenamed("favorite_genre", "genre")
    wanted = F.least(_by_label(sizes), F.col("genre_rating_count") + n)
    reach = pin(favourites.select("user_id", "genre", wanted.alias("reach")).where("reach > 0"))
    # One row per label of the vocabulary at most.
    deepest = dict(reach.groupBy("genre").agg(F.max("reach")).collect())
    offered = ranking.where(F.col("place") < _by_label(deepest))
    places = item_places(offered)
    places = F.broadcast(places) if sum(deepest.values()) <= MOST_BROADCAST else pin(places)
    free = first_free_places(reach, rated_words(ratings, places), n)
    return (
        free.select("user_id", "genre", F.posexplode("places").alias("at", "place"))
        .join(offered, ["genre", "place"])
        .select(
            "user_id",
            (F.col("at") + 1).alias("rank"),
            "item_id",
            "title",
            "avg_rating",
            F.col("genre").alias("fav_genre"),
        )
    )


def item_places(ranking: DataFrame) -> DataFrame:
    """(item_id, entries): an item's categories, each with its place there."""
    return ranking.groupBy("item_id").agg(F.collect_list(F.struct("genre", "place")).alias("entries"))


def rated_words(ratings: DataFrame, places: DataFrame) -> DataFrame:
    """(user_id, genre, word, bits): a bit for each of 64 places of a category
    that the user has rated; words without any are left out."""
    each = ratings.select("user_id", "item_id").join(places, "item_id").select("user_id", F.explode("entries").alias("entry"))
    bit = F.expr(f"shiftleft(1L, CAST(entry.place % {WORD_PLACES} AS INT))")
    word = F.expr(f"entry.place div {WORD_PLACES}")
    return each.groupBy("user_id", F.col("entry.genre").alias("genre"), word.alias("word")).agg(F.bit_or(bit).alias("bits"))


def first_free_places(reach: DataFrame, words: DataFrame, n: int) -> DataFrame:
    """(user_id, genre, places): the first ``n`` places under ``reach`` that are
    not rated, in order. The words of one user and category that come together
    are bounded by the ranking, one for 64 places of it."""
    taken = words.groupBy("user_id", "genre").agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("words"))
    end = F.struct(F.expr(f"(reach + {WORD_PLACES - 1}) div {WORD_PLACES}").alias("word"), F.lit(-1).cast("bigint").alias("bits"))
    nothing = F.struct(F.lit(0).cast("bigint").alias("next"), F.array().cast("array<bigint>").alias("places"))
    own = F.concat(F.coalesce("words", F.array().cast("array<struct<word:bigint,bits:bigint>>")), F.array(end))
    walked = F.aggregate(own, nothing, lambda seen, one: _with_free(seen, one, n))
    places = F.slice(F.filter(walked["places"], lambda place: place < F.col("reach")), 1, n)
    return reach.join(taken, ["user_id", "genre"], "left").select("user_id", "genre", places.alias("places"))


def _with_free(seen: Column, one: Column, n: int) -> Column:
    """Free places up to the end of a word: those of the words before it that have
    no rating, ``n`` at most, and the bits of it that are not set."""
    start, first = one["word"] * WORD_PLACES, seen["next"] * WORD_PLACES
    last = F.least(start, first + n) - 1
    between = F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))
    bits = F.filter(F.lit(list(range(WORD_PLACES))), lambda at: F.getbit(one["bits"], at) == 0)
    inside = F.transform(bits, lambda at: start + at)
    more = F.when(F.size(seen["places"]) < n, F.concat(seen["places"], between, inside)).otherwise(seen["places"])
    return F.struct((one["word"] + 1).alias("next"), more.alias("places"))


def _by_label(values: dict[str, int]) -> Column:
    """The value of each row's ``genre``, null for one without."""
    if not values:
        return F.lit(None).cast("bigint")
    pairs = [F.lit(x) for label, value in values.items() for x in (label, value)]
    return F.create_map(*pairs)[F.col("genre")].cast("bigint")


def category_ranking(quality: DataFrame, direction: str) -> tuple[DataFrame, dict[str, int]]:
    """``place`` of each item in its category, from 0, by mean and item id, and
    the number of items of each category.

    All categories are sorted in parallel, as one may hold most items. The
    driver gets one row per stored partition and category in it, and works out
    where each of these pieces starts.
    """
    mean = F.asc("avg_rating") if direction == "asc" else F.desc("avg_rating")
    stored = stored_in_order(quality.drop("rating_count"), [F.col("genre"), mean, F.col("item_id")])
    pieces = stored.groupBy("_part", "genre").agg(F.min("_slot").alias("first"), F.count("*").alias("rows")).collect()
    sizes: dict[str, int] = {}
    shifts = []
    for piece in sorted(pieces, key=lambda piece: piece["_part"]):
        before = sizes.get(piece.genre, 0)
        shifts.append((piece["_part"], piece.genre, before - piece.first))
        sizes[piece.genre] = before + piece.rows
    starts = quality.sparkSession.createDataFrame(shifts, "_part bigint, genre string, _shift bigint")
    placed = stored.join(F.broadcast(starts), ["_part", "genre"])
    return placed.withColumn("place", F.col("_slot") + F.col("_shift")).drop("_part", "_slot", "_shift"), sizes


def unrated_counts(
    ratings: DataFrame,
    items: DataFrame,
    min_support: int = 5,
    stats: DataFrame | None = None,
    labels: Sequence[str] = GENRES,
) -> DataFrame:
    """How many qualified items of the favourite category each user has not
    rated: the category's size less the distinct ones rated, so that no list of
    candidates is made. Ratings are folded to user-item pairs once, which give
    both the favourite and the rated items. The items with their flags are
    stored, so that Spark knows their size in the join."""
    stats = item_stats(ratings) if stats is None else stats
    supported = stats.where(F.col("rating_count") >= min_support).select("item_id", F.lit(True).alias("qualified"))
    known = pin(with_flags(items, labels, "genres").join(supported, "item_id", "left"))
    pairs = ratings.groupBy("user_id", "item_id").agg(F.count("*").alias("times"))
    each = range(len(labels))
    per_user = (
        pairs.join(known.drop("genres"), "item_id")
        .groupBy("user_id")
        .agg(
            *[F.expr(f"sum(if(is_{i}, times, 0)) AS n_{i}") for i in each],
            *[F.expr(f"count_if(is_{i} AND qualified) AS rated_{i}") for i in each],
        )
    )
    rated = F.get(F.array(*[f"rated_{i}" for i in each]), F.col("label_index"))
    favourites = with_favourite(per_user, [f"n_{i}" for i in each], labels).select(
        "user_id", "favorite_genre", rated.alias("rated_qualified")
    )
    qualified = known.where("qualified").select(F.explode("genres").alias("favorite_genre"))
    sizes = qualified.groupBy("favorite_genre").agg(F.count("*").alias("qualified_items"))
    left = F.col("qualified_items") - F.col("rated_qualified")
    return (
        favourites.join(F.broadcast(sizes), "favorite_genre")
        .select("user_id", "favorite_genre", left.alias("candidates"))
        .where(F.col("candidates") > 0)
    )


def most_excluded(exclusions: DataFrame) -> DataFrame:
    """Items by the number of users they are kept from, most first."""
    return (
        exclusions.groupBy("item_id", "title")
        .agg(F.count("*").alias("excluded_for"), F.first("avg_rating").alias("avg_rating"))
        .orderBy(F.desc("excluded_for"), F.asc("avg_rating"), F.asc("item_id"))
    )
