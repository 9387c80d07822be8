"""Hard negatives by bounds along a spanning tree of the anchors.

The scores of two anchors against one vector differ by at most the distance of
the anchors times the norm of the vector. So scores at an anchor, or bounds on
them, bound those at its neighbours in a spanning tree, and only rows whose
bounds overlap with the scores that are asked for are scored again.

Rows are dealt to blocks, anchors to stretches of near ones, and each task takes
one block against one stretch. What a task finds is cut to the few best rows of
each window before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import inf

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegrid.llm.common import checkpointed
from tastegrid.operators.ranking import dense_positions, top_n_per_key

#: Rows of a block and anchors of a stretch, which bound what a task holds.
BLOCK_ROWS, STRETCH_ANCHORS = 8192, 8192
#: Anchors of one label that a spanning tree has at most.
TREE_ANCHORS = 512
# Rows that are scored together, and signs that anchors are ordered by.
_TOGETHER, _SIGNS = 4096, 16
# Sums of whole numbers below it are exact in doubles.
_EXACT = 2.0**53
_LARGEST = 2.0**62
_TREE = "stretch long, tree long, label string, place int, parent int, edge double, anchor long, anchor_id long, own binary"
_FOUND = "anchor long, anchor_id long, slot int, other long, score long"


def _whole_steps(vectors: pa.Array, scale: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which vectors count, floor(scale * x) of all their components, and the
    number of these."""
    lists = vectors.cast(pa.list_(pa.float64()))
    offsets = lists.offsets.to_numpy()
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    # Null components have become NaN; null lists have no values.
    sizes = np.diff(offsets) * ~lists.is_null().to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(lists)), sizes)
    odd = np.zeros(len(lists), dtype=bool)
    odd[owner[~np.isfinite(values)]] = True
    good = ~odd & lists.is_valid().to_numpy(zero_copy_only=False)
    with np.errstate(invalid="ignore", over="ignore"):
        steps = np.floor(scale * values[good[owner]])
    if len(steps) and not np.abs(steps).max() < _LARGEST:
        raise OverflowError("a component has too many steps for scores of 64 bits")
    return good, steps.astype("<i8"), sizes[good]


def whole_vectors(df: DataFrame, id_col: str, label: Column, vector_col: str, scale: float) -> DataFrame:
    """(id, label, own, signs) of the rows that take part: ``own`` holds the
    components in whole steps as little-endian 64-bit numbers."""

    def quantise_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, steps, sizes = _whole_steps(batch.column("_vector"), scale)
            ends = np.cumsum(sizes)
            owns = [steps[end - size : end] for end, size in zip(ends.tolist(), sizes.tolist())]
            signs = [int("".join("01"[x >= 0] for x in own[:_SIGNS].tolist()).ljust(_SIGNS, "0"), 2) for own in owns]
            kept = pa.array(good)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id").filter(kept),
                    batch.column("_label").filter(kept),
                    pa.array([own.tobytes() for own in owns], pa.binary()),
                    pa.array(signs, pa.int32()),
                ],
                names=["id", "label", "own", "signs"],
            )

    named = df.select(df[id_col].cast("long").alias("_id"), label.cast("string").alias("_label"), df[vector_col].alias("_vector"))
    return named.where("_label IS NOT NULL AND _vector IS NOT NULL").mapInArrow(
        quantise_task, "id long, label string, own binary, signs int"
    )


def _matrix(owns: list[bytes], width: int) -> np.ndarray:
    """Rows of whole numbers; shorter ones go on with zeros."""
    out = np.zeros((len(owns), width), dtype=np.int64)
    for row, own in enumerate(owns):
        out[row, : len(own) // 8] = np.frombuffer(own, "<i8")
    return out


def _norms(rows: np.ndarray) -> np.ndarray:
    return np.sqrt((rows.astype(np.float64) ** 2).sum(axis=1))


def spanning_tree(rows: np.ndarray) -> list[tuple[int, int, float]]:
    """(row, place of its parent, distance), parents first; the first row has
    parent -1. Each step takes the row that is nearest to the tree."""
    points = rows.astype(np.float64)
    near, parent = np.full(len(points), inf), np.full(len(points), -1)
    left = np.ones(len(points), dtype=bool)
    out, at = [], 0
    for place in range(len(points)):
        out.append((at, int(parent[at]), float(near[at]) if place else 0.0))
        left[at] = False
        apart = np.sqrt(((points - points[at]) ** 2).sum(axis=1))
        closer = left & (apart < near)
        near[closer], parent[closer] = apart[closer], place
        at = int(np.where(left, near, inf).argmin())
    return out


def _tree_of(table: pa.Table) -> pa.Table:
    table = table.sort_by("anchor")
    owns = table["own"].to_pylist()
    order = spanning_tree(_matrix(owns, max(len(own) // 8 for own in owns)))
    sorted_rows = table.take(pa.array([row for row, _, _ in order]))
    return pa.table(
        {
            "stretch": sorted_rows["stretch"],
            "tree": sorted_rows["tree"],
            "label": sorted_rows["label"],
            "place": pa.array(range(len(order)), pa.int32()),
            "parent": pa.array([parent for _, parent, _ in order], pa.int32()),
            "edge": pa.array([edge for _, _, edge in order], pa.float64()),
            "anchor": sorted_rows["anchor"],
            "anchor_id": sorted_rows["id"],
            "own": sorted_rows["own"],
        }
    )


class Window:
    """The ``most`` best of the rows with a score from ``low`` to ``high``."""

    def __init__(self, low: float, high: float, most: int):
        self.low, self.high, self._most = low, high, most
        self._kept: list[tuple] = []

    def add(self, scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        """Take in rows; ``low`` rises to the last score that still counts."""
        inside = np.flatnonzero((scores >= self.low) & (scores <= self.high))
        if not len(inside):
            return
        rows = [(-int(scores[i]), bool(no_id[i]), int(ids[i])) for i in inside[self._first(scores[inside])]]
        self._kept = sorted(self._kept + rows)[: self._most]
        if len(self._kept) == self._most:
            self.low = max(self.low, -self._kept[-1][0])

    def _first(self, scores: np.ndarray) -> np.ndarray:
        """Rows that can be among the best, all with the last score included."""
        if len(scores) <= self._most:
            return np.arange(len(scores))
        last = np.partition(scores, len(scores) - self._most)[len(scores) - self._most]
        return np.flatnonzero(scores >= last)

    def floor(self, low: np.ndarray, high: np.ndarray, spare: int) -> float:
        """A score that rows must reach by their bounds alone: so many rows, and
        ``spare`` ones that may be left out, are in the window and above it."""
        count = self._most + spare
        if len(self._kept) < self._most:
            sure = low[high <= self.high]
            if len(sure) >= count:
                return max(self.low, np.partition(sure, len(sure) - count)[len(sure) - count])
        return self.low

    def best(self) -> list[tuple[int | None, int]]:
        return [(None if no_id else other, -minus) for minus, no_id, other in self._kept]


class Rows:
    """Rows of a block: ids, whole vectors and norms."""

    def __init__(self, ids: pa.Array, owns: list[bytes], width: int):
        self.no_id = ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(0).to_numpy()
        self.owns = np.array(owns, dtype=object)
        self.whole = _matrix(owns, width)
        self.norms = _norms(self.whole)
        self.plain = self.whole.astype(np.float64)

    def part(self, rows: np.ndarray) -> Rows:
        out = object.__new__(Rows)
        for name, value in vars(self).items():
            setattr(out, name, value[rows])
        return out

    def __len__(self) -> int:
        return len(self.ids)

    def scores(self, anchor: np.ndarray, exact: bool, rows=slice(None)) -> np.ndarray:
        """Inner products; ``exact`` says that doubles hold them without loss."""
        if exact:
            return self.plain[rows] @ anchor.astype(np.float64)
        found = self.whole[rows].astype(object) @ anchor.astype(object)
        if any(abs(score) >= 1 << 63 for score in found):
            raise OverflowError("a score has more than 64 bits")
        return found


def search_tree(
    rows: Rows, anchors: np.ndarray, parents: list[int], edges: list[float], windows: list[list[Window]], skip: list
) -> int:
    """Fill the windows of all anchors of a tree from ``rows``. ``skip`` names
    the (id, own) of the row that an anchor leaves out, or None. Returns the
    number of inner products."""
    made = 0
    norms = _norms(anchors)
    for first in range(0, len(rows), _TOGETHER):
        part = rows.part(slice(first, first + _TOGETHER))
        exact = bool(norms.max() * part.norms.max() < _EXACT)
        low = np.empty((len(anchors), len(part)))
        high = np.empty((len(anchors), len(part)))
        for at, anchor in enumerate(anchors):
            if parents[at] < 0 or not exact:
                low[at], high[at] = -inf, inf
            else:
                apart = edges[at] * (1 + 1e-9) * part.norms + 2
                np.subtract(low[parents[at]], apart, out=low[at])
                np.add(high[parents[at]], apart, out=high[at])
            asked = windows[at]
            if not asked:
                continue
            spare = int(skip[at] is not None)
            least = min(window.floor(low[at], high[at], spare) for window in asked)
            most = max(window.high for window in asked)
            wanted = (high[at] >= least) & (low[at] <= most)
            found = np.flatnonzero(wanted)
            if not len(found):
                continue
            made += len(found)
            scores = part.scores(anchor, exact) if 2 * len(found) > len(part) else part.scores(anchor, exact, found)
            scores = scores[found] if len(scores) > len(found) else scores
            if exact:
                low[at, found] = high[at, found] = scores
            if skip[at] is not None:
                own_id, own = skip[at]
                same_id = np.flatnonzero((part.ids[found] == own_id) & ~part.no_id[found])
                me = [row for row in same_id.tolist() if part.owns[found[row]] == own]
                found, scores = np.delete(found, me), np.delete(scores, me)
            for window in asked:
                window.add(scores, part.ids[found], part.no_id[found])
    return made


def _searcher(asked: Callable, same_label: bool) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """A task over a block and a stretch. ``asked`` makes the windows of an
    anchor's row."""

    def search_task(block: pa.Table, stretch: pa.Table) -> pa.Table:
        found = []
        if block.num_rows and stretch.num_rows:
            anchors = stretch.sort_by([("tree", "ascending"), ("label", "ascending"), ("place", "ascending")]).to_pylist()
            owns = block["own"].to_pylist()
            width = max(len(own) // 8 for own in [*owns, *(anchor["own"] for anchor in anchors)])
            rows = Rows(block["id"].combine_chunks(), owns, width)
            labels = np.array(block["label"].to_pylist(), dtype=object)
            parts: dict[str, Rows] = {}
            starts = [at for at, anchor in enumerate(anchors) if anchor["place"] == 0]
            for start, end in zip(starts, [*starts[1:], len(anchors)]):
                tree = anchors[start:end]
                label = tree[0]["label"]
                if label not in parts:
                    parts = {label: rows.part((labels == label) == same_label)}
                windows = [asked(anchor) for anchor in tree]
                skip = [(anchor["anchor_id"], anchor["own"]) if same_label else None for anchor in tree]
                parents, edges = [anchor["parent"] for anchor in tree], [anchor["edge"] for anchor in tree]
                whole = _matrix([anchor["own"] for anchor in tree], width)
                search_tree(parts[label], whole, parents, edges, windows, skip)
                for anchor, own_windows in zip(tree, windows):
                    for slot, window in enumerate(own_windows, 1):
                        found += [(anchor["anchor"], anchor["anchor_id"], slot, *best) for best in window.best()]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        names = [field.split()[0] for field in _FOUND.split(", ")]
        columns = list(zip(*found)) or [()] * len(kinds)
        return pa.table({name: pa.array(column, kind) for name, column, kind in zip(names, columns, kinds)})

    return search_task


def _numbers(count: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long"))


def hard_negatives(
    df: DataFrame,
    is_anchor: Column,
    label: Column,
    positives: int = 5,
    negatives: int = 3,
    low_percent: int = 50,
    high_percent: int = 95,
    scale: float = 256.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Negatives that score close to, but below, the positives of each anchor.

    Components become floor(scale * x), scores are whole inner products; higher
    ones come first, and of equals the smaller id. The positives of an anchor are
    its first ``positives`` other rows of the same label. The negatives of a pair
    are the first ``negatives`` rows of other labels whose score is between
    ``low_percent`` and ``high_percent`` of the positive's, both included.

    Rows with a null label, a null vector or a null or non-finite component take
    no part. Equal rows are one; rows of one id that differ are different rows,
    and a null id comes last among equals (it is no anchor by a condition on
    ids). Shorter vectors go on with zeros, so an empty one scores zero. Scores
    and steps beyond 64 bits stop the job. Other columns are left out; an empty
    table gives no row, as does an anchor without positive or negative.

    Returns (anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score). All rows are scored against all anchors, in blocks, as far
    as bounds do not rule them out.
    """
    spark = df.sparkSession
    vectors = checkpointed(whole_vectors(df, id_col, label, vector_col, scale).distinct())
    blocks = max(-(-vectors.count() // BLOCK_ROWS), 2 * spark.sparkContext.defaultParallelism)
    spread = F.pmod(F.xxhash64("id", "own"), F.lit(blocks))
    chosen = vectors.where(is_anchor.isNotNull() & is_anchor)
    placed = dense_positions(chosen, ["label", "signs", "own", "id"], "anchor")
    trees = checkpointed(
        placed.select(
            F.expr(f"anchor div {STRETCH_ANCHORS}").alias("stretch"),
            F.expr(f"anchor div {TREE_ANCHORS}").alias("tree"),
            "label", "anchor", "id", "own",
        )
        .groupBy("tree", "label")
        .applyInArrow(_tree_of, _TREE)
    )
    stretches = -(-trees.count() // STRETCH_ANCHORS)
    if not stretches:
        return spark.createDataFrame([], _RESULT)
    dealt = vectors.select(
        spread.alias("block"), F.explode(_numbers(stretches)).alias("stretch"), "id", "label", "own"
    ).groupBy("block", "stretch")

    def searched(anchors: DataFrame, asked: Callable, same_label: bool) -> DataFrame:
        copies = anchors.withColumn("block", F.explode(_numbers(blocks)))
        return dealt.cogroup(copies.groupBy("block", "stretch")).applyInArrow(_searcher(asked, same_label), _FOUND)

    def any_score(anchor: dict) -> list[Window]:
        return [Window(-inf, inf, positives)]

    def around_positives(anchor: dict) -> list[Window]:
        bounds = [(-(-low_percent * score // 100), high_percent * score // 100) for score in anchor["scores"]]
        return [Window(low, high, negatives) for low, high in bounds]

    best_first = [F.desc("score"), F.asc_nulls_last("other")]
    near = searched(trees, any_score, True).drop("slot")
    pairs = checkpointed(top_n_per_key(near, ["anchor"], best_first, positives, "slot"))
    listed = pairs.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("slot", "score"))).alias("_scores"))
    asking = trees.join(listed, "anchor", "left").select(
        *trees.columns, F.coalesce(F.col("_scores.score"), F.array().cast("array<long>")).alias("scores")
    )
    far = searched(asking, around_positives, False)
    kept = top_n_per_key(far, ["anchor", "slot"], best_first, negatives)
    negative = kept.select("anchor", "anchor_id", "slot", "rank", F.col("other").alias("negative_id"), F.col("score").alias("negative_score"))
    positive = pairs.select("anchor", "slot", F.col("other").alias("positive_id"), F.col("score").alias("positive_score"))
    return negative.join(positive, ["anchor", "slot"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
