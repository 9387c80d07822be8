"""Suffix dedup, SimHash and decontamination against brute force."""

import hashlib
import random
import re
import zlib
from itertools import combinations, product

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from cases import edge_docs, edge_rows, empty_docs, rows_of, words

from tastegrid.llm import simhash, suffix_dedup
from tastegrid.llm.decontamination import EQUAL, MASKS, SHORT_MASKS, WINDOW, contaminated, decontaminated
from tastegrid.llm.simhash import near_duplicates, similar_fingerprints
from tastegrid.llm.suffix_dedup import LENGTH, remove_repeats


def slow_repeats(rows):
    """(id, bytes, removed, spans, kept) with every string looked up."""
    seen, out = {}, []
    ordered = sorted({(name is not None, name or 0, text or "") for name, text in rows})
    for known, name, text in ordered:
        raw = text.encode()
        covered = bytearray(len(raw))
        for start in range(len(raw) - LENGTH + 1):
            key = hashlib.md5(raw[start : start + LENGTH]).digest()
            if seen.setdefault(key, (known, name, start)) != (known, name, start):
                covered[start : start + LENGTH] = b"\1" * LENGTH
        kept = bytes(byte for byte, gone in zip(raw, covered) if not gone)
        out.append((name if known else None, len(raw), sum(covered), len(re.findall(b"\1+", bytes(covered))), kept))
    return out


def repeats_of(docs):
    return [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in remove_repeats(docs).collect()]


def passages(rng, count):
    """Texts that share passages, whole and cut, with small changes and periods."""
    shared = [words(rng, rng.randint(15, 60)) for _ in range(6)]
    rows = []
    for name in range(count):
        parts = []
        for _ in range(rng.randint(1, 4)):
            passage = rng.choice(shared)
            cut = rng.randint(0, 60)
            parts += [words(rng, rng.randint(0, 30)), passage[cut : len(passage) - rng.randint(0, 60)]]
            if rng.random() < 0.3:
                parts.append(passage.replace("a", "b", 1))
            if rng.random() < 0.1:
                parts.append("ab " * rng.randint(20, 90))
        rows.append((name, "".join(parts)))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_repeats_equal_brute_force(spark, seed):
    rows = passages(random.Random(seed), 60)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(repeats_of(docs)) == sorted(slow_repeats(rows))


def test_repeats_by_shuffle_and_with_crowded_grams(spark, monkeypatch):
    rng = random.Random(9)
    middle = words(rng, 8)[:40]
    rows = [(at, words(rng, 12) + middle + words(rng, 12)) for at in range(40)]
    rows += [(100 + at, rows[at][1][: 70 + at] + words(rng, 9)) for at in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = sorted(slow_repeats(rows))
    for together in (8, 1):
        monkeypatch.setattr(suffix_dedup, "_TOGETHER", together)
        assert sorted(repeats_of(docs)) == want
    spans = suffix_dedup.repeated_spans(docs.selectExpr("doc_id AS _id", "text AS _text"), most_broadcast=0)
    assert spans.select("id").distinct().count() == sum(removed > 0 for _, _, removed, _, _ in want)


def test_repeats_on_edge_rows(spark):
    rows = [(name, text) for name, text, *_ in edge_rows()]
    got = repeats_of(edge_docs(spark).repartition(3))
    want = slow_repeats(rows)
    assert sorted(set(got), key=repr) == sorted(want, key=repr) and len(got) == len(rows)
    assert repeats_of(empty_docs(spark)) == []
    carried = remove_repeats(edge_docs(spark), as_text=True, carried=("lang", "_id", "seed")).collect()
    assert {(r._id, r.seed) for r in carried} == {(7, "x")}


def test_passage_in_thousands_of_documents(spark):
    rng = random.Random(12)
    passage = words(rng, 50)[:200]
    rows = [(at, words(rng, 18)[:60] + passage + words(rng, 18)[:60]) for at in range(1500)]
    docs = spark.createDataFrame(rows + rows[:3], "doc_id long, text string").repartition(3)
    got = repeats_of(docs)
    assert sorted(set(got)) == sorted(slow_repeats(rows)) and len(got) == len(rows) + 3


@pytest.mark.parametrize("unlike", [1, 12_000])
def test_crowded_cell_is_sorted_in_bounded_memory(monkeypatch, unlike):
    rng = random.Random(13)
    shared, sorted_bytes = bytes(rng.choices(range(97, 110), k=97)), []
    monkeypatch.setattr(suffix_dedup, "_SORTED_BYTES", 1 << 17)
    plain = suffix_dedup.repeated_windows
    monkeypatch.setattr(
        suffix_dedup, "repeated_windows", lambda raw, *rest: (sorted_bytes.append(len(raw)), plain(raw, *rest))[1]
    )
    texts = [shared + f"{at % unlike:018d}".encode() for at in range(12_000)]
    cells = [(5, at, 0, suffix_dedup._packed(0, 0, 20, 16), text) for at, text in enumerate(texts)]
    # The cells around it are sorted as ever.
    cells += [(cell, 20_000 + at, 0, suffix_dedup._packed(0, 0, 20, 1), shared[:90] + b"z" * 10) for cell in (4, 6) for at in (cell, 9)]
    cells.sort(key=lambda row: (row[0], row[4], row[1]))
    kinds = pa.schema([("cell", pa.int64()), ("id", pa.int64()), ("text", pa.int64()), ("place", pa.int64()), ("piece", pa.binary())])
    table = pa.Table.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*cells), kinds.types)], schema=kinds)
    found = pa.Table.from_batches(suffix_dedup._sort_task(iter(table.to_batches(500)))).sort_by(
        [(name, "ascending") for name in ("gram", "body", "id", "place")]
    )
    done = pa.Table.from_batches(suffix_dedup._resolve_task(iter(found.to_batches(700)))).to_pylist()
    covered = {}
    for row in done:
        assert row["variant"] == -1
        start = row["place"] >> 14
        covered.setdefault(row["id"], set()).update(range(start, row["end"]))
    seen, want = set(), {20_009: set(range(100))}
    for at, text in enumerate(texts):
        for start in range(16):
            if text[start : start + LENGTH] in seen:
                want.setdefault(at, set()).update(range(start, start + LENGTH))
            seen.add(text[start : start + LENGTH])
    assert covered == want
    assert max(sorted_bytes, default=0) <= 2 * suffix_dedup._SORTED_BYTES


def test_one_id_with_two_texts(spark):
    rng = random.Random(3)
    one, two = words(rng, 60), words(rng, 60)
    got = repeats_of(spark.createDataFrame([(1, one), (1, two), (2, one + two)], "doc_id long, text string"))
    assert sorted(removed for _, _, removed, _, _ in got)[:2] == [0, 0]
    assert max(removed for _, _, removed, _, _ in got) >= len(one + two) - LENGTH


def test_many_texts_under_one_id(spark):
    rng = random.Random(15)

    def alike(text, start):
        """A text that begins with ``start`` and agrees with ``text`` in the lower bits of the checksum."""
        while zlib.crc32((other := start + words(rng, 40)).encode()) & 0xFFFF != zlib.crc32(text.encode()) & 0xFFFF:
            pass
        return other

    twice = words(rng, 40)
    again = words(rng, 10) + twice + words(rng, 10) + twice
    clean = alike(again, words(rng, 80))
    start = words(rng, 60)
    one = start + words(rng, 30)
    two = alike(one, start)
    for name in (None, 7):
        got = repeats_of(spark.createDataFrame([(name, text) for text in (again, clean, one, two)], "doc_id long, text string"))
        removed = {n_bytes: n_removed for _, n_bytes, n_removed, *_ in got}
        assert removed[len(again)] >= len(twice) - 2 and removed[len(clean)] == 0
        assert sorted([removed[len(one)] > 0, removed[len(two)] > 0]) == [False, True]
        assert removed[len(one)] + removed[len(two)] >= len(start)


def test_anchors_depend_on_the_window_alone():
    rng = np.random.default_rng(4)
    passage = rng.integers(97, 110, 400, dtype=np.uint8)
    found = []
    for before in (0, 37, 250):
        raw = np.concatenate([rng.integers(97, 110, before, dtype=np.uint8), passage])
        first, last, anchor, *_ = suffix_dedup.contexts(raw, np.array([len(raw)]))
        found.append({s - before: a - before for f, l, a in zip(first, last, anchor) for s in range(f, l + 1) if s >= before})
    assert found[0] == found[1] == found[2] and len(found[0]) == 301


# SimHash -------------------------------------------------------------------


def slow_fingerprint(text, size=3):
    parts = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not parts:
        return 0
    shingles = [b" ".join(parts[k : k + size]) for k in range(max(1, len(parts) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(shingle, 42) for shingle in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def slow_components(nodes, linked):
    label = {node: node for node in nodes}

    def root(node):
        while label[node] != node:
            node = label[node]
        return node

    for a, b in combinations(nodes, 2):
        if linked(a, b):
            a, b = root(a), root(b)
            label[max(a, b)] = min(a, b)
    return {node: root(node) for node in nodes}


def test_fingerprints_equal_sparks_hash(spark):
    row = spark.sql("SELECT xxhash64('a b c') AS h").first()
    assert simhash.fingerprint("A b C") == row.h & (1 << 64) - 1 == slow_fingerprint("a b c")


def test_near_duplicates_on_edge_rows(spark):
    rows = [(name, text) for name, text, *_ in edge_rows()]
    got = near_duplicates(edge_docs(spark).repartition(3)).collect()
    assert len(got) == len(rows)
    prints = {name: slow_fingerprint(text) for name, text in rows}
    assert all(r.fingerprint == f"{prints[r.doc_id]:016x}" for r in got)
    group = slow_components(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for name, value in prints.items():
        if name is not None:
            least[group[value]] = min(name, least.get(group[value], name))
    assert all(r.component_id == least.get(group[prints[r.doc_id]]) for r in got)
    assert near_duplicates(empty_docs(spark)).collect() == []


@pytest.mark.parametrize("together", [1024, 16])
def test_links_join_what_chains_of_near_fingerprints_join(spark, monkeypatch, together):
    monkeypatch.setattr(simhash, "_TOGETHER", together)
    rng = random.Random(6)
    values = set()
    for _ in range(25):
        value = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 30])):
            values.add(value)
            for bit in rng.sample(range(64), rng.choice([1, 2, 3, 4])):
                value ^= 1 << bit
    values = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    links = [(r.a, r.b) for r in similar_fingerprints(df).collect()]
    near = {frozenset(pair) for pair in links}
    want = slow_components(values, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 3)
    got = slow_components(values, lambda a, b: frozenset((a, b)) in near)
    assert got == want
    components = {r.node: r.component for r in simhash.connected_components(similar_fingerprints(df)).collect()}
    assert components == {v: want[v] for v in values if sum(want[v] == want[o] for o in values) > 1}


def test_pivot_coordinates_bound_the_distance():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 1 << 64, 200, dtype=np.uint64)
    b = a ^ (np.uint64(1) << rng.integers(0, 64, 200, dtype=np.uint64))
    table = simhash.distance_table(np.concatenate([a, b]))
    apart = np.abs(table[:200].sum(axis=1) - table[200:].sum(axis=1))
    assert apart.max() <= 1


# Decontamination -------------------------------------------------------------


def test_masks_hit_every_window_with_three_changes():
    span = max(mask[-1] for mask in MASKS) + 1
    for changed in combinations(range(WINDOW), WINDOW - EQUAL):
        assert any(
            not any(start + place in changed for place in mask)
            for mask in MASKS
            for start in range(WINDOW - span + 1)
        )


@pytest.mark.parametrize("words_in_item", range(1, WINDOW))
def test_masks_hit_every_short_item_with_a_fifth_changed(words_in_item):
    masks = [*MASKS, *SHORT_MASKS.get(words_in_item, ())]
    for changed in combinations(range(words_in_item), words_in_item // 5):
        assert any(
            not any(start + place in changed for place in mask)
            for mask in masks
            for start in range(words_in_item - mask[-1])
        )


def tokens(text):
    return [word for word in re.split(r"[\W_]+", (text or "").lower()) if word]


def slow_overlaps(docs, items):
    """Every shift compared word by word; only items of 16 words or more."""
    out = {}
    for name, text in docs:
        own = tokens(text)
        for item, passage in items:
            test = tokens(passage)
            for shift in range(-len(test), len(own)):
                same = [0 <= k + shift < len(own) and own[k + shift] == word for k, word in enumerate(test)]
                best = max((sum(same[k : k + WINDOW]) for k in range(len(test) - WINDOW + 1)), default=0)
                if best >= EQUAL:
                    before = out.get((name, item), (len(test), 0, 0))
                    out[name, item] = (len(test), max(before[1], best), max(before[2], sum(same)))
    return sorted((*key, *value) for key, value in out.items())


@pytest.mark.parametrize("most_broadcast", [1_000_000, 0])
def test_overlaps_equal_brute_force(spark, most_broadcast):
    rng = random.Random(8)
    items = [(at, words(rng, rng.randint(16, 40))) for at in range(12)]
    docs = []
    for name in range(60):
        test = tokens(rng.choice(items)[1])
        for _ in range(rng.randint(0, 6)):
            test[rng.randrange(len(test))] = "new"
        cut = rng.randint(0, 10)
        docs.append((name, f"{words(rng, 20)}, {' '.join(test[cut:]).upper()}! {words(rng, 20)}"))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    tests = spark.createDataFrame(items, "item_id long, text string")
    found = sorted(tuple(r) for r in contaminated(df, tests, most_broadcast=most_broadcast).collect())
    assert found == slow_overlaps(docs, items) and len(found) > 10
    clean = {r.doc_id for r in decontaminated(df, tests).collect()}
    assert clean == {name for name, _ in docs} - {row[0] for row in found}


def slow_short_overlaps(docs, items):
    """Every shift compared word by word; items of fewer than 16 words."""
    out = {}
    for (name, text), (item, passage) in product(docs, items):
        own, test = tokens(text), tokens(passage)
        if test:
            shifts = range(1 - len(test), len(own))
            best = max((sum(0 <= k + at < len(own) and own[k + at] == word for k, word in enumerate(test)) for at in shifts), default=0)
            if best >= len(test) - len(test) // 5:
                out[name, item] = (len(test), best, best)
    return sorted((*key, *value) for key, value in out.items())


@pytest.mark.parametrize("most_broadcast", [1_000_000, 0])
def test_short_items_equal_brute_force(spark, most_broadcast):
    rng = random.Random(14)
    items = [(size, words(rng, size, "abcdefghijkl")) for size in range(WINDOW)]
    docs = []
    for size, text in items[1:]:
        for changed in combinations(range(size), size // 5) if size // 5 < 3 else [(3, 7, 11), (2, 7, 12), (3, 6, 9), (4, 7, 10), *rng.sample(list(combinations(range(15), 3)), 40)]:
            test = ["new" if at in changed else word for at, word in enumerate(tokens(text))]
            # At the edges of a document, too, where changed words may be missing.
            docs += [(len(docs), f"{words(rng, 3)}, {' '.join(test)}! {words(rng, 9)}"), (len(docs) + 1, " ".join(test[1:]))]
        docs.append((len(docs), " ".join(["new", *tokens(text)[: size - size // 5 - 1], "new"])))
    docs.append((len(docs), " and ".join([items[1][1]] * 500)))
    assert len({name for name, _ in docs}) == len(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    tests = spark.createDataFrame(items, "item_id long, text string")
    found = sorted(tuple(r) for r in contaminated(df, tests, most_broadcast=most_broadcast).collect())
    assert found == slow_short_overlaps(docs, items)
    assert {row[1] for row in found} == set(range(1, WINDOW))


def test_decontamination_on_edge_rows(spark):
    text = edge_rows()[9][1]
    tests = spark.createDataFrame([(1, text, 5), (None, text, 5), (2, None, 5), (3, "", 5), (4, "too short", 5)], "item_id long, text string, doc_id long")
    found = contaminated(edge_docs(spark), tests).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(None, 1), (None, None)}
    left = decontaminated(edge_docs(spark), tests)
    assert left.columns == edge_docs(spark).columns and left.count() == len(edge_rows()) - 1
    assert contaminated(empty_docs(spark), tests).collect() == []
    assert rows_of(decontaminated(edge_docs(spark), tests.limit(0))) == rows_of(edge_docs(spark))
