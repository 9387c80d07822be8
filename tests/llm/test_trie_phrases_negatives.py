"""Trie encoding, phrase collocations and hard negatives."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from cases import edge_docs, edge_rows, empty_docs, rows_of
from compare import compare, connect
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tastegrid.llm import bpe_trie, collocations, hard_negatives, queries
from tastegrid.llm.bpe_trie import MergeTable, TrieEncoder, decode_ids, encode_texts
from tastegrid.llm.oracle import ORACLE

PATH = public_tokenizers.path("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(PATH)
SF_DIR = "/root/testdata/sf0.001"


def library_ids(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids


# --- encoding


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("aaeinstZé' .,!?\t\n\x1c\xa0̸́<|>İ日Ω0９ﬁ")), st.text(max_size=40))))
def test_trie_gives_the_ids_and_texts_of_the_library(texts):
    encoder = TrieEncoder.load(PATH)
    ids, counts = encoder.encode(pa.array(texts, pa.string()))
    want = [library_ids(text) for text in texts]
    assert counts.tolist() == [len(own) for own in want]
    assert ids.tolist() == [one for own in want for one in own]
    assert [encoder.decode(own) for own in want] == [WHOLE.decode(own, skip_special_tokens=False) for own in want]


def plain_bpe(symbols, rank):
    parts = list(symbols)
    while True:
        best = min(((rank[pair], at) for at, pair in enumerate(zip(parts, parts[1:])) if pair in rank), default=None)
        if best is None:
            return parts
        at = best[1]
        parts[at : at + 2] = [parts[at] + parts[at + 1]]


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10**9), st.lists(st.text("abc", min_size=1, max_size=12), max_size=30))
def test_random_merges_of_few_symbols(seed, words):
    """Many equal symbols, and tokens that no text is encoded to."""
    rng, tokens, merges = random.Random(seed), ["a", "b", "c"], []
    for _ in range(14):
        left, right = rng.choice(tokens), rng.choice(tokens)
        if left + right not in tokens:
            merges.append((left, right))
            tokens.append(left + right)
    number = {token: at for at, token in enumerate(tokens)}
    table = MergeTable({"a": 0, "b": 1, "c": 2}, [(number[a], number[b], number[a + b]) for a, b in merges])
    rank = {pair: at for at, pair in enumerate(merges)}
    for word, ids in table.encode_words(set(words)):
        assert [tokens[one] for one in np.frombuffer(ids, "<u4")] == plain_bpe(word, rank)


def test_merges_out_of_order_are_refused():
    with pytest.raises(ValueError):
        MergeTable({"a": 0, "b": 1}, [(2, 1, 3), (0, 1, 2)])


def test_shared_prefixes_are_visited_once(monkeypatch):
    table = TrieEncoder.load(PATH)._merges
    seen = []
    ending = table._ending
    monkeypatch.setattr(table, "_ending", type("Seen", (list,), {"__getitem__": lambda self, i: seen.append(i) or ending[i]})())
    words = ["stone", "stones", "stonemason", "store"]
    list(table.encode_words(words))
    assert len(seen) == len({word[:end] for word in words for end in range(1, len(word) + 1)})


def test_encoded_edge_rows(spark):
    got = Counter((r.doc_id, tuple(r.ids), r.decoded) for r in encode_texts(edge_docs(spark), PATH, decoded=True).collect())
    want = [(row[0], library_ids(row[1])) for row in edge_rows()]
    assert got == Counter((i, tuple(ids), WHOLE.decode(ids, skip_special_tokens=False)) for i, ids in want)
    assert encode_texts(empty_docs(spark), PATH).count() == 0


def test_decoding_alone(spark):
    frame = spark.createDataFrame([(1, [320, 49407, None, 10**6]), (2, []), (None, None)], "doc_id long, ids array<int>")
    got = {r.doc_id: r.decoded for r in decode_ids(frame, PATH).collect()}
    assert got == {1: WHOLE.decode([320, 49407], skip_special_tokens=False), 2: "", None: ""}


def test_trie_query(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.trie_encoded(spark, SF_DIR).collect()}
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    for row in docs:
        ids = library_ids(row.text)
        assert got[row.doc_id] == (
            len(ids), sha(" ".join(map(str, ids))), sha(WHOLE.decode(ids, skip_special_tokens=False))
        )
    assert len(got) == len(docs)


def test_words_without_spaces_stay_within_bounds():
    encoder = TrieEncoder(PATH)
    rng = random.Random(1)
    for _ in range(20):
        encoder.encode(pa.array(["".join(rng.choices("日本語文字列", k=3000)) for _ in range(20)]))
    assert encoder._held == 0 and len(encoder._merges._fits) <= bpe_trie._KEPT_PAIRS


# --- phrases


def slow_phrases(rows, least, longest, most):
    import re

    counts, totals, lower = defaultdict(Counter), Counter(), str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for size in range(1, longest + 1):
                counts[lang or "und"].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = set()
    for lang, of in counts.items():
        frequent = {phrase: a for phrase, a in of.items() if a >= least and len(phrase) > 1}
        ranked = []
        for phrase, a in frequent.items():
            if any(
                len(other) > len(phrase) and 100 * b >= 100 * a and any(other[i : i + len(phrase)] == phrase for i in range(len(other)))
                for other, b in frequent.items()
            ):
                continue
            cuts = [(1000 * a * totals[lang] // (of[phrase[:k]] * of[phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            ranked.append((-score, -a, " ".join(phrase).encode(), of[phrase[:k]], of[phrase[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:most], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return out


def phrase_rows():
    rng = random.Random(11)
    vocabulary = ["New", "york", "city", "é", "of", "the", "a", "b", "x́", "日本", "n\xa0y", "İ"]
    hot = "the quick New York city of the a a a a a b"
    rows = [(hot, "en")] * 60
    for at in range(300):
        words = rng.choices(vocabulary, k=rng.randint(0, 40))
        marks = [word + rng.choice(["", "", "", ",", ".", "\n", "\t", "  "]) for word in words]
        rows.append((" ".join(marks), rng.choice(["en", "en", None, "und", "de"])))
    return rows + [(None, "en"), ("", None), (" ,.\n", "de"), ("a " * 5000, "fr"), (None, None)]


@pytest.mark.parametrize("least,most", [(1, 3000), (5, 50), (100, 2000)])
def test_phrases_equal_brute_force(spark, least, most):
    rows = phrase_rows()
    docs = spark.createDataFrame([(t, g, 1, "x", 2) for t, g in rows], "text string, lang string, a long, chunk string, times long")
    got = collocations.collocations(docs.repartition(7), least, 5, most).collect()
    assert {tuple(row) for row in got} == slow_phrases(rows, least, 5, most) and len(got) == len({tuple(row) for row in got})


def test_phrases_of_edge_rows_and_of_nothing(spark):
    rows = [(row[1], row[2]) for row in edge_rows()]
    got = {tuple(row) for row in collocations.collocations(edge_docs(spark), 20).collect()}
    assert got == slow_phrases(rows, 20, 5, 2000)
    assert collocations.collocations(empty_docs(spark)).count() == 0


def test_chunks_fold_passages_and_hold_each_phrase_once(spark):
    rng = random.Random(2)
    passage = " ".join("".join(rng.choices("abcdefgh", k=4)) for _ in range(400))
    texts = [" ".join(rng.choices(["p", "q", "r"], k=9)) + " " + passage for _ in range(50)]
    docs = spark.createDataFrame([(text, "en") for text in texts], "text string, lang string")
    parsed = collocations.parse(docs).collect()
    assert sum(row.own * row.times for row in parsed) == 50 * 409
    assert sum(row.own for row in parsed) < 50 * 409 / 5
    assert any(row.times == 50 and len(row.chunk.split()) == row.own + 4 for row in parsed)


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    """With few bits the filter lets rare phrases pass; they are counted as such."""
    docs = spark.createDataFrame(phrase_rows(), "text string, lang string")
    monkeypatch.setattr(collocations, "_LEAST_BITS", 32768)
    monkeypatch.setattr(collocations, "_MOST_BITS", 32768)
    real = collocations._may_be_frequent
    monkeypatch.setattr(collocations, "_CHUNK_WORDS", 3)
    assert {tuple(row) for row in collocations.collocations(docs, 20).collect()} == slow_phrases(phrase_rows(), 20, 5, 2000)
    assert real(np.array([2], dtype=np.uint8), np.array([1, 9, 2], dtype=np.uint64)).tolist() == [True, True, False]


def test_no_step_makes_more_rows_than_there_are_words(spark, monkeypatch):
    """Where all pairs are frequent, a place gives one window, not a row for each
    length that a phrase may have."""
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(20)]
    rows = [(" ".join(rng.choices(vocabulary, k=100)), "en") for _ in range(200)]
    made, real = defaultdict(lambda: spark.sparkContext.accumulator(0)), type(spark.range(1)).mapInArrow

    def counting(df, task, schema):
        total = made[schema]

        def counted(batches):
            for batch in task(batches):
                total.add(batch.num_rows)
                yield batch

        return real(df, counted, schema)

    monkeypatch.setattr(type(spark.range(1)), "mapInArrow", counting)
    docs = spark.createDataFrame(rows, "text string, lang string")
    assert {tuple(row) for row in collocations.collocations(docs, 5).collect()} == slow_phrases(rows, 5, 5, 2000)
    assert all(0 < total.value <= 20000 for total in made.values()) and len(made) >= 3


@pytest.mark.parametrize("parts", [1, 40])
def test_phrases_over_range_ends_and_of_least_characters(spark, parts):
    """Windows of a phrase may be dealt over tasks and batches; words may hold
    characters that come before a space."""
    rng = random.Random(7)
    vocabulary = ["a", "a\0", "a\0\1", "a\1", "\1\0", "\1\1", "\1\2", "a\2", "b", "b!", "a'", "\0"]
    rows = [(" ".join(rng.choices(vocabulary[: rng.randint(2, 12)], k=rng.randint(0, 30))), rng.choice(["x", "x\0a", "x\1", None])) for _ in range(400)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        docs = spark.createDataFrame(rows, "text string, lang string")
        got = collocations.collocations(docs, 8, 5, 3000).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {tuple(row) for row in got} == slow_phrases(rows, 8, 5, 3000)


@pytest.mark.parametrize("each", [1, 3, 1000])
def test_beginnings_are_counted_over_batches_and_tasks(monkeypatch, each):
    rng = random.Random(3)
    windows = Counter("\0".join(["en", *rng.choices(["a", "ab", "b", "c"], k=rng.randint(1, 5))]) for _ in range(600))
    keys = sorted(windows, key=str.encode)
    monkeypatch.setattr(collocations, "_FOLDED_BYTES", 1)
    expected, got = Counter(), Counter()
    for key, times in windows.items():
        words = key.split("\0")[1:]
        expected.update({" ".join(words[:size]): times for size in range(1, len(words) + 1)})
    tasks = [keys[:100], [], keys[100:101], keys[101:]]
    for task in tasks:
        runs = [task[at : at + each] for at in range(0, len(task), each)]
        batches = (pa.RecordBatch.from_arrays([pa.array(run, pa.string()), pa.array([windows[key] for key in run])], names=["key", "times"]) for run in runs)
        given = Counter()
        for batch in collocations._prefix_counts(batches, 4, 5):
            for row in batch.to_pylist():
                assert row["lang"] == "en" and row["words"] == len(row["phrase"].split())
                given[row["phrase"]] += 1
                got[row["phrase"]] += row["times"]
        assert all(count == 1 for count in given.values())
    assert {x: a for x, a in got.items() if a >= 4} == {x: a for x, a in expected.items() if a >= 4}
    assert sum(a < 4 for a in got.values()) <= 2 * 5 * len(tasks)


def test_products_beyond_64_bits_are_exact(spark):
    big = 3 * 10**12
    n = 10**15 + 9
    counts = [("en", 1, "x", big, n), ("en", 1, "y", big + 1, n), ("en", 2, "x y", big - 7, n)]
    frame = spark.createDataFrame(counts, "lang string, words int, phrase string, times long, n long")
    row = collocations.scored_phrases(frame).first()
    assert (row.n, row.score) == (n, 1000 * (big - 7) * n // (big * (big + 1)))


@pytest.mark.parametrize("name", ["op12_phrase_collocations", "op13_hard_negatives"])
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_against_sql(spark, name, sf):
    compare(queries.QUERIES[name](spark, f"/root/testdata/{sf}"), connect(f"/root/testdata/{sf}"), ORACLE[name])


# --- negatives


def slow_negatives(rows, positives=5, negatives=3, low=50, high=95, scale=256):
    kept = set()
    for vec, label, values in rows:
        if label is None or values is None or any(v is None or not np.isfinite(v) for v in values):
            continue
        kept.add((vec, label, tuple(int(np.floor(scale * float(v))) for v in values)))
    out = Counter()
    order = lambda found: sorted(found, key=lambda f: (-f[0], f[1] is None, f[1] or 0))
    for anchor in kept:
        if anchor[0] is None or anchor[0] % 50:
            continue
        scored = [(sum(a * b for a, b in zip(anchor[2], row[2])), row[0], row[1]) for row in kept if row != anchor]
        for score, positive, _ in order([f for f in scored if f[2] == anchor[1]])[:positives]:
            fitting = [f for f in scored if f[2] != anchor[1] and low * score <= 100 * f[0] <= high * score]
            for rank, found in enumerate(order(fitting)[:negatives], 1):
                out[anchor[0], positive, rank, found[1], score, found[0]] += 1
    return out


def vector_rows(count, seed=4, labels=4, large=1.0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(labels)]
    rows = []
    for vec in range(count):
        label = rng.randrange(labels)
        rows.append((vec, label, [large * (c + rng.gauss(0, 0.4)) / 3 for c in centres[label]]))
    nan, inf = float("nan"), float("inf")
    return rows + [
        (50, 1, [0.5] * 6), (50, 1, [0.5] * 6), (None, 2, [0.4] * 6), (None, None, [0.4] * 6), (100, None, [1.0] * 6),
        (150, 1, None), (200, 1, [nan] * 6), (250, 2, [0.1, None] + [0.0] * 4), (300, 2, [inf] + [0.0] * 5),
        (350, 3, []), (400, 3, [0.2, 0.1]), (7, 3, [0.3] * 6), (8, 3, [0.3] * 6), (9, 3, [0.3] * 6), (450, 0, [0.0] * 6),
    ]


VECTORS = "vec_id long, label int, embedding array<double>, id string, own long, anchor int"


def mined(spark, rows, **options):
    frame = spark.createDataFrame([(*row, "x", 1, 2) for row in rows], VECTORS)
    found = hard_negatives.hard_negatives(frame, F.col("id") % 50 == 0, F.col("label"), **options)
    return Counter(tuple(row) for row in found.collect())


@pytest.mark.parametrize("small", [False, True])
def test_negatives_equal_brute_force(spark, small, monkeypatch):
    """``small``: many blocks, stretches and trees, and few rows at once."""
    if small:
        monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 50)
        monkeypatch.setattr(hard_negatives, "STRETCH_ANCHORS", 6)
        monkeypatch.setattr(hard_negatives, "TREE_ANCHORS", 3)
        monkeypatch.setattr(hard_negatives, "_TOGETHER", 16)
    rows = vector_rows(700)
    want = slow_negatives(rows)
    assert want and mined(spark, rows) == want
    assert mined(spark, rows, positives=2, negatives=7, low_percent=10, high_percent=99) == slow_negatives(rows, 2, 7, 10, 99)


def test_scores_beyond_doubles_are_exact(spark):
    rows = vector_rows(200, large=1e6)
    want = slow_negatives(rows)
    assert max(key[4] for key in want) > 2**53 and mined(spark, rows) == want
    with pytest.raises(Exception, match="64 bits"):
        mined(spark, vector_rows(200, large=1e10))


def test_negatives_of_copies_and_of_nothing(spark):
    rows = [(at, at % 2, [0.5, 0.5]) for at in range(600)]
    want = slow_negatives(rows)
    assert mined(spark, rows) == want
    assert not mined(spark, []) and not mined(spark, [(1, 1, [0.5])]) and not mined(spark, [(50, 1, [0.5])])


def test_bounds_rule_out_rows_of_near_anchors():
    """A tree of near anchors needs fewer products than anchors times rows."""
    rng = np.random.default_rng(0)
    centre = rng.normal(size=16)
    anchors = np.floor(256 * (centre + 0.01 * rng.normal(size=(40, 16)))).astype(np.int64)
    owns = [row.astype("<i8").tobytes() for row in np.floor(256 * rng.normal(size=(3000, 16)))]
    rows = hard_negatives.Rows(pa.array(range(3000)), owns, 16)
    order = hard_negatives.spanning_tree(anchors)
    tree = anchors[[row for row, _, _ in order]]
    windows = [[hard_negatives.Window(-np.inf, np.inf, 5)] for _ in order]
    parents, edges = [parent for _, parent, _ in order], [edge for _, _, edge in order]
    made = hard_negatives.search_tree(rows, tree, parents, edges, windows, [None] * 40)
    assert made < 0.8 * 40 * 3000
    scores = tree @ rows.whole.T
    for at, (window,) in enumerate(windows):
        want = sorted(range(3000), key=lambda row: (-scores[at, row], row))[:5]
        assert window.best() == [(row, int(scores[at, row])) for row in want]


def test_edge_frames_give_rows(spark):
    assert rows_of(encode_texts(empty_docs(spark), PATH)) == []
