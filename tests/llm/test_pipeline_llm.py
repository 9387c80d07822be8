"""Stages of the pipeline on rows that share ids, and against brute force."""

import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from cases import words
from pyspark.sql import functions as F
from test_duplicates_llm import slow_components, slow_fingerprint, slow_overlaps, slow_repeats
from tokenizers import Tokenizer

import corpus_pipeline
from tastegrid.llm.decontamination import contaminated, decontaminated
from tastegrid.llm.language import fit_language_model, training_sample
from tastegrid.llm.simhash import one_of_each_group
from tastegrid.llm.token_files import read_token_files, write_token_files

PATH = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)


def test_rows_that_share_an_id_are_judged_apart(spark):
    rng = random.Random(3)
    item = words(rng, 20)
    leak = f"{words(rng, 9)} {item} {words(rng, 9)}"
    clean = [words(rng, 30) for _ in range(4)]
    rows = [(None, leak), (None, clean[0]), (None, clean[1]), (8, leak + " end"), (8, clean[2]), (7, clean[3]), (7, clean[3]), (9, None)]
    tests = spark.createDataFrame([(1, item)], "item_id long, text string")
    left = decontaminated(docs_of(spark, rows).repartition(3), tests).collect()
    assert Counter((r.doc_id, r.text) for r in left) == Counter(rows[1:3] + rows[4:])
    found = {(r.doc_id, r.item_id) for r in contaminated(docs_of(spark, rows), tests).collect()}
    assert found == {(None, 1), (8, 1)}
    assert decontaminated(docs_of(spark, rows), tests, most_broadcast=0).count() == 6


def test_exactly_one_row_of_each_group_stays(spark):
    rng = random.Random(4)
    text, other, third = words(rng, 60), words(rng, 60), words(rng, 60)
    rows = [(None, text), (3, text), (None, text), (5, text), (5, text), (None, other), (6, third), (6, third), (7, words(rng, 60))]
    left = one_of_each_group(docs_of(spark, rows).repartition(4)).collect()
    assert Counter((r.doc_id, r.text) for r in left) == Counter([(3, text), (None, other), (6, third), rows[-1]])
    assert one_of_each_group(docs_of(spark, [])).count() == 0
    blank = [(None, None), (2, ""), (1, None), (4, " ")]
    assert [(r.doc_id, r.text) for r in one_of_each_group(docs_of(spark, blank)).collect()] == [(1, None)]


def slow_pipeline(rows, items):
    """(id, ids of the text with the end id) of what each stage keeps, done plainly."""
    kept = [(i, t) for i, t in rows if t and any(map(str.isalpha, t))]
    prints = [slow_fingerprint(text) for _, text in kept]
    group = slow_components(set(prints), lambda a, b: bin(a ^ b).count("1") <= 3)
    first = {}
    for (name, text), value in zip(kept, prints):
        first.setdefault(group[value], []).append((name is None, name or 0, name, text))
    kept = [min(of)[2:] for of in first.values()]
    cut = [(name, out.decode("utf-8", "ignore")) for name, _, removed, _, out in slow_repeats(kept) if out or not removed]
    leaks = {at for at, _, *_ in slow_overlaps(list(enumerate(text for _, text in cut)), items)}
    encode = Tokenizer.from_file(PATH).encode
    return Counter((name, len(encode(text, add_special_tokens=False).ids) + 1) for at, (name, text) in enumerate(cut) if at not in leaks)


def test_pipeline_equals_a_chain_of_brute_force_stages(spark, tmp_path):
    rng = random.Random(9)
    item = words(rng, 20)
    base = [words(rng, 70) for _ in range(25)]
    rows = list(enumerate(base)) + [(100 + at, base[at]) for at in range(6)] + [(None, base[at]) for at in range(4, 9)]
    rows += [(None, words(rng, 50)), (None, words(rng, 50)), (50, words(rng, 40)), (50, words(rng, 40)), (50, base[20]), (50, base[20])]
    rows += [(60, f"{words(rng, 40)} {base[1][:260]}"), (61, f"{base[2][40:300]} {words(rng, 50)}"), (62, None), (63, "12 !!"), (None, "")]
    rows += [(70, f"{words(rng, 30)} {item} {words(rng, 30)}"), (None, f"{words(rng, 30)} {item} {words(rng, 20)}"), (None, words(rng, 45))]
    docs_of(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    got = defaultdict(int)
    for piece in pieces:
        got[piece.doc_id, piece.doc_tokens] += piece.length
    want = slow_pipeline(rows, [(1, item)])
    assert got == {key: key[1] * times for key, times in want.items()}
    fill = Counter()
    for piece in pieces:
        fill[piece.sequence_id] += piece.length
    assert max(fill.values()) <= 2048


def test_one_id_is_spread_over_files_and_read_in_parallel(spark, tmp_path):
    rng = random.Random(6)
    rows = [(7, words(rng, 40)) for _ in range(600)] + [(7, "same text")] * 300 + [(at, words(rng, 40)) for at in range(900)]
    # Else Spark makes one file of so few bytes.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        index = write_token_files(docs_of(spark, rows).repartition(6), str(tmp_path / "files"), PATH)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    hot = index.where("first_doc <= 7 AND last_doc >= 7").select("path").distinct().count()
    assert hot > 2 and index.first()["path"].startswith("file:")
    read = read_token_files(index)
    found = read.withColumn("task", F.spark_partition_id()).orderBy("start").collect()
    assert len({row.task for row in found}) > 3
    assert [row.doc_id for row in found] == sorted(i for i, _ in rows)
    assert [row.start for row in found] == [sum(r.n_tokens for r in found[:at]) for at in range(len(found))]


def test_sample_is_bounded_in_rows_and_bytes(spark):
    rng = random.Random(8)
    rows = [(None if at % 3 == 0 else at, words(rng, 20)) for at in range(900)]
    docs = docs_of(spark, rows).repartition(5)
    texts, labels = training_sample(docs, each=40)
    assert len(texts) == 40 and set(labels) == {"en"}
    ranked = docs.select("text", F.xxhash64("doc_id", "text").alias("h")).distinct().orderBy("h").limit(40).collect()
    assert texts == [row.text for row in ranked]
    few, _ = training_sample(docs, each=40, most_bytes=500)
    assert few == texts[: len(few)] and 0 < sum(map(len, few)) <= 500
    assert len(training_sample(docs, each=40, most_bytes=1)[0]) == 1


@pytest.mark.parametrize("letters", [300, 3000])
def test_every_letter_of_the_sample_counts(letters):
    """Languages of large scripts that differ in rare letters only."""
    rng = random.Random(1)
    one = [chr(0x4E00 + at) for at in range(letters)]
    two = [chr(0x4E00 + letters + at) for at in range(letters)]
    texts = ["".join(rng.choices(script, k=60)) for script in (one, two) for _ in range(40)]
    model = fit_language_model(texts, ["a"] * 40 + ["b"] * 40)
    fresh = ["".join(rng.choices(script, k=60)) for script in (one, two) for _ in range(20)]
    assert model.predict(fresh)[0] == ["a"] * 20 + ["b"] * 20


def test_prediction_equals_dense_kernel_ridge():
    """With every text a landmark the fit is kernel ridge regression itself."""
    import numpy as np

    rng = random.Random(2)
    texts = [words(rng, 12, letters) for letters in ("abcde", "defgh") for _ in range(15)]
    names = ["x"] * 15 + ["y"] * 15
    model = fit_language_model(texts, names, landmarks_each=15, ridge=1e-2)
    fresh = [words(rng, 12, letters) for letters in ("abcde", "defgh", "abgh") for _ in range(5)]

    def grams(text):
        line = "_" + "_".join(text.split()) + "_"
        return {line[at : at + n] for n in (1, 2, 3) for at in range(len(line) - n + 1)}

    def kernel(a, b):
        return np.array([[len(x & y) / np.sqrt(len(x) * len(y)) for y in b] for x in a])

    own, new = [grams(t) for t in texts], [grams(t) for t in fresh]
    among = kernel(own, own)
    truth = np.array([[1.0 if name == label else -1.0 for label in ("x", "y")] for name in names])
    weight = np.full(30, 1 / 15)
    # (K W K + r K) a = K W t has the solution of (W K + r) a = W t.
    dual = np.linalg.solve(weight[:, None] * among + 1e-2 * np.eye(30), weight[:, None] * truth)
    margins = kernel(new, own) @ dual
    found, scores = model.predict(fresh)
    assert found == [("x", "y")[at] for at in margins.argmax(axis=1)]
    assert np.allclose(scores, np.clip((margins.max(axis=1) + 1) / 2, 0, 1), atol=1e-4)
