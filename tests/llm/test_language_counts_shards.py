"""Language ID, token counts, sharding and the pipeline."""

import os
import random
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from cases import edge_docs, edge_rows, empty_docs, words
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer, models, pre_tokenizers

from tastegrid.llm import queries
from tastegrid.llm.language import Alphabet, fit_language_model, held_out, identify, training_sample, with_language
from tastegrid.llm.sharding import interleaved_shards
from tastegrid.llm.token_counts import UnigramCounter, count_tokens

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def test_grams_against_sets():
    alphabet = Alphabet("abcé")
    names = {letter: at for at, letter in enumerate("abcé", 2)}
    for text in ("Abc, éé ab", "a", " zz  b1b ", "ab" * 40):
        line = [1]
        for letter in text:
            symbol = names.get(letter.lower(), 0) if letter.isalpha() else 1
            if symbol != 1 or line[-1] != 1:
                line.append(symbol)
        line += [1] * (line[-1] != 1)
        want = {tuple(line[k : k + n]) for n in (1, 2, 3) for k in range(len(line) - n + 1)}
        assert len(alphabet.distinct_grams(text)) == len(want)
    assert len(alphabet.distinct_grams("123 \n")) == 0


def test_kernel_counts_shared_grams():
    model = fit_language_model(["abc abd", "xyz xyw"], ["p", "q"])
    kernel, counts = model.kernel(["abc abd", "xyz", ""])
    assert np.allclose(kernel[0, 0], 1) and counts[2] == 0
    own = [set(model.alphabet.distinct_grams(text).tolist()) for text in ("xyz", "xyz xyw")]
    assert np.isclose(kernel[1, 1], len(own[0] & own[1]) / np.sqrt(len(own[0]) * len(own[1])))


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = fit_language_model(*training_sample(docs.where(~held_out()), each=100))
    told = identify(docs.where(held_out()), model).join(docs.select("doc_id", "lang"), "doc_id")
    right = told.selectExpr("avg(CAST(lang_pred = lang AS double)) AS right", "count(*) AS n").first()
    assert right.n > 100 and right.right >= 0.98


def test_sample_is_bounded_under_null_and_repeated_ids(spark, monkeypatch):
    rows = [(None, "de", f"text {at}") for at in range(900)] + [(None, "de", "copy")] * 900
    rows += [(7, "en", f"text {at}") for at in range(900)] + [(at, "fr", "same") for at in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(4)
    fetched, plain = [], type(docs).collect
    monkeypatch.setattr(type(docs), "collect", lambda df: [fetched.append(len(got := plain(df))), got][1])
    texts, labels = training_sample(docs, each=20)
    assert Counter(labels) == {"de": 20, "en": 20, "fr": 20} and max(fetched) <= 60
    assert len({text for text, label in zip(texts, labels) if label == "de"}) == 20
    assert (texts, labels) == training_sample(docs.repartition(7), each=20)


def test_languages_on_edge_rows(spark):
    docs = edge_docs(spark)
    model = fit_language_model(*training_sample(docs))
    found = with_language(docs, model).collect()
    assert len(found) == len(edge_rows()) and found[0].seed == "x"
    by_id = {r.doc_id: (r.lang_pred, r.score) for r in found}
    assert {name for name, (lang, _) in by_id.items() if lang == "und"} == {3, 4, 5, 8}
    assert all(0 <= score <= 1 for _, score in by_id.values())
    assert {r.lang_pred for r in with_language(docs, None).collect()} == {"und"}
    assert fit_language_model(*training_sample(empty_docs(spark))) is None
    assert identify(empty_docs(spark), model).collect() == []


def unigram(vocabulary, unknown, byte_fallback):
    made = Tokenizer(models.Unigram(vocabulary, unk_id=unknown, byte_fallback=byte_fallback))
    made.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return made


def test_counts_equal_the_library(spark):
    model = SentencePieceProcessor(model_file=PIECES)
    whole = unigram([(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())], 0, True)
    rng = random.Random(3)
    texts = ["", None, "  a  b ", "▁x ▁", "日本 😀é", "a\n\nb"] + [
        "".join(rng.choices("aeinrst  .,éß\n日", k=rng.randint(1, 80))) for _ in range(300)
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in count_tokens(docs, PIECES).collect()}
    assert got == {at: len(whole.encode(text or "", add_special_tokens=False).ids) for at, text in enumerate(texts)}


@pytest.mark.parametrize("seed", range(4))
def test_tie_rules_on_small_vocabularies(seed):
    """Whole scores over few letters make many equal sums."""
    rng = random.Random(seed)
    pieces = {"".join(rng.choices("▁abc", k=rng.randint(1, 4))) for _ in range(18)} - {""}
    vocabulary = [("<unk>", 0.0)] + [(piece, float(-rng.randint(1, 3))) for piece in sorted(pieces)]
    whole = unigram(vocabulary, 0, False)
    # The library takes the unknown piece's score into its least score.
    counter = UnigramCounter(vocabulary[1:], byte_pieces=False)
    for _ in range(300):
        text = "".join(rng.choices("abcd ", k=rng.randint(1, 25)))
        assert counter.text(text) == len(whole.encode(text, add_special_tokens=False).ids), text


def test_counts_on_edge_rows(spark):
    assert count_tokens(edge_docs(spark), PIECES).count() == len(edge_rows())
    assert count_tokens(empty_docs(spark), PIECES).collect() == []


def slow_shards(rows, shards, seed):
    import hashlib

    light = [(name, text or "", "" if source is None else f"={source}") for name, text, source in rows]
    totals = Counter(source for _, _, source in light)
    light.sort(key=lambda r: (hashlib.md5(f"{seed}:{r[0]}".encode()).hexdigest(), r[0]))
    rank, placed = Counter(), []
    for name, text, source in light:
        rank[source] += 1
        placed.append(((2 * rank[source] - 1) / (2 * totals[source]), source, rank[source], name, text))
    placed.sort()
    out, slots = [], Counter()
    for place, (_, _, _, name, text) in enumerate(placed):
        shard = place * shards // len(placed)
        raw = text.encode()
        out.append((name, len(raw) + 1, zlib.crc32(raw), "rows", shard, slots[shard], None))
        slots[shard] += 1
    return sorted(out)


@pytest.mark.parametrize("count", [1, 5, 200])
def test_shards_equal_the_definition(spark, count):
    rng = random.Random(count)
    rows = [(at, words(rng, 3), rng.choice(["hot", "hot", "hot", "b", None])) for at in range(count)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    assert sorted(tuple(r) for r in interleaved_shards(docs).collect()) == slow_shards(rows, 8, 7)


def test_every_shard_matches_the_mixture(spark):
    rng = random.Random(2)
    rows = [(at, "t", rng.choice("aaaabbc")) for at in range(800)]
    found = interleaved_shards(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    mixed = Counter((r.shard, rows[r.doc_id][2]) for r in found)
    for source in "abc":
        counts = [mixed[shard, source] for shard in range(8)]
        assert max(counts) - min(counts) <= 2


def test_shards_on_edge_rows(spark):
    found = interleaved_shards(edge_docs(spark)).collect()
    sizes = Counter(r.shard for r in found)
    assert len(found) == len(edge_rows()) and max(sizes.values()) - min(sizes.values()) <= 1
    assert all(sorted(r.slot for r in found if r.shard == shard) == list(range(n)) for shard, n in sizes.items())
    assert interleaved_shards(empty_docs(spark)).collect() == []


@pytest.fixture
def small_corpus(spark, tmp_path):
    rng = random.Random(12)
    base = [words(rng, 80) for _ in range(30)]
    rows = [(at, text) for at, text in enumerate(base)]
    rows += [(100 + at, base[at]) for at in range(5)]  # exact copies
    rows += [(200, f"{words(rng, 60)} {base[6][:300]}"), (201, "!!! 12"), (202, None), (203, base[7].replace("a", "b", 1))]
    item = words(rng, 25)
    rows += [(300, f"{words(rng, 40)} {item} {words(rng, 40)}")]
    docs = [(name, text, "en", f"s{name % 3}", len(text or "")) for name, text in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), rows


def test_pipeline_stage_by_stage(spark, small_corpus):
    sf_dir, rows = small_corpus
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = []
    for at, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, sf_dir)
        assert out.dtypes == docs.dtypes
        out.write.parquet(f"{sf_dir}/stage{at}")
        docs = spark.read.parquet(f"{sf_dir}/stage{at}")
        kept.append({r.doc_id: r.text for r in docs.collect()})
    texts = dict(rows)
    assert set(texts) - set(kept[0]) == {201, 202}
    assert not {100, 101, 102, 103, 104} & set(kept[1]) and set(range(30)) - set(kept[1]) == set()
    assert len(kept[2][200]) == len(texts[200]) - 300 and kept[2][0] == texts[0]
    assert set(kept[2]) - set(kept[3]) == {300}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    whole = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in packed) == sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in whole)
    assert {r.doc_id for r in packed} == set(kept[3])


def test_pipeline_of_edge_rows_and_of_nothing(spark, tmp_path):
    columns = list(corpus_pipeline.COLUMNS)
    for name, docs in (("edge", edge_docs(spark)), ("none", empty_docs(spark))):
        docs.select(*columns).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([(1, "a b c")], "item_id long, text string").write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
        pieces = corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect()
        assert bool(pieces) == (name == "edge")


def test_every_operator_is_registered():
    assert {name.split("_")[0] for name in queries.QUERIES} == {"pipeline", *(f"op{n}" for n in range(1, 14))}
    assert set(queries.ORACLE) <= set(queries.QUERIES)
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_matches_oracle(spark, name):
    from compare import compare, connect

    compare(queries.QUERIES[name](spark, SF_DIR), connect(SF_DIR), queries.ORACLE[name])
