"""Registered queries over the test tables, one for each operator here."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tastegrid.llm.bpe_trie import encode_texts
from tastegrid.llm.collocations import collocations
from tastegrid.llm.common import checkpointed, prepare_workers
from tastegrid.llm.decontamination import contaminated
from tastegrid.llm.hard_negatives import hard_negatives
from tastegrid.llm.html_text import extract_main_text
from tastegrid.llm.language import fit_language_model, held_out, identify, training_sample
from tastegrid.llm.oracle import ORACLE
from tastegrid.llm.packing import pack_documents
from tastegrid.llm.quality import fit_rules, judged, text_statistics
from tastegrid.llm.sharding import interleaved_shards
from tastegrid.llm.simhash import near_duplicates
from tastegrid.llm.suffix_dedup import remove_repeats
from tastegrid.llm.token_counts import count_tokens
from tastegrid.llm.token_files import read_token_files, with_checksum, write_token_files
from tastegrid.session import fresh_path

TOKENIZER = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    statistics = checkpointed(text_statistics(_table(spark, sf_dir, "documents")))
    return judged(statistics, fit_rules(statistics, _table(spark, sf_dir, "labels"))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )


def main_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(_table(spark, sf_dir, "pages"))


def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, distance=3)


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = fit_language_model(*training_sample(docs.where(~held_out())))
    return identify(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def interleaved_shard_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interleaved_shards(_table(spark, sf_dir, "documents"), shards=8)


def benchmark_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), size=2048, end_id=1)


def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "token-files")
    path = public_tokenizers.path(TOKENIZER)
    return with_checksum(read_token_files(write_token_files(_table(spark, sf_dir, "documents"), folder, path, end_id=1)))


def trie_encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_texts(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), decoded=True)
    numbers = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(numbers, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents"), least=100, longest=5, most=2000)


def mined_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(_table(spark, sf_dir, "embeddings"), is_anchor=F.col("id") % 50 == 0, label=label)


QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_quality_rules": quality_rules,
    "op2_html_text": main_texts,
    "op3_suffix_dedup": suffix_dedup,
    "op4_simhash_near_duplicates": simhash_near_duplicates,
    "op5_language_id": languages,
    "op6_token_counts": token_counts,
    "op7_interleaved_shards": interleaved_shard_rows,
    "op8_sum_of_squares_packing": packed_sequences,
    "op9_token_files": token_files,
    "op10_spaced_seed_decontamination": benchmark_overlaps,
    "op11_bpe_trie": trie_encoded,
    "op12_phrase_collocations": phrase_collocations,
    "op13_hard_negatives": mined_negatives,
}


