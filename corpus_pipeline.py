"""Corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir); what it returns is written and read
again as the next stage's documents. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegrid.llm.common import prepare_workers
from tastegrid.llm.decontamination import decontaminated
from tastegrid.llm.language import UNKNOWN, fit_language_model, held_out, training_sample, with_language
from tastegrid.llm.packing import pack_documents
from tastegrid.llm.simhash import one_of_each_group
from tastegrid.llm.suffix_dedup import remove_repeats
from tastegrid.session import fresh_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A text whose best language scores less is in none of them.
MIN_SCORE = 0.2


def _stage(function):
    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        prepare_workers(spark)
        return function(spark, docs, sf_dir)

    return run_stage


@_stage
def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages; those without a letter, or
    that fit none, go. ``lang`` stays as it is."""
    model = fit_language_model(*training_sample(docs.where(~held_out())))
    told = with_language(docs.select(*COLUMNS), model)
    return told.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= MIN_SCORE)).select(*COLUMNS)


@_stage
def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates, that of the least id (a null id
    is the last). Repeated rows and copies under one id, or under none, are such
    groups, too."""
    return one_of_each_group(docs.select(*COLUMNS), shingle=3, distance=3)


@_stage
def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated passages. A text of which nothing is left goes;
    one that was empty before stays."""
    cut = remove_repeats(docs, as_text=True, carried=("lang", "source"))
    return cut.where("kept <> '' OR n_removed = 0").select(
        "doc_id", F.col("kept").alias("text"), "lang", "source", F.length("kept").cast("long").alias("n_chars")
    )


@_stage
def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text overlaps with no item of the benchmark. It goes by the
    text, so rows that share an id, or have none, are judged apart; null and empty
    texts stay."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


@_stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 token ids. Repeated and null ids are
    packed like others; a null or empty text is its end id alone."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), size=2048, end_id=1)


STAGES = [
    ("language ID", known_language),
    ("SimHash near-dedup", without_near_duplicates),
    ("suffix-array dedup", without_repeats),
    ("benchmark decontamination", without_benchmark),
    ("packing", packed),
]

#: SQL has no string kernel, fingerprint components or tokenizer; a test holds the
#: rows against a chain of brute-force stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``. An empty table gives no row."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        path = fresh_path(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
