"""Rows that every operator must take: nulls, empty and long texts, repeats."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, _id long, seed string"


def words(rng: random.Random, count: int, letters: str = "abcdefgh") -> str:
    return " ".join("".join(rng.choices(letters, k=rng.randint(2, 6))) for _ in range(count))


def edge_rows() -> list[tuple]:
    """Columns beyond the first four carry names that operators use inside."""
    rng = random.Random(5)
    plain = words(rng, 120)
    long = words(rng, 30_000)
    texts = [
        (1, plain), (2, plain), (3, None), (4, ""), (5, " \t\n"), (6, "one"), (7, long), (7, long), (8, "!!! 123 ###"),
        (None, words(rng, 60)), (9, plain + " " + words(rng, 40)), (10, "é" * 300), (11, "日本語 \U0001f600 " * 30),
        (12, words(rng, 50) + " " + plain[:400]), (13, "a" * 2000), (14, "<|endoftext|> it's x́y."),
    ]
    return [(i, t, "en" if i and i % 2 else None, None if i == 4 else "s", 1, 0.5, 7, "x") for i, t in texts]


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df) -> list[tuple]:
    return sorted((tuple(row) for row in df.collect()), key=repr)
