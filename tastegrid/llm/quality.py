"""Quality rules: a learned decision list over text statistics.

Sequential covering grows conjunctions of thresholds on one part of a labelled
sample, prunes them on the other, and takes the rows each accepted rule covers
out before the next one is grown. The list becomes an ordered Spark ``CASE``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegrid.llm.tokens import string_column

SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\x0b\x0c\r"
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_DIGITS = b"0123456789"

_COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_digits", "n_distinct_words", "n_marks",
)
_STATISTICS = "_id long, " + ", ".join(f"{name} long" for name in _COUNTS)

#: Ratios that the rules test, from the counts above.
RATIOS = {
    "words": ("n_words", None),
    "word_length": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "dup_lines_per_line": ("n_dup_lines", "n_lines"),
    "repeated_share": ("n_repeat_words", "n_words"),
    "upper_per_char": ("n_upper", "word_chars"),
    "digits_per_char": ("n_digits", "word_chars"),
    "distinct_share": ("n_distinct_words", "n_words"),
    "words_per_line": ("n_words", "n_lines"),
    "marks_per_word": ("n_marks", "n_words"),
}


def text_counts(text: str | None) -> tuple[int, ...]:
    """The counts of one whole text, in the order of ``_COUNTS``.

    Words are the runs between ASCII white space, which is how ``bytes.split``
    cuts; UTF-8 has no other use of those bytes.
    """
    text = text or ""
    raw = text.encode()
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.split()]
    return (
        len(words),
        len(text) - sum(map(text.count, _SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(raw) - len(raw.translate(None, _UPPER)),
        len(raw) - len(raw.translate(None, _DIGITS)),
        len(set(words)),
        sum(map(raw.count, (b"!", b"?", b"@", b"="))),
    )


def repeated_words(words: Sequence[bytes], width: int = 3) -> int:
    """Words inside a window of ``width`` words that the text has twice or more."""
    windows = list(zip(*(words[k:] for k in range(width))))
    found = Counter(windows)
    if len(found) == len(windows):
        return 0
    covered, end = 0, 0
    for start, window in enumerate(windows):
        if found[window] > 1:
            covered += start + width - max(start, end)
            end = start + width
    return covered


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and ratios of every whole text; a null text has no words, and a
    ratio without a denominator is 0. Other columns are left out."""

    def count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(zip(*(text_counts(text.as_py()) for text in string_column(batch, "_text"))))
            arrays = [batch.column("_id"), *(pa.array(column, pa.int64()) for column in columns)]
            if columns:
                yield pa.RecordBatch.from_arrays(arrays, names=["_id", *_COUNTS])

    counted = docs.select(docs[id_col].cast("long").alias("_id"), docs[text_col].alias("_text")).mapInArrow(
        count_task, _STATISTICS
    )
    ratios = {
        name: F.coalesce(F.try_divide(top, bottom), F.lit(0.0)) if bottom else F.col(top).cast("double")
        for name, (top, bottom) in RATIOS.items()
    }
    return counted.withColumns(ratios).withColumnRenamed("_id", id_col)


@dataclass(frozen=True)
class Condition:
    feature: str
    at_most: bool
    threshold: float

    def holds(self, values: np.ndarray) -> np.ndarray:
        return values <= self.threshold if self.at_most else values > self.threshold

    def column(self) -> Column:
        value, limit = F.col(self.feature), F.lit(float(self.threshold))
        return value <= limit if self.at_most else value > limit

    def __str__(self) -> str:
        return f"{self.feature} {'<=' if self.at_most else '>'} {self.threshold:g}"


@dataclass(frozen=True)
class DecisionList:
    """Rules in order; a row that meets one is rejected, one that meets none is kept."""

    rules: tuple[tuple[Condition, ...], ...]

    def rejected(self, table: dict[str, np.ndarray], rows: int) -> np.ndarray:
        out = np.zeros(rows, dtype=bool)
        for rule in self.rules:
            out |= _covered(rule, table, rows)
        return out

    def verdict(self) -> Column:
        """False for rows that a rule rejects, else true."""
        return self._cases(lambda number: F.lit(False), F.lit(True))

    def rule_number(self) -> Column:
        """Number from 1 of the first rule that holds, 0 for none."""
        return self._cases(F.lit, F.lit(0))

    def _cases(self, value, otherwise: Column) -> Column:
        chain = F
        for number, rule in enumerate(self.rules, 1):
            met = rule[0].column()
            for condition in rule[1:]:
                met = met & condition.column()
            chain = chain.when(met, value(number))
        return chain.otherwise(otherwise) if self.rules else otherwise


def _covered(rule: Sequence[Condition], table: dict[str, np.ndarray], rows: int) -> np.ndarray:
    met = np.ones(rows, dtype=bool)
    for condition in rule:
        met &= condition.holds(table[condition.feature])
    return met


def _gain(hits: np.ndarray, misses: np.ndarray, hits_before: int, misses_before: int) -> np.ndarray:
    """FOIL's information gain of covering ``hits`` and ``misses`` instead."""
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = hits * (np.log2(hits / (hits + misses)) - np.log2(hits_before / (hits_before + misses_before)))
    return np.where(hits > 0, gain, -np.inf)


def _best_condition(table: dict[str, np.ndarray], bad: np.ndarray, met: np.ndarray, steps: int) -> Condition | None:
    best, chosen = 1e-9, None
    total_bad, total = int(bad[met].sum()), int(met.sum())
    for feature, values in table.items():
        own, own_bad = values[met], bad[met]
        cuts = np.unique(np.quantile(own, np.linspace(0, 1, steps + 1), method="lower"))[:-1]
        order = np.argsort(own, kind="stable")
        ends = np.searchsorted(own[order], cuts, side="right")
        bad_below = np.concatenate([[0], np.cumsum(own_bad[order])])[ends]
        for at_most, hits, size in ((True, bad_below, ends), (False, total_bad - bad_below, total - ends)):
            gains = _gain(hits, size - hits, total_bad, total - total_bad)
            if len(gains) and gains.max() > best:
                best, chosen = gains.max(), Condition(feature, at_most, float(cuts[int(gains.argmax())]))
    return chosen


def _score(rule: Sequence[Condition], table: dict[str, np.ndarray], bad: np.ndarray) -> tuple[float, int, int]:
    met = _covered(rule, table, len(bad))
    hits, misses = int((met & bad).sum()), int((met & ~bad).sum())
    return ((hits - misses) / (hits + misses) if hits + misses else -1.0), hits, misses


def learn_rules(
    table: dict[str, np.ndarray],
    bad: np.ndarray,
    min_precision: float = 0.9,
    min_hits: int = 3,
    max_conditions: int = 4,
    steps: int = 64,
    seed: int = 7,
) -> DecisionList:
    """Sequential covering of the ``bad`` rows.

    Two thirds of the rows that are left grow a rule by information gain, one
    third prunes it: last conditions go while (hits - misses) / covered does
    not fall. A rule is taken if it has ``min_hits`` hits on the pruning rows
    and a precision there of ``min_precision`` or more; else the list ends. Without bad rows,
    or without any row, the list is empty and keeps everything.
    """
    rules: list[tuple[Condition, ...]] = []
    left, rng = np.ones(len(bad), dtype=bool), np.random.default_rng(seed)
    while bad[left].any():
        grow = left & (rng.random(len(bad)) < 2 / 3)
        test = left & ~grow
        rule: list[Condition] = []
        met = grow.copy()
        while len(rule) < max_conditions and bad[met].any() and not bad[met].all():
            condition = _best_condition(table, bad, met, steps)
            if condition is None:
                break
            rule.append(condition)
            met &= condition.holds(table[condition.feature])
        held = {feature: values[test] for feature, values in table.items()}
        while len(rule) > 1 and _score(rule[:-1], held, bad[test])[0] >= _score(rule, held, bad[test])[0]:
            rule.pop()
        if not rule:
            break
        _, hits, misses = _score(rule, held, bad[test])
        if hits < min_hits or hits < min_precision * (hits + misses):
            break
        rules.append(tuple(rule))
        left &= ~_covered(rule, table, len(bad))
    return DecisionList(tuple(rules))


def base_failed() -> Column:
    """Fewer than 50 words, or over half of the words in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def fit_rules(
    statistics: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    label_col: str = "quality",
    most_rows: int = 20_000,
    **learning,
) -> DecisionList:
    """Learn from the statistics of labelled documents, 0 being bad.

    At most ``most_rows`` labelled rows, chosen by a hash of their id, go to the
    driver; that bound holds at any size of the table. Null labels are left out,
    and so are rows that the base rules reject without the list.
    """
    told = labels.where(F.col(label_col).isNotNull()).select(
        F.col(id_col).cast("long").alias(id_col), (F.col(label_col) == 0).alias("_bad")
    )
    sample = (
        statistics.where(~base_failed())
        .join(told, id_col)
        .select(id_col, "_bad", *RATIOS)
        .orderBy(F.xxhash64(id_col), id_col, "_bad", *RATIOS)
        .limit(most_rows)
        .toArrow()
    )
    table = {name: sample.column(name).to_numpy() for name in RATIOS}
    return learn_rules(table, sample.column("_bad").to_numpy(zero_copy_only=False).astype(bool), **learning)


def judged(statistics: DataFrame, rules: DecisionList) -> DataFrame:
    """Statistics with ``base_failed``, the number of the rule that rejects, and ``kept``."""
    return statistics.withColumns(
        {"base_failed": base_failed(), "rule": rules.rule_number(), "kept": ~base_failed() & rules.verdict()}
    )
