"""Language identification with a string kernel and Nyström landmarks.

The kernel of two texts is the number of n-grams of 1 to 3 letters that both
have (presence, not frequency: the blended spectrum kernel), divided by the
root of the product of their numbers of n-grams. A ridge regression against
the rest for each language is fitted on the Nyström features of a bounded
sample, and applied as products of a batch's n-gram matrix, the landmarks'
n-gram matrix and the weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tastegrid.llm.common import checkpointed
from tastegrid.llm.tokens import string_column
from tastegrid.operators.ranking import top_n_per_key

UNKNOWN = "und"
_ORDERS = 3
_CODE_POINTS = 0x110000
# Symbol 0 stands for letters outside the alphabet, 1 for what lies between words.
_OTHER, _GAP = 0, 1
_BATCH_DOCS = 64
# Parts of a language that the training sample is cut in, one after the other.
_CUTS = (1024, 32, 1)


class Alphabet:
    """Maps texts to arrays of numbered letters and to their distinct n-grams."""

    def __init__(self, letters: str):
        self.letters = letters
        self.size = len(letters) + 2
        self.orders = [self.size**n for n in range(1, _ORDERS + 1)]
        self._symbols: np.ndarray | None = None

    def __getstate__(self):
        return {**self.__dict__, "_symbols": None}

    def _table(self) -> np.ndarray:
        if self._symbols is None:
            number = {letter: at for at, letter in enumerate(self.letters, 2)}
            symbols = np.full(_CODE_POINTS, _GAP, dtype=np.int64)
            for point in range(_CODE_POINTS):
                letter = chr(point)
                if letter.isalpha():
                    symbols[point] = number.get(letter.lower(), _OTHER)
            self._symbols = symbols
        return self._symbols

    def distinct_grams(self, text: str) -> np.ndarray:
        """Numbers of the distinct n-grams of the whole text; none without a letter."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        line = np.concatenate([[_GAP], self._table()[points], [_GAP]])
        line = line[np.concatenate([[True], (line[1:] != _GAP) | (line[:-1] != _GAP)])]
        if len(line) < 2:
            return np.empty(0, dtype=np.int64)
        if line[-1] != _GAP:
            line = np.append(line, _GAP)
        parts, code, first = [], np.zeros(len(line), dtype=np.int64), 0
        for n in range(1, _ORDERS + 1):
            code = code[: len(line) - n + 1] * self.size + line[n - 1 :]
            parts.append(code + first)
            first += self.orders[n - 1]
        return np.unique(np.concatenate(parts))


@dataclass
class LanguageModel:
    """Languages, the n-grams that landmarks have, and the fitted weights."""

    languages: list[str]
    alphabet: Alphabet
    used: np.ndarray  # numbers of the landmarks' n-grams, in order, one per column
    landmarks: np.ndarray  # columns x landmarks, 1 where a landmark has the n-gram
    sizes: np.ndarray  # n-grams of each landmark
    weights: np.ndarray  # landmarks x languages

    def kernel(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Kernel values against the landmarks, and the n-grams of each text."""
        present = np.zeros((len(texts), len(self.landmarks)), dtype=np.float32)
        counts = np.zeros(len(texts))
        for row, text in enumerate(texts):
            grams = self.alphabet.distinct_grams(text)
            counts[row] = len(grams)
            columns = np.searchsorted(self.used, grams)
            columns[columns == len(self.used)] = 0
            present[row, columns[self.used[columns] == grams]] = 1.0
        return present @ self.landmarks / np.sqrt(np.maximum(counts, 1)[:, None] * self.sizes), counts

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of each text; ``und`` and 0 without a letter."""
        kernel, counts = self.kernel([text or "" for text in texts])
        margins = kernel @ self.weights
        best = margins.argmax(axis=1)
        scores = np.clip((margins[np.arange(len(best)), best] + 1) / 2, 0, 1)
        names = [self.languages[at] if count else UNKNOWN for at, count in zip(best, counts)]
        return names, [float(score) if count else 0.0 for score, count in zip(scores, counts)]


def fit_language_model(
    texts: list[str],
    languages: list[str],
    landmarks_each: int = 48,
    ridge: float = 1e-3,
) -> LanguageModel | None:
    """Fit on texts with a letter; None if there are none.

    The first ``landmarks_each`` texts of each language are landmarks, which
    bounds the model whatever the number of documents it is applied to. All
    letters of the texts are the alphabet; others in later texts are one symbol.
    """
    rows = [(text, language) for text, language in zip(texts, languages) if any(map(str.isalpha, text))]
    if not rows:
        return None
    names = sorted({language for _, language in rows})
    alphabet = Alphabet("".join(sorted({letter for text, _ in rows for letter in text.lower() if letter.isalpha()})))
    chosen = [text for name in names for text in [t for t, language in rows if language == name][:landmarks_each]]
    grams = [alphabet.distinct_grams(text) for text in chosen]
    used = np.unique(np.concatenate(grams))
    matrix = np.zeros((len(used), len(chosen)), dtype=np.float32)
    for at, own in enumerate(grams):
        matrix[np.searchsorted(used, own), at] = 1.0
    sizes = np.array([len(own) for own in grams], dtype=float)
    model = LanguageModel(names, alphabet, used, matrix, sizes, np.zeros((len(chosen), len(names))))

    among = (matrix.T.astype(float) @ matrix) / np.sqrt(sizes[:, None] * sizes)
    values, vectors = np.linalg.eigh(among)
    solid = values > 1e-8 * values.max()
    root = vectors[:, solid] / np.sqrt(values[solid])
    parts = [rows[at : at + _BATCH_DOCS] for at in range(0, len(rows), _BATCH_DOCS)]
    features = np.concatenate([model.kernel([text for text, _ in part])[0] for part in parts]) @ root
    truth = np.array([[1.0 if language == name else -1.0 for name in names] for _, language in rows])
    # Each language weighs the same, however the sample is mixed.
    share = truth.clip(0).sum(axis=0)
    weight = (truth.clip(0) / share).sum(axis=1)
    gram = features.T @ (features * weight[:, None])
    model.weights = root @ np.linalg.solve(gram + ridge * np.eye(len(gram)), features.T @ (truth * weight[:, None]))
    return model


def training_sample(
    docs: DataFrame,
    label_col: str = "lang",
    each: int = 300,
    id_col: str = "doc_id",
    text_col: str = "text",
    most_bytes: int = 16 << 20,
) -> tuple[list[str], list[str]]:
    """At most ``each`` whole texts per language, those with the least hash of
    id and text, on the driver. Rows that agree in both count once. Of a
    language whose texts have more than ``most_bytes`` together only the first
    are taken, up to that many bytes, but one in any case.

    A language is cut to ``each`` hashes in many parts, then in fewer, so that
    the last task takes in a fixed number of rows of it; only the texts that are
    chosen are fetched.
    """
    told = docs.select(
        docs[label_col].alias("label"),
        docs[text_col].alias("text"),
        F.xxhash64(docs[id_col], docs[text_col]).alias("hash"),
    ).where("text IS NOT NULL AND label IS NOT NULL")
    least = told.select("label", "hash", F.octet_length("text").cast("long").alias("size")).distinct()
    for parts in _CUTS:
        dealt = least.withColumn("part", F.pmod("hash", F.lit(parts)))
        least = top_n_per_key(dealt, ["label", "part"], [F.col("hash")], each).select("label", "hash", "size")
    least = checkpointed(least)
    earlier = Window.partitionBy("label").orderBy("hash").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("size").over(earlier), F.lit(0))
    fitting = least.withColumn("before", before).where((F.col("before") == 0) | (F.col("before") + F.col("size") <= most_bytes))
    near = told.join(F.broadcast(fitting.select("label", "hash")), ["label", "hash"], "left_semi")
    found = near.groupBy("label", "hash").agg(F.min("text").alias("text")).collect()
    chosen = sorted((row.label, row.hash, row.text) for row in found)
    return [text for *_, text in chosen], [label for label, *_ in chosen]


def with_language(docs: DataFrame, model: LanguageModel | None, text_col: str = "text") -> DataFrame:
    """``docs``, all columns, with ``lang_pred`` and ``score`` of the whole text,
    which replace columns of these names.

    A null text, an empty one or one without a letter is ``und`` with score 0,
    as is every text without a model. Equal scores go to the language first by
    name. Repeated rows stay.
    """

    def predict_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = string_column(batch, text_col)
            names: list[str] = []
            scores: list[float] = []
            for start in range(0, len(texts), _BATCH_DOCS):
                part = texts.slice(start, _BATCH_DOCS).to_pylist()
                found = model.predict(part) if model else ([UNKNOWN] * len(part), [0.0] * len(part))
                names += found[0]
                scores += found[1]
            arrays = [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, "lang_pred", "score"])

    plain = docs.drop("lang_pred", "score")
    schema = StructType([*plain.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return plain.mapInArrow(predict_task, schema)


def identify(docs: DataFrame, model: LanguageModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every whole text, as ``with_language`` gives them."""
    return with_language(docs.select(id_col, text_col), model, text_col).select(id_col, "lang_pred", "score")


def held_out(id_col: str = "doc_id"):
    """Whether a document is kept from training: crc32 of its id as text, mod 5."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))
