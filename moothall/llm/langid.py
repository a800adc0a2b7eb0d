"""Language identification with string kernels.

A text's features are which character 1-, 2- and 3-grams it has (presence, not counts), over lower-cased letters with
every other character as one separator. The blended-spectrum kernel of two texts is the number of features that both
have, normalised by their own numbers. Nyström landmarks, a bounded set of training texts, turn the kernel into
explicit coordinates, on which one kernel ridge regression for each language is fitted against the rest. Texts are
scored in batches: presence matrix times landmark matrix, then times weights.

N-grams are numbered by a fixed rule: letters below U+0180 by code point and others by a hash into 128 classes, pairs
and triples by a hash into 65,536 bins each. The landmark matrix thus has ``FEATURES`` x ``landmarks`` bytes for each language at
most, which bounds what is sent to the executors, whatever the corpus. Equally the features of a training text are at most
``FEATURES`` integers.

Fitting reads a bounded sample: the ``per_language`` different training texts of each language with the smallest hashes,
whole. Prediction reads whole texts, and nothing but texts.

Defined results: a null text or one without a letter is ``und`` with score 0; a training set without rows predicts
``und`` for all; equal texts get equal predictions; ties go to the language that sorts first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Texts that are learned from and landmarks, both for each language, and the ridge.
PER_LANGUAGE, LANDMARKS, RIDGE = 300, 24, 0.1
LETTERS, BINS = 512, 65536
FEATURES = LETTERS + 2 * BINS
#: Texts of a matrix product.
ROWS = 128
#: Characters that are turned into n-grams at once; pieces of a longer text overlap by two.
PIECE = 1 << 20

_tables: dict[str, np.ndarray] = {}


def _table() -> np.ndarray:
    """By code point: the class of a lower-cased letter, from 1; 0 for all else."""
    if "classes" not in _tables:
        classes = np.zeros(0x110000, np.int64)
        for i in range(0x110000):
            if (c := chr(i)).isalpha():
                low = c.lower()
                k = ord(low[0])
                classes[i] = k if k < 0x180 else 0x180 + (k * 2654435761 >> 11) % 128
        _tables["classes"] = classes
    return _tables["classes"]


def features(text: str, seen: np.ndarray) -> np.ndarray:
    """The sorted numbers of a text's n-grams; none without letters. ``seen`` is a scratch array of FEATURES falses."""
    table = _table()
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    letters = False
    for i in range(0, max(len(code), 1), PIECE):
        c = table[code[i : i + PIECE + 2]]
        letters = letters or bool(c.any())
        seen[c] = True
        pair = (c[:-1] << 9) | c[1:]
        seen[LETTERS + ((pair * 40503 >> 2) & 0xFFFF)] = True
        triple = (pair[:-1] << 9) | c[2:]
        seen[LETTERS + BINS + ((triple * 2654435761 >> 13) & 0xFFFF)] = True
    found = np.flatnonzero(seen).astype(np.int32)
    seen[found] = False
    return found if letters else found[:0]


@dataclass
class Model:
    """columns: the landmarks' features; landmarks: which of them each landmark has; size: each landmark's number of
    features; weights: kernel values to one score for each language."""

    languages: list[str]
    columns: np.ndarray
    landmarks: np.ndarray
    size: np.ndarray
    weights: np.ndarray

    def kernel(self, rows: list[np.ndarray]) -> np.ndarray:
        """Of each row of features with each landmark."""
        place = np.full(FEATURES, -1, np.int64)
        place[self.columns] = np.arange(len(self.columns))
        z = self.landmarks.astype(np.float32)
        out = np.zeros((len(rows), z.shape[1]))
        for i in range(0, len(rows), ROWS):
            part = rows[i : i + ROWS]
            present = np.zeros((len(part), len(self.columns)), np.float32)
            for k, x in enumerate(part):
                p = place[x]
                present[k, p[p >= 0]] = 1
            own = np.array([max(len(x), 1) for x in part])
            out[i : i + ROWS] = (present @ z) / np.sqrt(np.outer(own, self.size))
        return out

    def score(self, rows: list[np.ndarray]) -> np.ndarray:
        return self.kernel(rows) @ self.weights


def fit(rows: list[np.ndarray], labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model | None:
    """Kernel ridge regression on Nyström coordinates; the first ``landmarks`` rows of each language are landmarks."""
    kept = [(x, y) for x, y in zip(rows, labels) if len(x)]
    if not kept:
        return None
    rows, labels = [x for x, _ in kept], [y for _, y in kept]
    languages = sorted(set(labels))
    queues = [[i for i, y in enumerate(labels) if y == lang] for lang in languages]
    chosen = [rows[q[k]] for k in range(landmarks) for q in queues if k < len(q)]
    columns = np.unique(np.concatenate(chosen))
    matrix = np.zeros((len(columns), len(chosen)), np.uint8)
    for k, x in enumerate(chosen):
        matrix[np.searchsorted(columns, x), k] = 1
    model = Model(languages, columns, matrix, np.array([len(x) for x in chosen]), np.zeros((len(chosen), len(languages))))
    w, v = np.linalg.eigh(model.kernel(chosen))
    good = w > 1e-8 * w.max()
    half = v[:, good] / np.sqrt(w[good])
    x = model.kernel(rows) @ half
    y = np.array([[1.0 if lang == own else -1.0 for lang in languages] for own in labels])
    # languages weigh the same, however many rows the sample has of them
    share = np.array([1 / labels.count(own) for own in labels])[:, None] * len(labels) / len(languages)
    solved = np.linalg.solve(x.T @ (x * share) + ridge * np.eye(x.shape[1]), x.T @ (y * share))
    model.weights = half @ solved
    return model


def packed(text: Column) -> Column:
    """A text's features as binary, four bytes each."""

    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        seen = np.zeros(FEATURES, bool)
        for texts in batches:
            yield pd.Series([features(x, seen).tobytes() for x in texts.fillna("")], dtype=object)

    return F.pandas_udf(found, "binary")(text)


def train(
    docs: DataFrame, per_language: int = PER_LANGUAGE, landmarks: int = LANDMARKS, text: str = "text", label: str = "lang"
) -> Model | None:
    """Fit on at most ``per_language`` different texts of each language in ``docs``, those with the least hashes, however
    often each occurs; rows without text or label are left out."""
    rows = docs.select(F.col(text).alias("text"), F.col(label).alias("label")).where("text IS NOT NULL AND label IS NOT NULL")
    rows = rows.withColumn("order", F.xxhash64("text"))
    keys = rows.select("label", "order").distinct()
    # a first cut by hash leaves a few times as many texts as are wanted, so that the ranking below stays small
    counts = {r["label"]: r["count"] for r in keys.groupBy("label").count().collect()}
    if not counts:
        return None
    share = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, 3 * per_language / n)))])
    keys = keys.where(F.pmod("order", F.lit(1_000_003)) < share[F.col("label")] * 1_000_003)
    ranked = keys.withColumn("n", F.row_number().over(Window.partitionBy("label").orderBy("order")))
    chosen = ranked.where(F.col("n") <= per_language).select("label", "order")
    sample = rows.join(F.broadcast(chosen), ["label", "order"]).groupBy("label", "order").agg(F.min("text").alias("text"))
    got = sample.select("label", "order", packed(F.col("text")).alias("x")).collect()
    got = sorted(got, key=lambda r: (r["label"], r["order"]))
    return fit([np.frombuffer(r["x"], np.int32) for r in got], [r["label"] for r in got], landmarks)


def predict(text: Column, model: Model | None) -> Column:
    """struct<lang, score> of a text column by the model alone."""

    def guessed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        seen = np.zeros(FEATURES, bool)
        for texts in batches:
            rows = [features(x, seen) for x in texts.fillna("")]
            lang, score = np.full(len(rows), "und", object), np.zeros(len(rows))
            real = np.flatnonzero([len(x) > 0 for x in rows])
            if model is not None and len(real):
                s = model.score([rows[i] for i in real])
                best = s.argmax(axis=1)
                lang[real] = np.array(model.languages, object)[best]
                soft = np.exp(3 * (s - s.max(axis=1, keepdims=True)))
                score[real] = 1 / soft.sum(axis=1)
            yield pd.DataFrame({"lang": lang, "score": score})

    return F.pandas_udf(guessed, "lang string, score double")(text)


def training_rows(docs: DataFrame) -> DataFrame:
    """Documents that may be learned from: crc32 of the id as text, mod 5, isn't 0."""
    return docs.where(~held_out() & F.col("lang").isNotNull())


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def identified(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; without a model it is trained on the documents' own training rows."""
    model = model or train(training_rows(docs))
    docs = docs.withColumn("__guess", predict(F.col("text"), model))
    return docs.withColumns({"lang_pred": F.col("__guess.lang"), "score": F.col("__guess.score")}).drop("__guess")
