"""Language identification: sparse multinomial logistic regression on TF-IDF of hashed character n-grams.

The weights are trained by follow-the-regularised-leader with elastic-net penalties, per coordinate, on a sample of
labelled documents of about ``SAMPLE`` rows (shared evenly by the languages; twice as many at most); a fifth of it is held back to fit the
temperature that calibrates the probabilities. Document frequencies are counted over all documents to learn from.
A prediction depends on the text alone.

Null texts and texts without a letter are ``und`` with score 1. Without anything to learn from, every other text is
``und`` with score 0. Null languages teach nothing. Ties go to the language that sorts first. Repeated rows get equal
results; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .features import char_grams, has_letter, only_letters

BITS, SIZES = 15, (1, 2, 3)
SAMPLE, EPOCHS = 4000, 3
#: Learning rate and smoothing of follow-the-regularised-leader, and its penalties.
RATE, SMOOTH, L1, L2 = 0.5, 1.0, 0.02, 0.02
UNKNOWN = "und"


def _grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    counts = np.bincount(char_grams(only_letters(text), SIZES, BITS), minlength=1 << BITS)
    at = np.nonzero(counts)[0]
    return at, counts[at]


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df, n = np.zeros((1 << BITS) + 1, np.int64), 0
    for b in batches:
        for t in b.column(0).to_pylist():
            df[_grams(t)[0]] += 1
            n += 1
    df[-1] = n  # the number of documents stands beside those of the features
    at = np.nonzero(df)[0]
    yield pa.record_batch([pa.array(at.astype(np.int32)), pa.array(df[at])], names=["feature", "n"])


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        got = [_grams(t) for t in b.column(1).to_pylist()]
        yield pa.record_batch([b.column(0), pa.array([a.astype(np.int32).tobytes() for a, _ in got], pa.binary()), pa.array([c.astype(np.int32).tobytes() for _, c in got], pa.binary()), b.column(2)], names=["lang", "at", "count", "h"])


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray  # features x languages
    bias: np.ndarray
    temperature: float = 1.0

    def tfidf(self, at: np.ndarray, count: np.ndarray) -> np.ndarray:
        x = (1 + np.log(count)) * self.idf[at]
        return x / max(1e-12, np.sqrt(x @ x))

    def logits(self, at: np.ndarray, count: np.ndarray) -> np.ndarray:
        return self.tfidf(at, count) @ self.weights[at] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if text is None or not has_letter(text):
            return UNKNOWN, 1.0
        if not self.langs:
            return UNKNOWN, 0.0
        p = softmax(self.logits(*_grams(text)) / self.temperature)
        k = int(p.argmax())
        return self.langs[k], float(p[k])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def train(rows: list[tuple[str, np.ndarray, np.ndarray]], idf: np.ndarray, seed: int = 0) -> Model:
    """Follow the regularised leader, one document at a time; rows are (language, features, counts)."""
    langs = sorted({r[0] for r in rows})
    k, n = len(langs), len(idf) + 1  # the last coordinate is the bias, without penalty
    model = Model(langs, idf, np.zeros((len(idf), k)), np.zeros(k))
    if not rows:
        return model
    order = np.random.default_rng(seed).permutation(len(rows))
    held, used = order[: len(rows) // 5], order[len(rows) // 5 :]
    z, squares = np.zeros((n, k)), np.zeros((n, k))
    penalty = np.append(np.ones(n - 1), 0.0)[:, None]

    def weights(at: np.ndarray) -> np.ndarray:
        strength = L1 * penalty[at]
        shrunk = -(z[at] - np.sign(z[at]) * strength) / ((SMOOTH + np.sqrt(squares[at])) / RATE + L2 * penalty[at])
        return np.where(np.abs(z[at]) <= strength, 0.0, shrunk)

    data = [(np.append(at, n - 1), np.append(model.tfidf(at, count), 1.0), langs.index(lang)) for lang, at, count in rows]
    for _ in range(EPOCHS):
        for i in used:
            at, x, y = data[i]
            w = weights(at)
            g = softmax(x @ w)
            g[y] -= 1
            g = x[:, None] * g
            step = (np.sqrt(squares[at] + g * g) - np.sqrt(squares[at])) / RATE
            z[at] += g - step * w
            squares[at] += g * g
    final = weights(np.arange(n))
    model.weights, model.bias = final[:-1].astype(np.float32), final[-1]
    if len(held):
        logits = np.array([data[i][1][:-1] @ model.weights[data[i][0][:-1]] + model.bias for i in held])
        truth = np.array([data[i][2] for i in held])
        loss = lambda t: -np.log(softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean()
        model.temperature = float(min(np.exp(np.linspace(np.log(0.05), np.log(5), 60)), key=loss))
    return model


def fit(docs: DataFrame, learn_from: Column, sample: int = SAMPLE) -> Model:
    """A model from the rows of ``docs`` (``text``, ``lang``, and an id for sampling) where ``learn_from`` holds."""
    rows = docs.filter(learn_from & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    df = np.zeros((1 << BITS) + 1)
    counted = rows.select("text").mapInArrow(_document_frequencies, "feature int, n bigint")
    for r in counted.groupBy("feature").agg(F.sum("n").alias("n")).collect():
        df[r["feature"]] = r["n"]
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1
    share = sample / max(1, len(sizes))
    rates = F.map_from_arrays(F.array(*map(F.lit, sizes)), F.array(*[F.lit(min(1.0, share / n)) for n in sizes.values()])) if sizes else F.lit(None)
    drawn = rows.withColumn("h", F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 52)))
    if sizes:
        drawn = drawn.filter(F.col("h") / float(1 << 52) < F.element_at(rates, F.col("lang")))
    # equal rows are drawn together: of more than twice the sample, those of least hash count, whatever their order
    got = drawn.select("lang", "text", "h").mapInArrow(_vectors, "lang string, at binary, count binary, h bigint").orderBy("h", "lang", "at", "count").limit(2 * sample).toArrow()
    found = sorted(zip(*(got[c].to_pylist() for c in ("lang", "at", "count")), strict=True))  # the order of arrival doesn't matter
    return train([(a, np.frombuffer(b, np.int32), np.frombuffer(c, np.int32)) for a, b, c in found], idf)


def predictions(docs: DataFrame, model: Model, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keys``, ``lang_pred`` and ``score`` for every row. The model's size is bounded by its features and languages."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            got = [m.predict(t) for t in b.column(b.num_columns - 1).to_pylist()]
            yield pa.record_batch([*b.columns[:-1], pa.array([x for x, _ in got], pa.string()), pa.array([p for _, p in got], pa.float64())], names=[*keys, "lang_pred", "score"])

    kinds = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys)
    return docs.select(*keys, F.col("text").cast("string")).mapInArrow(predict, f"{kinds}, lang_pred string, score double")
