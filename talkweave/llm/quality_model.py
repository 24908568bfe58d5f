"""Quality classifier on supervised subword embeddings.

Each word, pair of words and character n-gram of a text is hashed to a learned vector; their mean is the document's
vector, and a softmax layer over it gives the probability of each class. Vectors and layer are trained by stochastic
gradient descent in numpy, on a sample of about ``SAMPLE`` labelled documents (twice as many at most), the classes in equal parts, so that
a score of a half weighs errors of both kinds alike. For scoring, the difference of the two classes is a number per
bucket, so a document's score is the logistic function of a mean of numbers.

Null and empty texts have no features: their score is that of the bias. Without rows of both classes to learn from,
the score is the share of class 1 among those there are, or 0.5. Labels without a quality, and of ids without a
document, teach nothing; repeated labels count as often as they come. Repeated rows get equal scores; an empty table
gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .features import char_grams, fold, points, word_hashes

BITS, SIZES, DIM = 17, (3, 4), 16
SAMPLE, EPOCHS, RATE = 4000, 5, 0.5


def buckets(text: str | None) -> np.ndarray:
    """The buckets of all features of a text: words, pairs of neighbouring words, character n-grams."""
    cp = points((text or "").lower())
    if not len(cp):
        return np.zeros(0, np.int64)
    w = word_hashes(cp)
    pairs = w[:-1] * np.uint64(3) + w[1:]
    # whether a word is the one before, and whether it came before at all: repetition in words of any language
    again = np.ones(len(w), np.uint64)
    again[np.unique(w, return_index=True)[1]] = 0
    same = (w[:-1] == w[1:]).astype(np.uint64)
    return np.concatenate((fold(w, BITS), fold(pairs, BITS), fold(same + np.uint64(0x51), BITS), fold(again + np.uint64(0x61), BITS), char_grams(cp, SIZES, BITS)))


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        at, share = [], []
        for t in b.column(1).to_pylist():
            counts = np.bincount(buckets(t), minlength=1 << BITS)
            i = np.nonzero(counts)[0]
            at.append(i.astype(np.int32).tobytes())
            share.append((counts[i] / max(1, counts.sum())).astype(np.float32).tobytes())
        yield pa.record_batch([b.column(0), pa.array(at, pa.binary()), pa.array(share, pa.binary()), b.column(2)], names=["quality", "at", "share", "h"])


@dataclass
class Model:
    per_bucket: np.ndarray  # the second class's logit less the first's
    bias: float

    def score(self, text: str | None) -> float:
        at = buckets(text)
        z = self.bias + (float(self.per_bucket[at].mean()) if len(at) else 0.0)
        return float(1 / (1 + np.exp(-np.clip(z, -60, 60))))


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], seed: int = 0) -> Model:
    """Rows are (class, buckets, their shares of the document's features)."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (1 << BITS, DIM)).astype(np.float32)
    layer, bias = np.zeros((2, DIM), np.float32), np.zeros(2, np.float32)
    steps, done = EPOCHS * len(rows), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            y, at, share = rows[i]
            rate = RATE * (1 - done / steps)
            done += 1
            hidden = share @ vectors[at]
            z = layer @ hidden + bias
            p = np.exp(z - z.max())
            g = p / p.sum()
            g[y] -= 1
            back = layer.T @ g
            layer -= rate * np.outer(g, hidden)
            bias -= rate * g
            # a feature's step is taken whole, not by its share, as each of its occurrences asks for it
            vectors[at] -= np.float32(rate) * np.minimum(share * len(at), 4.0)[:, None] * back[None, :]
    return Model((vectors @ (layer[1] - layer[0])).astype(np.float32), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from ``labels`` (``doc_id``, ``quality``), which the caller has cut down to those to learn from."""
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col("quality").cast("int").alias("quality"))
    sizes = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        z = np.log((sizes.get(1, 0) + 0.5) / (sizes.get(0, 0) + 0.5))
        return Model(np.zeros(1 << BITS, np.float32), float(z))
    rate = F.when(F.col("quality") == 1, F.lit(min(1.0, sample / 2 / sizes[1]))).otherwise(F.lit(min(1.0, sample / 2 / sizes[0])))
    # equal ids are drawn together: of more than twice the sample, those of least hash count, whatever their order
    drawn = known.withColumn("h", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 52))).filter(F.col("h") / float(1 << 52) < rate).orderBy("h", "quality", "doc_id").limit(2 * sample)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).filter(F.col("text").isNotNull())
    rows = texts.join(F.broadcast(drawn), "doc_id").select("quality", "text", "h")  # at most 2 * sample labels
    got = rows.mapInArrow(_vectors, "quality int, at binary, share binary, h bigint").orderBy("h", "quality", "at", "share").limit(2 * sample).toArrow()
    found = sorted(zip(*(got[c].to_pylist() for c in ("quality", "at", "share")), strict=True))  # the order of arrival doesn't matter
    if len({r[0] for r in found}) < 2:
        return Model(np.zeros(1 << BITS, np.float32), 0.0)
    return train([(a, np.frombuffer(b, np.int32), np.frombuffer(c, np.float32)) for a, b, c in found])


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` and ``score``, the probability of class 1, for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a number per bucket

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            yield pa.record_batch([b.column(0), pa.array([m.score(t) for t in b.column(1).to_pylist()], pa.float64())], names=["doc_id", "score"])

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(score, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")
