"""Quality scores from supervised subword embeddings.

A document's features are its words, the repetition of a word straight after itself,
and its byte n-grams of 2 to 4, hashed into BUCKETS rows of a learned embedding table.
The document vector is the mean of its word rows plus the mean of its n-gram rows; a
softmax over the two classes follows.  Embeddings and output weights are trained
together by stochastic gradient descent in numpy.

The model is fitted on at most ``sample`` labelled documents, those with the smallest
id hashes.  After training, a row only matters through its product with the output
weights, so scoring needs one number per bucket.

Defined cases: null and empty texts have no features and get the score of the bias;
documents with contradicting labels count with their mean label (ties: left out);
repeated rows are scored each; without usable labels every score is 0.5; other columns
are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import chunks, fold
from ledgerlark.llm.words import WordHashes, mix

U = np.uint64
BITS = 15
BUCKETS = 1 << BITS
DIMENSIONS = 16
SAMPLE = 2500
EPOCHS = 5
RATE = 0.5
GRAMS = (2, 3, 4)
_TOP = U(64 - BITS)


def word_features(text: bytes, hashes: WordHashes) -> np.ndarray:
    """Buckets of the words, and of a mark for each word that repeats the one before."""
    word = hashes.of(text.split())
    again = mix(np.full(int((word[1:] == word[:-1]).sum()), 17, np.uint64))
    return (np.concatenate((word * U(0x9E3779B97F4A7C15), again)) >> _TOP).astype(np.int64)


def gram_features(text: bytes) -> np.ndarray:
    """Buckets of the byte n-grams."""
    code = np.frombuffer(text, np.uint8).astype(np.uint64)
    found = []
    for n in GRAMS:
        if len(code) < n:
            break
        value = np.full(len(code) - n + 1, n, np.uint64)
        for k in range(n):
            value = value << U(8) | code[k:k + len(value)]
        found.append((value * U(0x9E3779B97F4A7C15) >> _TOP).astype(np.int64))
    return np.concatenate(found) if found else np.empty(0, np.int64)


def weights_of(text: bytes | None, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a document and the weight of each in its vector."""
    total = np.zeros(BUCKETS)
    for found in (word_features(text or b"", hashes), gram_features(text or b"")):
        if len(found):
            total += np.bincount(found, minlength=BUCKETS) / len(found)
    used = np.flatnonzero(total)
    return used.astype(np.int32), total[used].astype(np.float32)


class Model:
    """``row``: logit of class 1 against 0 per bucket; ``bias``."""

    def __init__(self, row: np.ndarray, bias: float):
        self.row, self.bias = row, bias

    def score(self, text: bytes | None, hashes: WordHashes) -> float:
        logit = self.bias
        for found in (word_features(text or b"", hashes), gram_features(text or b"")):
            if len(found):
                logit += float(self.row[found].mean())
        return float(1 / (1 + np.exp(-np.clip(logit, -500, 500))))


def train(samples: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS,
          rate: float = RATE, seed: int = 7) -> Model:
    """Stochastic gradient descent over (buckets, weights, label)."""
    if len({label for _, _, label in samples}) < 2:
        return Model(np.zeros(BUCKETS), 0.0)
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS))
    output, bias = np.zeros((2, DIMENSIONS)), np.zeros(2)
    steps, done = epochs * len(samples), 0
    for _ in range(epochs):
        for k in rng.permutation(len(samples)):
            used, weight, label = samples[k]
            step = rate * (1 - done / steps)
            done += 1
            hidden = weight @ table[used]
            logits = output @ hidden + bias
            chance = np.exp(logits - logits.max())
            chance /= chance.sum()
            error = -chance
            error[label] += 1
            back = error @ output
            output += step * np.outer(error, hidden)
            bias += step * 0.1 * error
            # Weights of a mean are small: the step of a row is scaled to the vector.
            table[used] += step * np.outer(weight / max((weight @ weight), 1e-9), back) * 0.5
    return Model(table @ (output[1] - output[0]), float(bias[1] - bias[0]))


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        for rows, texts in chunks(batch, "text"):
            found = [weights_of(t, hashes) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.array([u.tobytes() for u, _ in found]),
                 pa.array([w.tobytes() for _, w in found])],
                names=["doc_id", "label", "buckets", "weights"])


def votes(labels: DataFrame, label: str, allowed: Column) -> DataFrame:
    """_id and label (0 or 1) of each id among the ``allowed`` rows, by majority."""
    return labels.where(allowed).where(F.col(label).isin(0, 1)).groupBy(
        F.col("doc_id").alias("_id")).agg(F.avg(label).alias("mean")).where(
        "mean <> 0.5").select("_id", (F.col("mean") > 0.5).cast("int").alias("label"))


def fit(docs: DataFrame, labels: DataFrame, label: str, allowed: Column,
        sample: int = SAMPLE) -> Model:
    """Fit on the ``sample`` labelled documents of smallest id hash."""
    chosen = votes(labels, label, allowed).orderBy(F.xxhash64("_id"), "_id").limit(sample)
    rows = docs.select("doc_id", F.col("text").cast("string")).join(
        F.broadcast(chosen), F.col("doc_id") == F.col("_id")  # at most `sample` ids
    ).select("doc_id", "label", "text")
    vectors = rows.mapInArrow(_vectors, "doc_id long, label int, buckets binary, weights binary")
    kept = vectors.orderBy(F.xxhash64("doc_id"), "doc_id", "buckets").limit(sample)
    return train([(np.frombuffer(r.buckets, np.int32), np.frombuffer(r.weights, np.float32),
                   r.label) for r in kept.collect()])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row, from its text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for rows, texts in chunks(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0),
                     pa.array([shared.value.score(t, hashes) for t in texts], pa.float64())],
                    names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, score double")


def quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted; labels of held-out ids are never read."""
    model = fit(docs, labels, "quality", fold("doc_id", 3) != 1, sample)
    return score(docs, model).select(
        "doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
