"""Toxicity scores by non-negative positive-unlabelled learning.

Confirmed toxic documents are the only labelled examples; all other text is unlabelled.
With the share ``prior`` of toxic documents among all, the risk of a classifier g is
    prior * E_toxic[loss(g)] + max(0, E_unlabelled[loss(-g)] - prior * E_toxic[loss(-g)]),
where the second term estimates the risk on clean documents without any.  Where a batch
puts it below zero (a sign of over-fitting), it has no part in the step.

g adds up weights, none below zero, of the words and word beginnings present, of all
those in the toxic documents drawn (a word of over WORD_BYTES bytes goes by its digest),
and of the shares that beginnings reach: one that any text may hold by chance still tells
toxic text by how many of its words begin so.
It is trained in numpy on at most ``sample`` toxic and ``2 * sample`` unlabelled
documents, those of the smallest id hashes.  The prior is a parameter.  If none is given
it is estimated from word counts over all documents: a word met in toxic text only is as
much rarer among all documents as toxic documents are, and any other word is less so; the
PRIOR_WORDS words of the smallest ratio, of those in a tenth of the toxic documents, are
pooled.  The threshold comes from a histogram of the scores of all documents.

Defined cases: null and empty texts hold no word and get the score of the bias;
contradicting labels count by majority (ties: left out); repeated rows are scored each;
without toxic examples every score is 0; other columns are never read.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import chunks, fold, stash
from ledgerlark.llm.decontam import words_of
from ledgerlark.llm.quality import votes

SAMPLE = 3000
WORD_BYTES = 48
PREFIXES = (4, 5, 6)
SHARES = (7, 6, 5, 4)  # a beginning of one word in 128, 64, 32, 16
REPEATS = 2  # words that a share needs at least
EPOCHS = 40
BATCH = 256
RATE = 0.3
SPARSITY = 0.001
PRIOR_WORDS = 5
BINS, BIN = 10_000, 0.01


def word_set(text: bytes | None, starts: set[bytes] | None = None) -> set[bytes]:
    """Words, and their first PREFIXES bytes behind a mark; long words by their digest.  A
    beginning of REPEATS words is marked once more with each of SHARES that it reaches, those
    in ``starts`` only if given (as ``share_starts`` gives them)."""
    counts = Counter(words_of(text))
    found = {w if len(w) <= WORD_BYTES else b"#" + hashlib.blake2b(w, digest_size=16).digest()
             for w in counts}
    found.update(*({b"^" + w[:n] for w in counts if len(w) > n} for n in PREFIXES))
    met = Counter()
    for word in counts if starts is None else [w for w in counts if w[:PREFIXES[0]] in starts]:
        for size in PREFIXES:
            if len(word) > size:
                met[word[:size]] += counts[word]
    total = counts.total()
    for start, n in met.items():
        if n >= REPEATS:
            found.update(b"%d^%s" % (share, start) for share in SHARES if n << share >= total)
    return found


def share_starts(names: Iterable[bytes]) -> set[bytes]:
    """The first bytes of the beginnings of which a share is among ``names``."""
    return {name.split(b"^")[1][:PREFIXES[0]] for name in names if b"^" in name[1:]}


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(toxic: list[np.ndarray], unlabelled: list[np.ndarray], size: int, prior: float,
          epochs: int = EPOCHS, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights and bias from the word numbers of each document (AdaGrad steps with
    soft thresholds, logistic loss)."""
    rng = np.random.default_rng(seed)
    theta = np.zeros(size + 1)
    theta[size] = np.log(prior / (1 - prior))
    squares = np.zeros(size + 1)
    steps, step = epochs * -(-len(unlabelled) // BATCH), 0

    def slope(docs: list[np.ndarray], sign: float) -> tuple[float, np.ndarray]:
        """Mean loss(sign * g) over documents, and its gradient."""
        lengths = np.array([len(d) for d in docs])
        flat = np.concatenate(docs) if docs else np.empty(0, np.int64)
        owner = np.repeat(np.arange(len(docs)), lengths)
        g = np.bincount(owner, theta[flat], minlength=len(docs)) + theta[size]
        back = -sign * sigmoid(-sign * g) / len(docs)
        grad = np.bincount(flat, back[owner], minlength=size + 1)
        grad[size] += back.sum()
        return float(np.logaddexp(0, -sign * g).mean()), grad

    for _ in range(epochs):
        order = rng.permutation(len(unlabelled))
        for start in range(0, len(order), BATCH):
            background = [unlabelled[k] for k in order[start:start + BATCH]]
            positive = [toxic[k] for k in rng.integers(0, len(toxic), min(BATCH, len(toxic)))]
            _, as_toxic = slope(positive, 1.0)
            false_alarm, as_clean = slope(positive, -1.0)
            overall, all_clean = slope(background, -1.0)
            if overall - prior * false_alarm >= 0:
                grad = prior * as_toxic + all_clean - prior * as_clean
            else:
                grad = prior * as_toxic
            squares += grad**2
            rate = RATE * (1 - step / steps) / np.sqrt(squares + 1e-8)
            step += 1
            theta -= rate * grad
            # Words that tell little are drawn to zero, and none excuses another.
            theta[:size] = np.maximum(theta[:size] - rate[:size] * SPARSITY, 0)
    return theta[:size], float(theta[size])


def estimate_prior(rows: DataFrame, met: dict[bytes, int], n_toxic: int) -> float:
    """Share of toxic documents among all ``rows``; ``met``: in how many of ``n_toxic`` toxic
    documents each word is."""
    common = {w for w, n in met.items() if n >= max(2, n_toxic / 10)}
    shared = rows.sparkSession.sparkContext.broadcast((common, share_starts(common)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter()
        wanted, starts = shared.value
        for batch in batches:
            for _, texts in chunks(batch, "text"):
                counts[b""] += len(texts)  # no word
                for t in texts:
                    counts.update(word_set(t, starts) & wanted)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
            names=["word", "n"])

    n_all = {bytes(r.word): r.n for r in rows.mapInArrow(run, "word binary, n long").groupBy(
        "word").agg(F.sum("n").alias("n")).collect()}
    total = n_all.pop(b"")
    least = sorted((w for w in common if w in n_all), key=lambda w: (n_all[w] / met[w], w))[:PRIOR_WORDS]
    if not least:
        return min(0.5, n_toxic / total)
    share = sum(n_all[w] for w in least) / total
    return float(np.clip(share / (sum(met[w] for w in least) / n_toxic), min(1 / total, 0.5), 0.5))


def calibrate(bias: float, toxic: np.ndarray, scored: DataFrame, prior: float) -> float:
    """The bias that puts the score 0.5 where the same risk, with errors counted instead
    of the loss, is least: in the widest gap of those within a tenth of the prior.
    ``toxic``: sums of weights of the examples; ``scored``: ``total`` of all documents."""
    place = F.least(F.floor(F.col("total") / BIN), F.lit(BINS)).cast("long")
    bins = {r.place: [r.n, r.low, r.high, 0] for r in scored.groupBy(place.alias("place")).agg(
        F.count("*").alias("n"), F.min("total").alias("low"), F.max("total").alias("high")).collect()}
    for value in toxic:
        one = bins.setdefault(min(int(value // BIN), BINS), [0, value, value, 0])
        one[1:] = min(one[1], value), max(one[2], value), one[3] + 1
    if len(bins) < 2:
        return bias
    n, low, high, n_toxic = np.array([bins[k] for k in sorted(bins)], float).T
    missed = np.cumsum(n_toxic)[:-1] / len(toxic)
    flagged = 1 - np.cumsum(n)[:-1] / n.sum()
    risk = prior * missed + np.maximum(0, flagged - prior * (1 - missed))
    near = np.flatnonzero(risk <= risk.min() + prior / 10)
    best = near[np.argmax((low[1:] - high[:-1])[near])]
    return -float(low[best + 1] + high[best]) / 2


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, texts in chunks(batch, "text"):
            counts = Counter(w for t in texts for w in word_set(t))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
                names=["word", "n"])


def _numbers(vocabulary: dict[bytes, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in chunks(batch, "text"):
                found = [sorted(vocabulary[w] for w in word_set(t) if w in vocabulary)
                         for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(found, pa.list_(pa.int32()))],
                    names=["doc_id", "words"])

    return run


class Model:
    def __init__(self, weights: dict[bytes, float], bias: float, prior: float = 0.0,
                 examples: np.ndarray | None = None):
        """examples: sums of weights of the toxic documents drawn."""
        self.weights, self.bias, self.prior, self.examples = weights, bias, prior, examples
        self.starts = share_starts(weights)

    def total(self, text: bytes | None) -> float:
        weight = self.weights.get
        return float(sum(weight(w, 0.0) for w in word_set(text, self.starts)))


def fit(docs: DataFrame, toxic: DataFrame, prior: float | None, sample: int = SAMPLE) -> Model:
    """Fit from ``docs`` (doc_id, text) and the ids ``toxic`` (_id)."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    # At most `sample` ids: small enough to broadcast, so that no text is shuffled.
    toxic = toxic.distinct().orderBy(F.xxhash64("_id"), "_id").limit(sample)
    positive = rows.join(F.broadcast(toxic), F.col("doc_id") == F.col("_id"), "left_semi")
    top = positive.mapInArrow(_count_words, "word binary, n long").groupBy("word").agg(
        F.sum("n").alias("n")).orderBy(F.desc("n"), "word").collect()
    if not top:
        return Model({}, -np.inf)
    vocabulary = {bytes(r.word): k for k, r in enumerate(top)}

    def drawn(ids: DataFrame, count: int) -> list[np.ndarray]:
        """Word numbers of the ``count`` documents with the smallest id hashes."""
        chosen = ids.select(F.col("doc_id").alias("_id")).distinct().orderBy(
            F.xxhash64("_id"), "_id").limit(count)
        some = rows.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"), "left_semi")
        found = some.mapInArrow(_numbers(vocabulary), "doc_id long, words array<int>").orderBy(
            F.xxhash64("doc_id"), "doc_id", "words").limit(count)
        return [np.array(r.words, np.int64) for r in found.collect()]

    examples = drawn(toxic.select(F.col("_id").alias("doc_id")), sample)
    background = drawn(docs.select("doc_id").where("doc_id IS NOT NULL"), 2 * sample)
    if not examples or not background:
        return Model({}, -np.inf)
    if prior is None:
        met = np.bincount(np.concatenate(examples), minlength=len(vocabulary))
        prior = estimate_prior(rows, {w: int(met[k]) for w, k in vocabulary.items()}, len(examples))
    theta, bias = train(examples, background, len(vocabulary), prior)
    return Model({w: float(theta[k]) for w, k in vocabulary.items() if theta[k]}, bias, prior,
                 np.array([theta[d].sum() for d in examples]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row, from its text and the threshold over all rows."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    if model.examples is None:
        return rows.select("doc_id", F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in chunks(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0),
                     pa.array([shared.value.total(t) for t in texts], pa.float64())],
                    names=["doc_id", "total"])

    scored = stash(rows.mapInArrow(run, "doc_id long, total double"), "totals")
    bias = calibrate(model.bias, model.examples, scored, model.prior)
    g = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.col("total") + bias))
    return scored.select("doc_id", (1 / (1 + F.exp(-g))).alias("score"))


def toxicity(docs: DataFrame, labels: DataFrame, prior: float | None = None,
             sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted; labels of held-out ids are never read."""
    marked = votes(labels, "toxic", fold("doc_id", 5) != 0)
    model = fit(docs, marked.where("label = 1").select("_id"), prior, sample)
    return score(docs, model).select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
