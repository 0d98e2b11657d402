"""The queries of the trained models against plain twins, over whole small tables."""

import hashlib
import math
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from ledgerlark.llm import language, quality, queries, toxicity
from tests.conftest import SF_SMALL

ODD, WORD = 0x9E3779B97F4A7C15, (1 << 64) - 1


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def labels(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}


def fold(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds


def drawn(ids):
    """Ids in the order of their hashes as signed numbers."""
    def key(i):
        return struct.unpack("<q", struct.pack("<Q", xxhash.xxh64_intdigest(struct.pack("<q", i), 42)))[0]
    return sorted(ids, key=lambda i: (key(i), i))


def test_language_query_against_plain_profiles(spark, docs):
    def grams(text):
        for word in "".join(c if c.isalpha() else " " for c in (text or "").lower()).split():
            padded = f" {word} "
            yield from word
            yield from (padded[k:k + 2] for k in range(len(padded) - 1))
            yield from (padded[k:k + 3] for k in range(len(padded) - 2))

    def profile(counts):
        return sorted(counts, key=lambda g: (-counts[g], len(g), g))[:language.PROFILE]

    counted = {}
    for i, d in docs.items():
        if fold(i, 3) != 1 and d.lang is not None:
            counted.setdefault(d.lang, Counter()).update(grams(d.text))
    ranks = {lang: {g: k for k, g in enumerate(profile(c))} for lang, c in counted.items()}
    out = queries.op5_language(spark, SF_SMALL).collect()
    assert len(out) == len(docs) and {fold(r.doc_id, 3) == 1 for r in out} == {True, False}
    for r in out:
        own = profile(Counter(grams(docs[r.doc_id].text)))
        apart = {lang: sum(abs(at[g] - k) if g in at else language.PROFILE for k, g in enumerate(own))
                 for lang, at in ranks.items()}
        best = min(apart, key=lambda lang: (apart[lang], lang)) if own else "und"
        score = 1 - apart[best] / (language.PROFILE * len(own)) if own else 0.0
        assert (r.held_out, r.lang_pred) == (fold(r.doc_id, 3) == 1, best)
        assert r.score == pytest.approx(score, abs=1e-12)


def test_quality_query_against_plain_descent(spark, docs, labels):
    def scatter(x):
        for _ in range(2):
            x = (x ^ x >> 32) * 0xD6E8FEB86659FD93 & WORD
        return x ^ x >> 32

    def bucket(x):
        return (x * ODD & WORD) >> 64 - quality.BITS

    def features(text):
        code = (text or "").encode()
        words = code.split()
        mine = [bucket(xxhash.xxh3_64_intdigest(w)) for w in words]
        mine += [scatter(17) >> 64 - quality.BITS for a, b in zip(words, words[1:]) if a == b]
        parts = [bucket(int.from_bytes(bytes([n]) + code[k:k + n], "big"))
                 for n in quality.GRAMS for k in range(len(code) - n + 1)]
        return [f for f in (mine, parts) if f]

    def vector(text):
        total = np.zeros(quality.BUCKETS)
        for found in features(text):
            for b, n in Counter(found).items():
                total[b] += n / len(found)
        return total

    known = drawn(i for i, r in labels.items() if i in docs and r.quality in (0, 1) and fold(i, 3) != 1)
    vectors = [vector(docs[i].text) for i in known]
    rng = np.random.default_rng(7)
    table = rng.uniform(-1 / quality.DIMENSIONS, 1 / quality.DIMENSIONS,
                        (quality.BUCKETS, quality.DIMENSIONS))
    output, bias = np.zeros((2, quality.DIMENSIONS)), np.zeros(2)
    done, steps = 0, quality.EPOCHS * len(known)
    for _ in range(quality.EPOCHS):
        for k in rng.permutation(len(known)):
            step = quality.RATE * (1 - done / steps)
            done += 1
            hidden = vectors[k] @ table
            odds = np.exp(output @ hidden + bias)
            error = (np.arange(2) == labels[known[k]].quality) - odds / odds.sum()
            back = error @ output
            output = output + step * np.outer(error, hidden)
            bias = bias + step * 0.1 * error
            table = table + 0.5 * step * np.outer(vectors[k] / (vectors[k] @ vectors[k]), back)
    row, base = table @ (output[1] - output[0]), bias[1] - bias[0]
    out = queries.op4_quality(spark, SF_SMALL).collect()
    assert len(out) == len(docs)
    for r in out:
        logit = base + sum(np.mean([row[b] for b in f]) for f in features(docs[r.doc_id].text))
        score = 1 / (1 + math.exp(-logit))
        assert r.held_out == (fold(r.doc_id, 3) == 1)
        assert r.score == pytest.approx(score, abs=1e-5)
        assert abs(score - 0.5) < 1e-5 or r.predicted == int(score >= 0.5)


def test_toxicity_query_against_plain_risk(spark, docs, labels):
    def words(text):
        found = set()
        every = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())
        begun = Counter(w[:n] for w in every for n in toxicity.PREFIXES if len(w) > n)
        found |= {b"%d^%s" % (s, start) for start, n in begun.items() for s in toxicity.SHARES
                  if n >= toxicity.REPEATS and n / len(every) >= 1 / 2**s}
        for w in every:
            long = len(w) > toxicity.WORD_BYTES
            found.add(b"#" + hashlib.blake2b(w, digest_size=16).digest() if long else w)
            found |= {b"^" + w[:n] for n in toxicity.PREFIXES if len(w) > n}
        return found

    def sigmoid(x):
        return 1 / (1 + math.exp(-min(30, max(-30, x))))

    sets = {i: words(d.text) for i, d in docs.items()}
    toxic = drawn(i for i, r in labels.items() if i in docs and r.toxic == 1 and fold(i, 5) != 0)
    met = Counter(w for i in toxic for w in sets[i])
    # The share of toxic documents, from the words met the most in toxic text alone.
    common = [w for w, n in met.items() if n >= max(2, len(toxic) / 10)]
    n_all = {w: sum(w in s for s in sets.values()) for w in common}
    least = sorted(common, key=lambda w: (n_all[w] / met[w], w))[:toxicity.PRIOR_WORDS]
    prior = sum(n_all[w] for w in least) / len(docs) * len(toxic) / sum(met[w] for w in least)
    prior = min(0.5, max(prior, 1 / len(docs)))

    theta, squares = dict.fromkeys([*met, None], 0.0), dict.fromkeys([*met, None], 0.0)
    theta[None] = math.log(prior / (1 - prior))  # None: the bias
    known = {i: [w for w in s if w in met] for i, s in sets.items()}

    def slope(ids, sign):
        loss, grad = 0.0, Counter()
        for i in ids:
            g = sum(theta[w] for w in known[i]) + theta[None]
            loss += math.log1p(math.exp(-sign * g)) / len(ids)
            for w in [*known[i], None]:
                grad[w] -= sign * sigmoid(-sign * g) / len(ids)
        return loss, grad

    rng, everyone, step = np.random.default_rng(7), drawn(docs), 0
    steps = toxicity.EPOCHS * math.ceil(len(everyone) / toxicity.BATCH)
    for _ in range(toxicity.EPOCHS):
        order = rng.permutation(len(everyone))
        for start in range(0, len(order), toxicity.BATCH):
            batch = [everyone[k] for k in order[start:start + toxicity.BATCH]]
            some = [toxic[k] for k in rng.integers(0, len(toxic), min(toxicity.BATCH, len(toxic)))]
            (_, up), (alarm, down), (overall, clean) = slope(some, 1), slope(some, -1), slope(batch, -1)
            whole = overall - prior * alarm >= 0
            for w in theta:
                grad = prior * up[w] + (clean[w] - prior * down[w] if whole else 0)
                squares[w] += grad * grad
                rate = toxicity.RATE * (1 - step / steps) / math.sqrt(squares[w] + 1e-8)
                theta[w] -= rate * grad
                if w is not None:
                    theta[w] = max(0.0, theta[w] - rate * toxicity.SPARSITY)
            step += 1

    # Every threshold between two bins of sums, and the widest gap of those near the least risk.
    sums = {i: sum(theta[w] for w in known[i]) for i in docs}
    bins = sorted({int(v // toxicity.BIN) for v in sums.values()})
    gaps = []
    for low, high in zip(bins, bins[1:]):
        below = max(v for v in sums.values() if int(v // toxicity.BIN) <= low)
        above = min(v for v in sums.values() if int(v // toxicity.BIN) >= high)
        missed = sum(sums[i] <= below for i in toxic) / len(toxic)
        flagged = sum(v >= above for v in sums.values()) / len(docs)
        gaps.append((prior * missed + max(0, flagged - prior * (1 - missed)), above - below, below + above))
    near = [g for g in gaps if g[0] <= min(gaps)[0] + prior / 10]
    bias = -max(near, key=lambda g: g[1])[2] / 2

    out = queries.op8_toxicity(spark, SF_SMALL).collect()
    assert len(out) == len(docs) and any(r.predicted for r in out)
    for r in out:
        score = sigmoid(sums[r.doc_id] + bias)
        assert r.held_out == (fold(r.doc_id, 5) == 0)
        assert r.score == pytest.approx(score, abs=1e-6)
        assert r.predicted == int(score >= 0.5)
