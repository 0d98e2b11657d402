"""Repeated strings: names that collide, many copies under one id, long texts."""

import random
import time
from collections import Counter

import numpy as np

from ledgerlark.llm import repeats

DOCS = "doc_id long, text string"


def removed_by(texts, length):
    """Removed bytes of each text, by counting every window."""
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        hit = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                hit[i:i + length] = True
        out.append(int(hit.sum()))
    return out


def test_texts_alike_to_every_polynomial_modulo_2_64(spark):
    """A Thue-Morse word and its complement have one value modulo 2^64 at any odd place."""
    bits = [bin(k).count("1") % 2 for k in range(2048)]
    one, other = ("".join("ab"[b ^ flip] for b in bits) for flip in (0, 1))
    for place in (3, 0xB5297A4D3F84D5A5):
        values = [sum(ord(c) * pow(place, k, 1 << 64) for k, c in enumerate(t)) % (1 << 64)
                  for t in (one, other)]
        assert values[0] == values[1]
    df = spark.createDataFrame([(1, one), (2, other)], DOCS)
    got = repeats.repeat_digests(repeats.without_repeats(df, 2048)).collect()
    assert [r.n_removed for r in got] == [0, 0]
    twice = spark.createDataFrame([(1, one), (2, one), (3, other)], DOCS)
    got = repeats.repeat_digests(repeats.without_repeats(twice, 2048)).collect()
    assert sorted((r.doc_id, r.n_removed) for r in got) == [(1, 2048), (2, 2048), (3, 0)]


def test_strong_names_tell_shapes_and_strings_apart():
    data = np.frombuffer(b"abcabcabd", np.uint8)
    names = repeats.Strong(data, repeats.drawn_places())
    a, b = names.of(np.array([0, 3, 6]), 3)
    assert a[0] == a[1] and b[0] == b[1] and (a[0], b[0]) != (a[2], b[2])
    c, _ = names.of(np.array([0, 3]), 3, np.array([1, 2]))
    assert c[0] != c[1] and c[0] != a[0]


def test_a_thousand_rows_of_one_text_without_an_id(spark):
    text = " ".join(random.Random(1).choices([f"w{k}" for k in range(500)], k=600))
    df = spark.createDataFrame([(None, text)] * 1000 + [(7, "x" + text[:900])], DOCS).repartition(4)
    start = time.time()
    got = repeats.repeat_digests(repeats.without_repeats(df)).collect()
    assert sorted((r.doc_id or 0, r.n_removed, r.n_spans) for r in got) == [
        (0, len(text), 1)] * 1000 + [(7, 900, 1)]
    assert time.time() - start < 60


def test_rows_of_one_id_with_other_texts(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choices([f"w{k}" for k in range(300)], k=300)) for _ in range(5)]
    texts += ["short", None, texts[0][:700], texts[1] + "y"]
    df = spark.createDataFrame([(1, t) for t in texts], DOCS).repartition(3)
    got = repeats.repeat_digests(repeats.without_repeats(df)).collect()
    want = removed_by([(t or "").encode() for t in texts], 400)
    assert sorted((r.n_bytes, r.n_removed) for r in got) == sorted(
        (len((t or "").encode()), w) for t, w in zip(texts, want))


def test_texts_above_one_piece(spark):
    """Passages that lie over the cuts between pieces, at other offsets elsewhere."""
    rng = random.Random(3)
    long = rng.randbytes(2 * repeats.PIECE + 3000).hex().encode()[:2 * repeats.PIECE + 3000]
    cut = repeats.PIECE
    texts = [long, long[cut - 900:cut + 500], b"q" * 50 + long[2 * cut - 401:2 * cut + 1],
             long[:399], long[cut:cut + 400] + b"z"]
    df = spark.createDataFrame([(k, t.decode()) for k, t in enumerate(texts)], DOCS)
    got = repeats.repeat_digests(repeats.without_repeats(df)).collect()
    assert [r.n_removed for r in sorted(got)] == removed_by(texts, 400)
