"""Products, heaps and mined negatives against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlark.llm import hard_negatives as mining

ROWS = "vec_id long, embedding array<double>, label int"


@pytest.mark.parametrize("shape", [(1, 1, 1), (33, 65, 70), (64, 64, 64), (100, 37, 129)])
def test_strassen_is_exact(shape):
    rng = np.random.default_rng(sum(shape))
    m, k, n = shape
    a, b = rng.integers(-2**25, 2**25, (m, k)), rng.integers(-2**25, 2**25, (k, n))
    assert (mining.strassen(a, b) == a @ b).all()
    big = a.astype(object) << 60
    assert (mining.strassen(big, b.astype(object)) == big @ b.astype(object)).all()


def test_products_beyond_64_bits_are_clipped():
    a = np.array([[2**62, 2**62], [1, 0]])
    got = mining.products(a, np.array([[4, 4], [-4, -4], [-3, 3]]))
    assert got.tolist() == [[2**63 - 1, -2**63 + 1, 0], [4, -4, -3]]


def brute_force(rows, anchor, positives=5, negatives=3):
    kept = {(i, label, tuple(min(max(math.floor(256 * x), -2**63), 2**63 - 1) for x in v))
            for i, v, label in rows if i is not None and label is not None and v is not None
            and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for name in sorted({i for i, _, _ in kept if anchor(i)}):
        mine = [(label, v) for i, label, v in kept if i == name and v]
        pairs = [(sum(x * y for x, y in zip(v, w)), i, label == own)
                 for own, v in mine for i, label, w in kept if i != name and len(w) == len(v)]

        def best(found, k):
            top = {}
            for s, i in found:
                top[i] = max(s, top.get(i, s))
            return sorted(top.items(), key=lambda t: (-t[1], t[0]))[:k]

        for p, ps in best([(s, i) for s, i, same in pairs if same], positives):
            window = [(s, i) for s, i, same in pairs
                      if not same and 50 * ps <= 100 * s <= 95 * ps]
            out += [(name, p, rank, i, ps, s)
                    for rank, (i, s) in enumerate(best(window, negatives), 1)]
    return sorted(out)


@pytest.fixture
def rows():
    rng = random.Random(9)
    centres = [[rng.gauss(0, 1) for _ in range(5)] for _ in range(4)]
    out = []
    for k in range(400):
        label = rng.randrange(4)
        out.append((k, [round(c + rng.gauss(0, 0.7), 1) for c in centres[label]],
                    rng.choice([label, label, 0])))
    out += [(500 + k, [1.0, 2.0, 0.5], k % 2) for k in range(12)]  # another dimension, ties
    out += [(None, [1.0] * 5, 1), (600, None, 1), (601, [1.0, None, 1.0, 1.0, 1.0], 1),
            (602, [float("nan")] * 5, 1), (603, [float("inf")] + [0.0] * 4, 0), (604, [1.0] * 5, None),
            (605, [], 1), (10, out[10][1], out[10][2])]  # a repeated row
    out += [(700, [rng.gauss(1, 1) for _ in range(5)], k % 3) for k in range(9)]  # one id, many rows
    return out


def test_negatives_equal_brute_force(spark, rows, monkeypatch):
    monkeypatch.setattr(mining, "SLICE_BYTES", 700)
    df = spark.createDataFrame(rows, ROWS).repartition(3).withColumns(
        {"id": F.lit("clash"), "dim": F.lit(1), "v": F.lit(2)})
    got = mining.hard_negatives(df, F.col("id") % 10 == 0)
    assert sorted(map(tuple, got.collect())) == brute_force(rows, lambda i: i % 10 == 0)


def test_small_tiles_and_equal_scores(spark, monkeypatch):
    same = [(k, [1.0, 1.0], k % 3) for k in range(60)] + [(k, [0.8, 0.8], k % 3) for k in range(60, 90)]
    df = spark.createDataFrame(same, ROWS).repartition(2)
    got = mining.hard_negatives(df, F.col("id") % 7 == 0)
    assert sorted(map(tuple, got.collect())) == brute_force(same, lambda i: i % 7 == 0)


def test_empty_tables_and_no_anchor(spark):
    empty = spark.createDataFrame([], ROWS)
    assert mining.hard_negatives(empty, F.col("id") % 50 == 0).count() == 0
    one = spark.createDataFrame([(7, [1.0], 1), (50, [1.0], 1)], ROWS)
    assert mining.hard_negatives(one, F.col("id") % 50 == 0).count() == 0
    assert mining.hard_negatives(one, F.col("id") < 0).count() == 0


def test_heaps_merge_in_any_order():
    rng = np.random.default_rng(2)
    scores, ids = rng.integers(0, 20, (7, 300)), np.arange(300)
    whole = mining.Heaps(7, 5)
    whole.add(np.arange(7), scores, ids)
    parts = mining.Heaps(7, 5)
    for at in (200, 0, 100):
        parts.add(np.arange(7), scores[:, at:at + 100], ids[at:at + 100])
    assert (whole.id == parts.id).all() and (whole.score == parts.score).all()
    assert whole.id[:5].tolist() == np.lexsort((ids, -scores[0]))[:5].tolist()
