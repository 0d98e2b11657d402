"""Which blocks are multiplied, in which numbers, and what is found in them."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlark.llm import hard_negatives as mining
from test_hard_negatives import ROWS, brute_force


def vectors(rng, n, dim, scale=256):
    x = rng.normal(size=(n, dim))
    return np.floor(scale * x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.int64)


def table(labels, rows):
    return pa.table({"id": np.arange(len(rows)), "label": pa.array(labels, pa.int64()),
                     "v": pa.array(rows.tolist(), pa.list_(pa.int64())),
                     "dim": pa.array([rows.shape[1]] * len(rows), pa.int32())})


def columns(batches):
    return np.concatenate([np.stack([c.to_numpy() for c in b.columns], axis=1) for b in batches])


def test_pairs_are_multiplied_once_and_in_floats(monkeypatch):
    rng = np.random.default_rng(4)
    rows = table(rng.integers(0, 10, 3000), vectors(rng, 3000, 64))
    anchors = mining.Slice(rows.filter(pa.array(np.arange(3000) % 10 == 0)))
    whole, seen = mining.strassen, []

    def counted(a, b):
        if a.shape[1] == 64:  # not a half
            seen.append((a.shape[0] * b.shape[1], a.dtype, b.dtype))
        return whole(a, b)

    monkeypatch.setattr(mining, "strassen", counted)
    positives = columns(mining._positives(anchors, 5)(iter(rows.to_batches())))
    mined = columns(mining._negatives(anchors, mining.Windows(positives, 50, 95), 3)(
        iter(rows.to_batches())))
    assert len(positives) == 5 * 300 and len(mined)
    # Pairs of one label in the first pass, the others and what their tiles hold in the second.
    assert sum(n for n, _, _ in seen) < 1.15 * 300 * 3000
    assert {t for _, *types in seen for t in types} == {np.dtype(np.float32)}


@pytest.mark.parametrize("scale, kind", [
    (256, np.float32), (1150, np.float32), (1250, np.float64), (27_000_000, np.float64),
    (28_000_000, np.int64), (2**40, np.int64)])
def test_blocks_are_exact_in_the_narrowest_numbers(scale, kind):
    rng = np.random.default_rng(scale)
    a, b = vectors(rng, 70, 64, scale), vectors(rng, 90, 64, scale)
    got = mining.block(mining.Vectors(a), slice(0, 66), mining.Vectors(b), slice(7, 90))
    exact = np.clip(a[:66].astype(object) @ b[7:].T.astype(object), -2**63 + 1, 2**63 - 1)
    assert got.dtype == kind and (got.astype(np.int64) == exact).all()


def mixed_rows(case):
    rng = random.Random(case)
    out = []
    for k in range(260):
        label = {"few": k % 3, "many": rng.randrange(120), "one": 1}.get(case, rng.randrange(5))
        size = {"rising": 1 + k / 50, "wide": 10.0 ** rng.choice([0, 0, 3, 6])}.get(case, 1)
        v = [size * (0.4 + rng.gauss(0, 0.5)) for _ in range(5)]
        out.append((k if case != "shared" else k // 4, [1.0, 0.5] if case == "same" else v, label))
    return out


@pytest.mark.parametrize("case", ["few", "many", "one", "rising", "wide", "same", "shared"])
@pytest.mark.parametrize("dense", [2, 10**9])
def test_small_tiles_equal_brute_force(case, dense, monkeypatch):
    rows = mixed_rows(case)
    for name, value in {"TILE": 32, "ANCHOR_TILE": 8, "NARROW": 4, "LEAF": 2, "DENSE": dense,
                        "FEW_RUNS": 2, "WAITING": 20}.items():
        monkeypatch.setattr(mining, name, value)
    kept = sorted({(i, label, tuple(min(max(int(np.floor(256 * x)), -2**63), 2**63 - 1) for x in v))
                   for i, v, label in rows}, key=lambda r: (r[2], r))
    ids, labels = (pa.array([r[c] for r in kept], pa.int64()) for c in (0, 1))
    v = pa.array([list(r[2]) for r in kept], pa.list_(pa.int64()))
    whole = pa.table({"id": ids, "label": labels, "v": v,
                      "dim": pa.array([len(r[2]) for r in kept], pa.int32())})
    anchors = mining.Slice(whole.filter(pa.array(ids.to_numpy() % 3 == 0)))

    def best(found, k):
        top = {}
        for *key, name, score in found.tolist():
            bests = top.setdefault(tuple(key), {})
            bests[name] = max(score, bests.get(name, score))
        return [(*key, rank, *pair) for key, bests in top.items() for rank, pair in enumerate(
            sorted(bests.items(), key=lambda p: (-p[1], p[0]))[:k], 1)]

    def tasks(run):  # two tasks, the second one with small batches
        half = whole.num_rows // 2
        return np.concatenate([columns(run(iter(whole[:half].to_batches()))),
                               columns(run(iter(whole[half:].to_batches(max_chunksize=30))))])

    positives = np.array([(a, p, s) for a, _, p, s in best(tasks(mining._positives(anchors, 5)), 5)])
    mined = tasks(mining._negatives(anchors, mining.Windows(positives, 50, 95), 3))
    got = [(a, p, rank, n, ps, s) for a, p, ps, rank, n, s in best(mined, 3)]
    assert sorted(got) == brute_force(rows, lambda i: i % 3 == 0)


def test_wide_vectors_through_spark(spark):
    rng = np.random.default_rng(8)
    rows = []
    for k in range(150):
        size = float(rng.choice([1, 1, 1, 300, 10**6]))
        rows.append((k, (size * (rng.normal(size=70) * 0.2 + 0.3)).tolist(), int(k % 4)))
    got = mining.hard_negatives(spark.createDataFrame(rows, ROWS).repartition(3), F.col("id") % 5 == 0)
    assert sorted(map(tuple, got.collect())) == brute_force(rows, lambda i: i % 5 == 0)
