"""Exact top-k search by norm buckets.

Candidates are grouped by vector length: bucket b holds lengths in
[2^(b/STEPS), 2^((b+1)/STEPS)), so the number of buckets is bounded by the range of
numbers, not by the data.  Each bucket is cut into blocks of about BLOCK vectors.

A first look at the SEEDS longest vectors gives every query a score that its k-th best
reaches at least, its threshold.  A bucket whose longest vector cannot reach it is left
out for that query.  In a block, the threshold becomes a bound on the cosine for the
block's longest vector.  Where that local bound is at least COSINE, the query goes by
coordinates: at its FOCUS largest ones a vector of that cosine must lie in an interval.
Otherwise it goes by length: only vectors long enough can reach the threshold.  What is
left is verified by exact integer products.

A threshold prunes only what lies strictly below it, so ties are kept; of equal scores
the smaller vec_id comes first.  Queries are a stated set and are held against all rows
in blocks; no partner is dropped.

Defined cases: null vectors and those holding null or non-finite components take no
part; vectors of different dimension are no candidates of each other; a null vec_id
takes no part; repeated rows of one vec_id count once a distinct vector; products beyond
64 bits are clipped to their range.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.llm.common import stash

SCALE = 256
STEPS = 4
BLOCK = 4096
QUERY_BLOCK = 1024
SEEDS = 1024
COSINE = 0.6
FOCUS = 3
_EXACT = float(1 << 53)
_SLACK = 1e-9


def quantised(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id, v (longs floor(SCALE * x)), dim and norm of the vectors that take part."""
    vector = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    scaled = F.transform("x", lambda x: F.floor(x * SCALE))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return rows.select(F.col(id_col).cast("long").alias("id"), vector.alias("x")).where(
        "id IS NOT NULL AND x IS NOT NULL").where(
        F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))).select(
        "id", scaled.alias("v")).distinct().select(
        "id", "v", F.size("v").alias("dim"), norm.alias("norm"))


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact integer products; in floating point where every sum is exact there."""
    if not queries.size or not vectors.size:
        return np.zeros((len(queries), len(vectors)), np.int64)
    bound = float(np.abs(queries).max()) * float(np.abs(vectors).max()) * queries.shape[1]
    if bound < _EXACT:
        return (queries.astype(np.float64) @ vectors.T.astype(np.float64)).astype(np.int64)
    exact = queries.astype(object) @ vectors.T.astype(object)
    return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def survivors(query: np.ndarray, norm: float, threshold: float, unit: np.ndarray,
              norms: np.ndarray) -> np.ndarray:
    """Places of the vectors (by falling norm; ``unit``: scaled to length 1) that may
    reach the threshold."""
    everything = np.arange(len(norms))
    if threshold <= 0 or norm <= 0 or not len(norms):
        return everything if threshold <= 0 else everything[:0]
    local = threshold / (norm * norms[0]) - _SLACK  # least cosine, for the longest vector
    if local > 1:
        return everything[:0]
    if local < COSINE:
        return everything[:np.searchsorted(-norms, -(threshold / norm) * (1 - _SLACK), "right")]
    own = query / norm
    inside = np.ones(len(norms), bool)
    for axis in np.argsort(-np.abs(own), kind="stable")[:FOCUS]:
        reach = np.sqrt(max(0.0, 1 - own[axis] ** 2) * max(0.0, 1 - local**2)) + _SLACK
        inside &= np.abs(unit[:, axis] - own[axis] * local) <= reach + abs(own[axis]) * (1 - local)
    return everything[inside]


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best ids, ties to the smaller id; an id on several places counts
    once, by its best score."""
    order = np.lexsort((ids, -scores)) if len(np.unique(ids)) < len(ids) else None
    if order is not None:
        _, first = np.unique(ids[order], return_index=True)
        return order[np.sort(first)[:k]]
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= least)
        return near[np.lexsort((ids[near], -scores[near]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def _packed(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), dim)


def _search(k: int):
    """One block of candidates against one block of queries."""

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[int, int, int]] = []
        if left.num_rows and right.num_rows:
            dim = key[0].as_py()
            left, right = left.combine_chunks(), right.combine_chunks()
            norms = left.column("norm").to_numpy()
            order = np.argsort(-norms, kind="stable")
            norms = norms[order]
            ids = left.column("id").to_numpy()[order]
            vectors = _packed(left.column("v").chunk(0), dim)[order]
            unit = vectors / np.maximum(norms, 1e-300)[:, None]
            queries = _packed(right.column("v").chunk(0), dim)
            names = right.column("id").to_numpy()
            limits = right.column("threshold").to_numpy(zero_copy_only=False)
            lengths = right.column("norm").to_numpy()
            kept = [survivors(queries[q], lengths[q], limits[q], unit, norms)
                    for q in range(len(names))]
            whole = [q for q in range(len(names)) if 2 * len(kept[q]) > len(ids)]
            table = dict(zip(whole, products(queries[whole], vectors)))
            for q, places in enumerate(kept):
                scores = table[q][places] if q in table else products(
                    queries[q:q + 1], vectors[places])[0]
                able = (ids[places] != names[q]) & (scores >= limits[q])
                places, scores = places[able], scores[able]
                for best in _best(ids[places], scores, k):
                    found.append((int(names[q]), int(ids[places[best]]), int(scores[best])))
        columns = list(zip(*found)) or [[], [], []]
        return pa.table({n: pa.array(c, pa.int64())
                         for n, c in zip(("query_id", "vec_id", "score"), columns)})

    return run


def _thresholds(seeds: list[tuple[int, list[int]]], k: int):
    """Adds to each query the k-th best score among the seeds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_dim: dict[int, list[tuple[int, list[int]]]] = {}
        for seed in seeds:
            by_dim.setdefault(len(seed[1]), []).append(seed)
        packed = {dim: (np.array([i for i, _ in own]), np.array([v for _, v in own], np.int64))
                  for dim, own in by_dim.items()}
        for batch in batches:
            limits = []
            for query, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids, vectors = packed.get(len(vector), (np.empty(0, np.int64), None))
                others = ids != query
                # A vec_id may stand for several rows: only distinct ids make a rank.
                if len(np.unique(ids[others])) < k:
                    limits.append(-np.inf)
                    continue
                scores = products(np.array([vector], np.int64), vectors[others])[0]
                best = {}
                for i, s in zip(ids[others].tolist(), scores.tolist()):
                    best[i] = max(s, best.get(i, s))
                limits.append(sorted(best.values(), reverse=True)[k - 1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.array(limits, np.float64))],
                names=[*batch.schema.names, "threshold"])

    return run


def top_k(rows: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other vectors of each query row."""
    vectors = stash(quantised(rows), "vectors")
    bucket = F.when(F.col("norm") > 0, F.floor(F.log2("norm") * STEPS)).otherwise(-99999).cast("int")
    placed = vectors.withColumn("bucket", bucket)
    # At most one row for each dimension and power step in use: bounded by number ranges.
    sizes = placed.groupBy("dim", "bucket").agg(
        F.count("*").alias("n"), F.max("norm").alias("longest")).withColumn(
        "blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    sizes = stash(sizes.coalesce(1), "sizes")
    seeds = [(r.id, r.v) for r in vectors.orderBy(F.desc("norm"), "id").limit(SEEDS).collect()]
    queries = vectors.where(is_query)
    ddl = "id long, v array<long>, dim int, norm double"
    queries = stash(queries.mapInArrow(_thresholds(seeds, k), f"{ddl}, threshold double"), "queries")
    parts = max(1, -(-queries.count() // QUERY_BLOCK))
    candidates = placed.join(F.broadcast(sizes), ["dim", "bucket"]).withColumn(
        "block", F.pmod(F.xxhash64("id"), "blocks")).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    asked = queries.withColumn("part", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(parts)).cast("int"))
    # One row for each bucket that a query may find something in, then for each block.
    asked = asked.join(F.broadcast(sizes), "dim").where(
        F.col("norm") * F.col("longest") * (1 + _SLACK) >= F.col("threshold")).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)))
    keys = ["dim", "bucket", "block", "part"]
    found = candidates.select(*keys, "id", "v", "norm").groupBy(*keys).cogroup(
        asked.select(*keys, "id", "v", "norm", "threshold").groupBy(*keys)).applyInArrow(
        _search(k), "query_id long, vec_id long, score long")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
