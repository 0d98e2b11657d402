"""Hard negatives from exact products of integer vectors.

Anchors are held against all rows, tile by tile.  A tile of anchors times a tile of
candidates is multiplied by Strassen's recursion: both are padded with zeros to even
halves, seven half products replace eight, and blocks of at most LEAF are multiplied
directly.  The numbers are the narrowest in which every intermediate one is exact: by
the lengths of the rows, floats below 2^24, then doubles below 2^53, then 64-bit integers,
whose additions wrap modulo 2^64, which is a ring, so that the result is exact wherever
the true product fits.  Where the largest entries say that it may not, the same recursion
runs on Python integers and scores are clipped to 64 bits.

1. Positives: each task keeps a heap of the best same-label rows of every anchor; heaps
   merge, as the best of the union are among the bests of its parts.  Rows are sorted by
   label, and only blocks of one label are multiplied.
2. Windows: with the positives known, a second pass keeps a heap for each anchor and
   positive of the best rows of other labels whose score lies in the positive's window.
   Blocks of one label are left out where they fill a tile; so are anchors without windows.

Scores are compared with the least that an anchor's heaps still take; only those that
reach it are looked at one by one.

Anchors go through in slices of at most SLICE_BYTES, which are broadcast; candidates are
scanned once a slice and pass and never shuffled.  Only heaps are.

Defined cases: rows with a null id, label or vector or with a null or non-finite component
take no part; vectors of other dimension are no partners; repeated rows count once; an id
on several rows is one candidate with the best score of its rows, and one anchor whose
positives and windows are those of all its rows; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.llm.common import stash
from ledgerlark.session import shared_dir

SCALE = 256
LEAF = 32
TILE = 1024
ANCHOR_TILE = 512
#: Rows of a task's first tile; heaps that are not full yet take most of it.
NARROW = 64
#: Where more than one score in so many reaches its heaps, rows are cut to their best first.
DENSE = 32
#: Labels of a tile that are left out one by one; more are compared row by row.
FEW_RUNS = 32
#: Found scores that wait to be put into heaps together.
WAITING = 1 << 17
SLICE_BYTES = 8 << 20
POSITIVES, NEGATIVES = 5, 3
#: A negative's score lies within these percentages of the positive's.
LOW, HIGH = 50, 95
_NONE, _MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
_EXACT = ((np.float32, 1 << 24), (np.float64, 1 << 53))


def _even(x: np.ndarray) -> np.ndarray:
    """``x`` with a row or column of zeros where it has an odd number."""
    rows, columns = x.shape
    out = np.zeros((rows + rows % 2, columns + columns % 2), x.dtype,
                   order="F" if x.flags.f_contiguous else "C")
    out[:rows, :columns] = x
    return out


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a (m, k) times b (k, n)."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= LEAF:
        return a @ b
    if m % 2 or k % 2 or n % 2:
        return strassen(_even(a), _even(b))[:m, :n]
    i, j, p = m // 2, n // 2, k // 2
    a11, a12, a21, a22 = a[:i, :p], a[:i, p:], a[i:, :p], a[i:, p:]
    b11, b12, b21, b22 = b[:p, :j], b[:p, j:], b[p:, :j], b[p:, j:]
    m1 = strassen(a11 + a22, b11 + b22)
    m2 = strassen(a21 + a22, b11)
    m3 = strassen(a11, b12 - b22)
    m4 = strassen(a22, b21 - b11)
    m5 = strassen(a11 + a12, b22)
    m6 = strassen(a21 - a11, b11 + b12)
    m7 = strassen(a12 - a22, b21 + b22)
    out = np.empty((m, n), a.dtype)
    out[:i, :j] = m1 + m4 - m5 + m7
    out[:i, j:] = m3 + m5
    out[i:, :j] = m2 + m4
    out[i:, j:] = m1 - m2 + m3 + m6
    return out


class Vectors:
    """int64 rows, and copies of them in the types in which they are multiplied."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        wide = rows.astype(np.float64)
        self.lengths = np.sqrt(np.einsum("ij,ij->i", wide, wide))
        self.copies: dict[type, np.ndarray] = {}

    def as_type(self, kind: type) -> np.ndarray:
        if kind not in self.copies:
            self.copies[kind] = self.rows.astype(kind)
        return self.copies[kind]


def _levels(m: int, k: int, n: int) -> int:
    """How often ``strassen`` halves."""
    levels = 0
    while min(m, k, n) > LEAF:
        m, k, n = (m + 1) // 2, (k + 1) // 2, (n + 1) // 2
        levels += 1
    return levels


def block(anchors: Vectors, some: slice, vectors: Vectors, others: slice) -> np.ndarray:
    """Exact products of some rows of both (not empty), as floats, doubles or longs; these
    are clipped above the least long."""
    lengths = anchors.lengths[some], vectors.lengths[others]
    levels = _levels(len(lengths[0]), anchors.rows.shape[1], len(lengths[1]))
    # A level adds two rows on either side, so that products reach 4 times those of the
    # lengths, and of these it adds up at most 4 + 2 + 2 + 4 times the lengths.
    most = 3 * 4.0**levels * max(1, lengths[0].max()) * max(1, lengths[1].max()) * (1 + 1e-9)
    for kind, limit in _EXACT:
        if most < limit:
            return strassen(anchors.as_type(kind)[some], vectors.as_type(kind)[others].T)
    left, right = anchors.rows[some], vectors.rows[others]
    largest = [max(-int(x.min()), int(x.max())) for x in (left, right)]
    if largest[0] * largest[1] * left.shape[1] < 1 << 63:
        return strassen(left, right.T)
    exact = strassen(left.astype(object), right.T.astype(object))
    return np.clip(exact, _NONE + 1, _MOST).astype(np.int64)


def products(anchors: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact products of the rows of two int64 arrays, clipped above the least long."""
    if not anchors.size or not vectors.size:
        return np.zeros((len(anchors), len(vectors)), np.int64)
    return block(Vectors(anchors), slice(None), Vectors(vectors), slice(None)).astype(np.int64)


def _none(scores: np.ndarray) -> float | int:
    """What stands for no score among those."""
    return _NONE if scores.dtype == np.int64 else -np.inf


class Heaps:
    """The best ``k`` (score, id) of each of ``n`` keys: higher scores, then smaller ids."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.scores = np.full((n, k), _NONE, np.int64)  # falling; _NONE: nothing yet
        self.ids = np.zeros((n, k), np.int64)

    @property
    def least(self) -> np.ndarray:
        """The score that a full heap's last has."""
        return self.scores[:, -1]

    @property
    def key(self) -> np.ndarray:
        return np.nonzero(self.scores != _NONE)[0]

    @property
    def id(self) -> np.ndarray:
        return self.ids[self.scores != _NONE]

    @property
    def score(self) -> np.ndarray:
        return self.scores[self.scores != _NONE]

    def add(self, keys: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Scores of ``ids`` (distinct) for some keys; _NONE: takes no part."""
        floor = np.maximum(self.least[keys], _NONE + 1)
        if scores.shape[1] > self.k:
            last = scores.shape[1] - self.k
            floor = np.maximum(floor, np.partition(scores, last, axis=1)[:, last])
        row, place = np.nonzero(scores >= floor[:, None])
        self.put(keys[row], scores[row, place], ids[place])

    def put(self, keys: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """One key, score and id at a time."""
        if not len(keys):
            return
        touched, key = np.unique(keys, return_inverse=True)
        old, place = np.nonzero(self.scores[touched] != _NONE)
        key = np.concatenate((old, key))
        name = np.concatenate((self.ids[touched[old], place], ids))
        score = np.concatenate((self.scores[touched[old], place], scores))
        # An id may come again, from another row or tile: its best stays.
        order = np.lexsort((-score, name, key))
        key, name, score = key[order], name[order], score[order]
        first = np.ones(len(key), bool)
        first[1:] = (key[1:] != key[:-1]) | (name[1:] != name[:-1])
        key, name, score = key[first], name[first], score[first]
        order = np.lexsort((name, -score, key))
        key, name, score = key[order], name[order], score[order]
        rank = np.arange(len(key)) - np.searchsorted(key, key, "left")
        keep = rank < self.k
        key, rank = key[keep], rank[keep]
        best = np.full((len(touched), self.k), _NONE, np.int64)
        names = np.zeros_like(best)
        best[key, rank], names[key, rank] = score[keep], name[keep]
        self.scores[touched], self.ids[touched] = best, names


def _by_id(scores: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Columns of one id put together by their best score."""
    order = np.argsort(ids, kind="stable")
    names = ids[order]
    first = np.flatnonzero(np.concatenate(([True], names[1:] != names[:-1])))
    if len(first) == len(ids):
        return scores, ids
    return np.maximum.reduceat(scores[:, order], first, axis=1), names[first]


def _inside(scores: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Flat places of scores from ``low`` to ``high`` of their row.  Where scores are floats,
    the bounds are rounded only beyond all of them."""
    inside = scores >= low.astype(scores.dtype)[:, None]
    if high.min(initial=_MOST) < _MOST:
        inside &= scores <= high.astype(scores.dtype)[:, None]
    return np.flatnonzero(inside)


class Finder:
    """Sorts blocks of scores into heaps.  Each anchor has some lines, which are keys of
    heaps (-1: no line), and takes scores from ``low`` to ``high`` for each of them."""

    def __init__(self, heaps: Heaps, names: np.ndarray, lines: np.ndarray,
                 low: np.ndarray, high: np.ndarray):
        self.heaps, self.names, self.lines, self.low, self.high = heaps, names, lines, low, high
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.n = 0

    def look(self, some: slice, scores: np.ndarray, ids: np.ndarray) -> None:
        """Scores of some anchors and ``ids``; an anchor does not come again before ``put``."""
        names, lines, high = self.names[some], self.lines[some], self.high[some]
        low = np.maximum(self.low[some], self.heaps.least[lines])
        flat = _inside(scores, low.min(axis=1), high.max(axis=1))
        if len(flat) * DENSE > scores.size:
            self._look_line_by_line(names, lines, low, high, scores, ids)
            return
        row, place = np.divmod(flat, scores.shape[1])
        found = scores[row, place].astype(np.int64)
        able = (found[:, None] >= low[row]) & (found[:, None] <= high[row])
        able &= (names[row] != ids[place])[:, None]
        hit, line = np.nonzero(able)
        self._wait(lines[row[hit], line], found[hit], ids[place[hit]])

    def _look_line_by_line(self, names: np.ndarray, lines: np.ndarray, low: np.ndarray,
                           high: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        scores[names[:, None] == ids] = _none(scores)
        for line in range(lines.shape[1]):
            flat = _inside(scores, low[:, line], high[:, line])
            if len(flat) * DENSE > scores.size:
                able = np.flatnonzero(lines[:, line] >= 0)
                longs = np.full(scores.shape, _NONE)
                longs.ravel()[flat] = scores.ravel()[flat]
                self.heaps.add(lines[able, line], *_by_id(longs[able], ids))
            else:
                row, place = np.divmod(flat, scores.shape[1])
                self._wait(lines[row, line], scores[row, place].astype(np.int64), ids[place])

    def _wait(self, keys: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        self.waiting.append((keys, scores, ids))
        self.n += len(keys)

    def put(self, least: int = 1) -> None:
        """Puts what waits into the heaps, if that is ``least`` scores or more."""
        if self.n >= least:
            self.heaps.put(*map(np.concatenate, zip(*self.waiting)))
            self.waiting, self.n = [], 0


def _tiles(batches: Iterator[pa.RecordBatch]
           ) -> Iterator[tuple[int, np.ndarray, np.ndarray, Vectors]]:
    """dim, ids, labels and vectors of at most TILE rows, by label and id."""
    seen: Counter[int] = Counter()
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims).tolist():
            own = batch.filter(pa.array(dims == dim))
            ids, labels = own.column("id").to_numpy(), own.column("label").to_numpy()
            flat = own.column("v").flatten().to_numpy().reshape(len(ids), dim)
            order = np.lexsort((ids, labels))
            while len(order):
                width = min(TILE, max(NARROW, seen[dim]))
                rows, order = order[:width], order[width:]
                seen[dim] += len(rows)
                yield dim, ids[rows], labels[rows], Vectors(flat[rows])


class Part:
    """Anchors of one dimension, by label and id."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        order = np.lexsort((ids, labels))
        self.ids, self.labels, self.vectors = ids[order], labels[order], Vectors(rows[order])

    def where(self, kept: np.ndarray) -> Part:
        return Part(self.ids[kept], self.labels[kept], self.vectors.rows[kept])

    def runs(self, labels: np.ndarray) -> np.ndarray:
        """For each run of equal ``labels`` (sorted) that anchors have: its begin and end, and
        those of the anchors."""
        begin = np.flatnonzero(np.concatenate(([True], labels[1:] != labels[:-1])))
        end = np.append(begin[1:], len(labels))
        first, last = (np.searchsorted(self.labels, labels[begin], side)
                       for side in ("left", "right"))
        return np.stack((begin, end, first, last), axis=1)[last > first]


class Slice:
    """Some anchors, by dimension."""

    def __init__(self, table: pa.Table):
        self.parts: dict[int, Part] = {}
        for dim in np.unique(table.column("dim").to_numpy()).tolist():
            own = table.filter(pa.array(table.column("dim").to_numpy() == dim)).combine_chunks()
            flat = own.column("v").chunk(0).flatten().to_numpy()
            self.parts[dim] = Part(own.column("id").to_numpy(), own.column("label").to_numpy(),
                                   flat.reshape(own.num_rows, dim))


def _positives(anchors: Slice, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finders = {}
        for dim, part in anchors.parts.items():
            lines = np.arange(len(part.ids))[:, None]
            finders[dim] = Finder(Heaps(len(part.ids), k), part.ids, lines,
                                  np.full(lines.shape, _NONE + 1), np.full(lines.shape, _MOST))
        for dim, ids, labels, vectors in _tiles(batches):
            if dim not in finders:
                continue
            part, finder = anchors.parts[dim], finders[dim]
            for begin, end, first, last in part.runs(labels).tolist():
                for start in range(first, last, ANCHOR_TILE):
                    some = slice(start, min(start + ANCHOR_TILE, last))
                    scores = block(part.vectors, some, vectors, slice(begin, end))
                    finder.look(some, scores, ids[begin:end])
                    finder.put(WAITING)
            finder.put()
        for dim, finder in finders.items():
            heaps = finder.heaps
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (anchors.parts[dim].ids[heaps.key], heaps.id, heaps.score)],
                names=["anchor_id", "positive_id", "positive_score"])

    return run


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """Least and greatest n with low * score <= 100 * n <= high * score."""
    return -(-low * score // 100), high * score // 100


class Windows:
    """Positives (anchor_id, positive_id, positive_score) whose window is not empty."""

    def __init__(self, positives: np.ndarray, low: int, high: int):
        bounds = np.array([window(s, low, high) for s in positives[:, 2].tolist()],
                          np.int64).reshape(-1, 2)
        able = bounds[:, 0] <= bounds[:, 1]
        order = np.argsort(positives[able, 0], kind="stable")
        self.positives, self.bounds = positives[able][order], bounds[able][order]

    def lines(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each anchor its positives' places (-1: none) and the bounds of their windows."""
        first, last = (np.searchsorted(self.positives[:, 0], names, side)
                       for side in ("left", "right"))
        places = first[:, None] + np.arange((last - first).max(initial=0))
        there = places < last[:, None]
        low, high = np.full(places.shape, _MOST), np.full(places.shape, _NONE)
        low[there], high[there] = self.bounds[places[there]].T
        return np.where(there, places, -1), low, high


def _negatives(anchors: Slice, windows: Windows, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps, parts, finders = Heaps(len(windows.positives), k), {}, {}
        for dim, part in anchors.parts.items():
            part = part.where(np.isin(part.ids, windows.positives[:, 0]))
            if len(part.ids):
                parts[dim] = part
                finders[dim] = Finder(heaps, part.ids, *windows.lines(part.ids))
        for dim, ids, labels, vectors in _tiles(batches):
            if dim not in parts:
                continue
            part, finder = parts[dim], finders[dim]
            runs = part.runs(labels)
            for start in range(0, len(part.ids), ANCHOR_TILE):
                some = slice(start, min(start + ANCHOR_TILE, len(part.ids)))
                if labels[0] == labels[-1] == part.labels[start] == part.labels[some.stop - 1]:
                    continue
                scores = block(part.vectors, some, vectors, slice(None))
                own = runs[(runs[:, 2] < some.stop) & (runs[:, 3] > start)]
                if len(own) > FEW_RUNS:
                    same = part.labels[some, None] == labels
                    np.copyto(scores, _none(scores), where=same)
                else:
                    for begin, end, first, last in own.tolist():
                        scores[max(0, first - start):last - start, begin:end] = _none(scores)
                finder.look(some, scores, ids)
                finder.put(WAITING)
            finder.put()
        found = windows.positives[heaps.key].T
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (*found, heaps.id, heaps.score)],
            names=["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])

    return run


def integer_vectors(rows: DataFrame) -> DataFrame:
    """id, label, v (longs floor(SCALE * x)) and dim of the rows that take part."""
    return rows.select(
        F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"),
        F.transform("embedding", lambda x: x.cast("double")).alias("x")).where(
        "id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL").where(
        F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))).select(
        "id", "label", F.transform("x", lambda x: F.floor(x * SCALE)).alias("v")).distinct().select(
        "id", "label", "v", F.size("v").alias("dim"))


def _best(found: DataFrame, keys: list[str], name: str, score: str, k: int) -> DataFrame:
    """The ``k`` best of each key over all heaps, with their rank."""
    one = found.repartition(*keys).groupBy(*keys, name).agg(F.max(score).alias(score))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(score), name))
    return one.withColumn("rank", rank).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES,
                   negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the
    anchors among ``rows`` (vec_id, embedding, label); ``is_anchor`` reads id."""
    vectors = stash(integer_vectors(rows), "vectors")
    anchors = vectors.where(is_anchor & (F.col("dim") > 0))
    size = anchors.agg(F.sum(F.col("dim") * 8 + 16)).first()[0] or 0
    slices = -(-size // SLICE_BYTES)
    part = F.pmod(F.xxhash64("id", F.lit(13)), F.lit(max(1, slices)))
    path = f"{shared_dir(rows.sparkSession)}/negatives-{uuid.uuid4().hex}"
    ddl = "anchor_id long, positive_id long, positive_score long"
    more = "negative_id long, negative_score long"
    out = f"{ddl}, rank int, {more}"
    rows.sparkSession.createDataFrame([], out).write.parquet(path)
    for number in range(slices):
        some = Slice(anchors.where(part == number).toArrow())
        if not some.parts:
            continue
        found = vectors.mapInArrow(_positives(some, positives), ddl)
        best = stash(_best(found, ["anchor_id"], "positive_id", "positive_score", positives),
                     "positives")
        known = best.select("anchor_id", "positive_id", "positive_score").toArrow()
        windows = Windows(np.stack([c.to_numpy() for c in known.columns], axis=1), low, high)
        if not len(windows.positives):
            continue
        mined = vectors.mapInArrow(_negatives(some, windows, negatives), f"{ddl}, {more}")
        _best(mined, ["anchor_id", "positive_id", "positive_score"], "negative_id",
              "negative_score", negatives).select(
            "anchor_id", "positive_id", "positive_score", "rank", "negative_id", "negative_score"
        ).write.mode("append").parquet(path)
    return rows.sparkSession.read.schema(out).parquet(path).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
