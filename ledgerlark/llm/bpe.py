"""Byte-level BPE by corpus-level merge replay.

The distinct words of a chunk of documents form one small corpus: their bytes lie
in one linked token sequence, and an inverted index leads from each mergeable pair
to the positions where it stands.  Merges are replayed in rank order over the whole
chunk.  A merge visits only the positions in its list and re-indexes only the two
neighbours it touched.  A word is merged once per task while it stays in a bounded
cache; the documents are then put together by lookup.

Defined cases: null text has no tokens (an empty list); an empty text too; repeated
rows are encoded each; an existing output column is replaced; other columns stay.
"""

from __future__ import annotations

import base64
import uuid
from array import array
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import chunks, replaced, schema_with

CACHED_WORDS = 250_000
CHUNK = 2 << 20
MANY_SPOTS = 60
LONG_TEXT = 1 << 20
BLOCK_WORDS = 100_000
_IN_WORKER: dict[str, MergeReplay] = {}


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class Sequence:
    """Tokens of all words in one linked sequence, and where each merge can be made.

    The plain arrays (``tokens``, ...) and the numpy ones share their memory.
    """

    def __init__(self, ids: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        at = np.arange(len(ids), dtype=np.int32)
        after, before = at + 1, at - 1
        after[ends[ends > starts] - 1] = -1
        before[starts[ends > starts]] = -1
        self.tokens, self.afters, self.befores = (
            array("i", x.astype(np.int32).tobytes()) for x in (ids, after, before))
        self.token, self.after, self.before = (
            np.frombuffer(x, np.int32) if len(x) else np.empty(0, np.int32)
            for x in (self.tokens, self.afters, self.befores))
        self.index: dict[int, list[int]] = {}
        self.heap: list[int] = []

    def note(self, ranks: np.ndarray, spots: np.ndarray) -> None:
        """Index spots under the ranks (-1: none) of the merges possible there."""
        spots, ranks = spots[ranks >= 0], ranks[ranks >= 0]
        order = np.argsort(ranks, kind="stable")
        spots, ranks = spots[order].tolist(), ranks[order]
        cuts = (np.flatnonzero(np.diff(ranks)) + 1).tolist()
        firsts = ranks[[0, *cuts]].tolist() if len(ranks) else []
        for rank, a, b in zip(firsts, [0, *cuts], [*cuts, len(spots)]):
            if rank in self.index:
                self.index[rank].extend(spots[a:b])
            else:
                self.index[rank] = spots[a:b]
                heappush(self.heap, rank)

    def note_one(self, current: int, rank: int, spot: int) -> bool:
        """The same for one spot; True if its merge goes before the current one."""
        if rank < 0:
            return False
        if rank in self.index:
            self.index[rank].append(spot)
        else:
            self.index[rank] = [spot]
            heappush(self.heap, rank)
        return rank < current


class MergeReplay:
    """Ids of words under one rank table."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.single_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.base = max(ranks.values()) + 1
        pairs = {}  # every pair of tokens whose bytes together are a token
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left * self.base + right] = rank
        self.pairs = pairs
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64)
        self.cache: dict[str, bytes] = {}

    def rank_of(self, left: int, right: int) -> int:
        """Rank of the token that the pair merges into, or -1."""
        return self.pairs.get(left * self.base + right, -1)

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) * self.base + right
        if not len(self.pair_keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], -1)

    def replay(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word after all merges, in rank order over all words.

        Positions that share a pair are merged together with numpy where they are
        many, one by one where they are few; both work on the same arrays.
        """
        if not words:
            return []
        sizes = np.array([len(w) for w in words])
        ends = np.cumsum(sizes)
        starts = ends - sizes
        run = Sequence(self.single_ids[np.frombuffer(b"".join(words), np.uint8)], starts, ends)
        pairs = np.flatnonzero(run.after >= 0)
        run.note(self.ranks_of(run.token[pairs], run.token[pairs + 1]), pairs)
        doubtful: list[np.ndarray] = []
        while run.heap:
            rank = heappop(run.heap)
            spots = run.index.pop(rank, [])
            if len(spots) < MANY_SPOTS or not self._merge_many(run, rank, spots, doubtful):
                self._merge_few(run, rank, sorted(spots))
        live = run.token >= 0
        flat = run.token[live]
        bounds = np.concatenate(([0], np.cumsum(live)))[np.append(starts, len(live))].tolist()
        result = [flat[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
        if doubtful:
            for word in np.unique(np.searchsorted(ends, np.concatenate(doubtful), "right")):
                result[word] = self.replay_alone(words[word])
        return result

    def replay_alone(self, word: bytes) -> list[int]:
        """One word, merge by merge."""
        size = np.array([len(word)])
        run = Sequence(self.single_ids[np.frombuffer(word, np.uint8)], size - size, size)
        pairs = np.flatnonzero(run.after >= 0)
        run.note(self.ranks_of(run.token[pairs], run.token[pairs + 1]), pairs)
        while run.heap:
            rank = heappop(run.heap)
            self._merge_few(run, rank, sorted(run.index.pop(rank, [])))
        return run.token[run.token >= 0].tolist()

    def _merge_few(self, run: Sequence, rank: int, spots: list[int]) -> None:
        token, after, before, rank_of = run.tokens, run.afters, run.befores, self.rank_of
        for done, at in enumerate(spots, 1):
            right = after[at]
            if token[at] < 0 or right < 0 or rank_of(token[at], token[right]) != rank:
                continue  # an earlier merge took one of the two
            token[at], token[right] = rank, -1
            follower, leader = after[right], before[at]
            after[at] = follower
            lower = False
            if follower >= 0:
                before[follower] = at
                lower = run.note_one(rank, rank_of(rank, token[follower]), at)
            if leader >= 0:
                lower |= run.note_one(rank, rank_of(token[leader], rank), leader)
            if lower and done < len(spots):
                # A better merge came up: it goes first, the rest of this one later.
                run.note(np.full(len(spots) - done, rank), np.array(spots[done:]))
                return

    def _merge_many(self, run: Sequence, rank: int, spots: list[int],
                    doubtful: list[np.ndarray]) -> bool:
        """All spots at once; False (nothing done) if two of them overlap."""
        token, after, before = run.token, run.after, run.before
        left = np.unique(np.array(spots, np.int64))
        left = left[(token[left] >= 0) & (after[left] >= 0)]
        left = left[self.ranks_of(token[left], token[after[left]]) == rank]
        right = after[left].astype(np.int64)
        if (right[:-1] == left[1:]).any():
            return False
        token[left], token[right] = rank, -1
        follower = after[right].astype(np.int64)
        after[left] = follower
        has = follower >= 0
        before[follower[has]] = left[has]
        leader = before[left].astype(np.int64)
        leader = leader[leader >= 0]
        where = np.concatenate((left[has], leader))
        new = self.ranks_of(token[where], token[after[where]])
        where, new = where[new >= 0], new[new >= 0]
        if (lower := new < rank).any():
            doubtful.append(where[lower])  # order matters there: these words are redone
        run.note(new, where)
        return True

    def learn(self, words: Iterable[str]) -> None:
        """Put the ids of unseen words into the cache."""
        fresh = [w for w in set(words) if w not in self.cache]
        if len(self.cache) + len(fresh) > CACHED_WORDS:
            self.cache.clear()
            fresh = list(set(words))
        rest = []
        for word in fresh:
            whole = self.ranks.get(word.encode())
            if whole is None:
                rest.append(word)
            else:
                self.cache[word] = np.int32(whole).tobytes()
        for word, ids in zip(rest, self.replay([w.encode() for w in rest])):
            self.cache[word] = np.array(ids, np.int32).tobytes()

    def ids(self, words: list[str]) -> bytes:
        return b"".join(map(self.cache.__getitem__, words))

    def encode_long(self, text: str) -> bytes:
        """One long text, a block of words at a time."""
        found, parts = self.pattern.finditer(text), []
        while block := [m.group() for m in islice(found, BLOCK_WORDS)]:
            self.learn(block)
            parts.append(self.ids(block))
        return b"".join(parts)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as bytes of 32-bit integers."""
        split = [self.pattern.findall(t) if len(t) < LONG_TEXT else None for t in texts]
        self.learn([w for words in split if words for w in words])
        short = [None if words is None else self.ids(words) for words in split]
        return [self.encode_long(t) if ids is None else ids for t, ids in zip(texts, short)]


def encode(df: DataFrame, ranks: dict[bytes, int], pattern: str, text_col: str = "text",
           out_col: str = "ids") -> DataFrame:
    """``df`` with ``text_col`` replaced by ``out_col`` (array of token ids)."""
    shared = df.sparkSession.sparkContext.broadcast(ranks)  # one vocabulary: fixed size
    key = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _IN_WORKER:  # a worker process runs many tasks
            _IN_WORKER.clear()
            _IN_WORKER[key] = MergeReplay(shared.value, pattern)
        replay = _IN_WORKER[key]
        for batch in batches:
            for rows, texts in chunks(batch, text_col, CHUNK):
                parts = replay.encode([(t or b"").decode("utf-8", "replace") for t in texts])
                ends = np.cumsum([0, *(len(p) // 4 for p in parts)]).astype(np.int32)
                flat = pa.array(np.frombuffer(b"".join(parts), np.int32))
                yield replaced(rows, text_col, out_col, pa.ListArray.from_arrays(ends, flat))

    text = df.withColumn(text_col, F.col(text_col).cast("string"))
    return text.mapInArrow(run, schema_with(text, (text_col,), f"`{out_col}` array<int>"))


def decode(df: DataFrame, ranks: dict[bytes, int], ids_col: str = "ids",
           out_col: str = "decoded") -> DataFrame:
    """``df`` with ``ids_col`` replaced by ``out_col`` (the bytes; null ids: empty)."""
    shared = df.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = {rank: token for token, rank in shared.value.items()}
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                rows = batch.slice(start, 500)
                lists = rows.column(rows.schema.get_field_index(ids_col))
                found = [b"".join(map(tokens.__getitem__, s.values.to_numpy().tolist()))
                         if s.is_valid else b"" for s in lists]
                yield replaced(rows, ids_col, out_col, pa.array(found, pa.binary()))

    return df.mapInArrow(run, schema_with(df, (ids_col,), f"`{out_col}` binary"))


def token_digests(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and the digest of the decoded bytes."""
    ids = encode(docs.select("doc_id", "text"), ranks, pattern)
    digests = ids.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        "ids")
    return decode(digests, ranks).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
