"""Token counts of whole texts; huge ones by overlap resynchronisation.

A text over LONG bytes is cut into chunks of CHUNK bytes, each of which also holds the
next OVERLAP bytes.  Chunks are dealt out over the tasks and encoded by the library
with their byte offsets.  Where two neighbours overlap, the first place at which both
begin a new pre-token is a stable boundary: pre-tokens are found from left to right
without looking back, so from a common boundary on both see the same.  It is proven if
the left chunk is right there, which holds if the left chunk is spliced itself and the
place is further from its end than any special string or look-ahead reaches.  The left
chunk counts the tokens before the boundary, the right one those after it.

Where no common boundary is found (a run without boundaries longer than the overlap),
the overlap is widened to the whole of the next chunk: neighbours that failed are joined
and encoded anew, round by round, until every joint holds or the text is one chunk.

Other texts are cut at single spaces between two characters that are no white space: a
pre-token may begin with a space but never holds one after another character, so such a
place is a boundary in any text.  The library encodes each distinct segment once a worker.

Defined cases: null text is empty (0 bytes, 0 tokens); each row is counted by itself, so
null and repeated ids keep their rows; special strings in a text count as the library's
default has it; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.llm.common import chunks, stash

LONG = 1 << 16
CHUNK = 1 << 15
OVERLAP = 512
LIMIT = 512
_HELD = 400_000
_PLAIN = frozenset(string.ascii_letters + string.digits + string.punctuation)


class Counter:
    """Counts tokens by a byte-level tokenizer of the library."""

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        parts = json.loads(tokenizer_json)
        added = parts["added_tokens"]
        self.widths = np.zeros(1 + max([*parts["model"]["vocab"].values(),
                                        *(a["id"] for a in added)]), np.int64)
        for token, number in parts["model"]["vocab"].items():
            self.widths[number] = len(token)  # one character of the byte alphabet each
        for a in added:
            self.widths[a["id"]] = len(a["content"].encode())
        #: A boundary is proven where the text goes on this many bytes.
        self.margin = 8 + max([0, *(len(a["content"].encode()) for a in added)])
        self.cuttable = cuttable(parts)
        self.held: tuple[dict[str, int], dict[str, int]] = ({}, {})

    def encoded(self, texts: list[str]) -> list:
        return self.tokenizer.encode_batch(texts, add_special_tokens=False)

    def count_all(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        if not self.cuttable:
            return [len(e) for e in self.encoded(texts)]
        if sum(map(len, self.held)) > _HELD:
            self.held[0].clear()
            self.held[1].clear()
        opening, following = self.held
        split = [segments(text) for text in texts]
        new_opening = {parts[0] for parts in split} - opening.keys()
        new = set().union(*(parts[1:] for parts in split)) - following.keys()
        wanted = [*new_opening, *(" " + part for part in new)]
        sizes = [len(e) for e in self.encoded(wanted)]
        opening.update(zip(new_opening, sizes))
        following.update(zip(new, sizes[len(new_opening):]))
        return [opening[parts[0]] + sum(map(following.__getitem__, parts[1:]))
                for parts in split]

    def boundaries(self, text: bytes) -> tuple[np.ndarray, np.ndarray, int]:
        """Byte offset of each pre-token of a chunk, the tokens before it, and all tokens."""
        encoding = self.encoded([text.decode("utf-8", "replace")])[0]
        ends = np.cumsum(self.widths[np.array(encoding.ids, np.int64)])
        words = np.array([-1 if w is None else w for w in encoding.word_ids], np.int64)
        new = np.flatnonzero(np.diff(words, prepend=-2))
        starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
        return starts[new], new, len(words)


def cuttable(parts: dict) -> bool:
    """Whether chunks may be spliced: no normaliser, byte-level pre-tokens by the library's
    own pattern, special strings without white space that no text can overlap."""
    pre, added = parts["pre_tokenizer"] or {}, parts["added_tokens"]
    names = [a["content"] for a in added]
    apart = all(not a.endswith(b[:n]) for a in names for b in names
                for n in range(1, len(b) + (a != b)))
    return (parts["normalizer"] is None and pre.get("type") == "ByteLevel"
            and not pre.get("add_prefix_space") and pre.get("use_regex", True) and apart
            and not any(a[k] for a in added for k in ("single_word", "lstrip", "rstrip"))
            and not any(c.isspace() for name in names for c in name))


def _solid(char: str) -> bool:
    return char in _PLAIN or char.isalnum()


def segments(text: str) -> list[str]:
    """The text cut before single spaces between two solid characters; the space itself
    is left out."""
    parts = text.split(" ")
    if all(p and _solid(p[0]) and _solid(p[-1]) for p in parts):
        return parts
    joined, run = [], [parts[0]]
    for part in parts[1:]:
        if part and _solid(part[0]) and run[-1] and _solid(run[-1][-1]):
            joined.append(" ".join(run))
            run = []
        run.append(part)
    return [*joined, " ".join(run)]


def cut_points(text: bytes, size: int) -> list[int]:
    """Starts of the chunks of about ``size`` bytes, at characters, and the text's end."""
    points, at = [0], size
    while at < len(text):
        while at > points[-1] + 1 and text[at] & 0xC0 == 0x80:
            at -= 1
        points.append(at)
        at += size
    return [*points, len(text)]


def _first_look(tokenizer_json: str, long: int, chunk: int, overlap: int):
    """Counts texts up to ``long`` bytes and cuts the others into chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(tokenizer_json)
        names = ["row", "doc_id", "n_bytes", "n_tokens", "no", "last", "at", "own", "tail"]
        types = [pa.int64(), None, pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(),
                 pa.binary(), pa.binary()]
        for batch in batches:
            for rows, texts in chunks(batch, "text"):
                numbers, ids = rows.column(0), rows.column(1)
                whole = [t is None or len(t) <= long or not counter.cuttable for t in texts]
                counts = iter(counter.count_all([(t or b"").decode("utf-8", "replace")
                                                 for t, w in zip(texts, whole) if w]))
                n = len(texts)
                yield pa.RecordBatch.from_arrays(
                    [numbers, ids, pa.array([len(t or b"") for t in texts], pa.int64()),
                     pa.array([next(counts) if w else None for w in whole], pa.int64()),
                     *(pa.nulls(n, t) for t in types[4:])], names=names)
                for k in (k for k in range(n) if not whole[k]):
                    # Bytes that are no text are replaced once, before offsets are taken.
                    text = texts[k].decode("utf-8", "replace").encode()
                    points = cut_points(text, chunk)
                    for first in range(0, len(points) - 1, 64):
                        span = range(first, min(first + 64, len(points) - 1))
                        tails = [text[points[i + 1]:cut_points(text[points[i + 1]:points[i + 1]
                                 + overlap + 4], overlap)[1] + points[i + 1]] for i in span]
                        part = [[numbers[k].as_py()] * len(span), [None] * len(span),
                                [None] * len(span), [None] * len(span), list(span),
                                [i + 2 == len(points) for i in span], [points[i] for i in span],
                                [text[points[i]:points[i + 1]] for i in span], tails]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(v, t or ids.type) for v, t in zip(part, types)], names=names)

    return run


UNIT = ("row long, first long, final long, last boolean, tokens long, head_at array<long>, "
        "head_n array<long>, tail_at array<long>, tail_n array<long>")


def _encode(tokenizer_json: str, overlap: int):
    """Chunks or joined chunks: the boundaries in both overlaps, and all tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(tokenizer_json)
        for batch in batches:
            out: list[list] = [[] for _ in range(9)]
            for unit in batch.to_pylist():
                text = unit["own"] + unit["tail"]
                places, before, tokens = counter.boundaries(text)
                head = places <= overlap + 4
                tail = (places >= len(unit["own"])) & (places <= len(text) - counter.margin)
                at = unit["at"]
                for column, value in zip(out, (
                        unit["row"], unit["first"], unit["final"], unit["last"], tokens,
                        (places[head] + at).tolist(), before[head].tolist(),
                        (places[tail] + at).tolist(), before[tail].tolist())):
                    column.append(value)
            lists = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(out, (
                    pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(),
                    lists, lists, lists, lists))],
                names=["row", "first", "final", "last", "tokens", "head_at", "head_n",
                       "tail_at", "tail_n"])

    return run


def spliced(units: DataFrame) -> DataFrame:
    """``units`` with ``joint``, the first common boundary with the next one (null: none),
    and ``gain``, the tokens that the two count there."""
    order = Window.partitionBy("row").orderBy("first")
    both = units.withColumns({"next_at": F.lead("head_at").over(order),
                              "next_n": F.lead("head_n").over(order)})
    joint = F.array_min(F.array_intersect("tail_at", "next_at"))
    found = both.withColumn("joint", joint)
    at = [F.element_at(n, F.array_position(p, F.col("joint")).cast("int"))
          for p, n in (("tail_at", "tail_n"), ("next_at", "next_n"))]
    return found.withColumn("gain", F.when(F.col("joint").isNotNull(), at[0] - at[1])).drop(
        "next_at", "next_n")


def joined(units: DataFrame, pieces: DataFrame) -> DataFrame:
    """Each run of neighbours without a common boundary as one unit with its bytes."""
    order = Window.partitionBy("row").orderBy("first")
    opens = F.lag("joint").over(order).isNotNull() | (F.lag("row").over(order).isNull())
    runs = units.withColumn("run", F.sum(opens.cast("int")).over(order)).groupBy("row", "run").agg(
        F.min("first").alias("first"), F.max("final").alias("final"), F.count("*").alias("n"))
    parts = runs.where("n > 1").select(
        "row", "first", "final", F.explode(F.sequence("first", "final")).alias("no"))
    parts = parts.join(pieces, ["row", "no"])
    # Such a run is one stretch without a boundary, which the library has to see as a whole.
    whole = parts.groupBy("row", "first", "final").agg(
        F.min("at").alias("at"), F.max("last").alias("last"),
        F.array_sort(F.collect_list(F.struct("no", "own", "tail"))).alias("parts"))
    empty = F.lit(b"").cast("binary")
    return whole.select(
        "row", "first", "final", "last", "at",
        F.aggregate("parts", empty, lambda all, p: F.concat(all, p["own"])).alias("own"),
        F.element_at("parts", -1)["tail"].alias("tail"))


def token_counts(docs: DataFrame, tokenizer_json: str, limit: int = LIMIT, long: int = LONG,
                 chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of each row of
    ``docs`` (doc_id, text), by a tokenizer given as the library's JSON."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id",
                       F.col("text").cast("string").cast("binary").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    seen = stash(rows.mapInArrow(
        _first_look(tokenizer_json, long, chunk, overlap),
        f"row long, doc_id {id_type}, n_bytes long, n_tokens long, no long, last boolean, "
        "at long, own binary, tail binary"), "token-rows")
    pieces = seen.where("no IS NOT NULL").select("row", "no", "last", "at", "own", "tail")
    encode = _encode(tokenizer_json, overlap)
    units = stash(pieces.select("row", F.col("no").alias("first"), F.col("no").alias("final"),
                                "last", "at", "own", "tail").repartition("row", "first")
                  .mapInArrow(encode, UNIT), "token-units")
    while True:
        units = stash(spliced(units), "token-joints")
        failed = units.where("joint IS NULL AND NOT last")
        if not failed.take(1):
            break
        again = stash(joined(units, pieces).mapInArrow(encode, UNIT), "token-again")
        taken = again.select("row", F.explode(F.sequence("first", "final")).alias("first"))
        kept = units.drop("joint", "gain").join(taken, ["row", "first"], "left_anti")
        units = stash(kept.unionByName(again), "token-units")
    total = units.groupBy("row").agg(F.sum(
        F.when(F.col("last"), F.col("tokens")).otherwise(F.col("gain"))).alias("spliced"))
    counted = seen.where("no IS NULL").select("row", "doc_id", "n_bytes", "n_tokens")
    n = F.coalesce("n_tokens", "spliced")
    short = counted.where("n_tokens IS NOT NULL").withColumn("spliced", F.lit(None).cast("long"))
    long_rows = counted.where("n_tokens IS NULL").join(total, "row", "left")
    return short.unionByName(long_rows).select(
        "doc_id", "n_bytes", n.alias("n_tokens"), (n > limit).alias("over_limit"))
