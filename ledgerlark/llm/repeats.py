"""Repeated byte strings by prefix-free parsing.

A rolling hash marks trigger positions: a position is a trigger if its hash is the
least among the ``REACH`` positions that some window may look at.  Triggers cut every
document into phrases.  They depend on the nearby bytes only, so two equal strings of
``length`` bytes are cut alike, and each string belongs to the first least trigger in it.
Where strings begin at ``lo``..``hi`` and share the trigger ``t``, their order in the
corpus is settled by the phrase suffix that leads to ``t`` and the parse that follows.
Only equality to the depth of ``length`` bytes matters, so instead of the sorted suffix
arrays themselves their equality classes are formed, as names of the strings, and equal
names become neighbours by a partitioned sort:

1. parse suffix: the bytes from ``t`` that all strings of the trigger share.  A trigger
   whose name is unique is dropped; no string there is repeated.  This name only saves
   work, so 64 bits of a fixed polynomial do.
2. phrase suffix and parse: all bytes from ``lo`` to ``hi + length``.  Where that name
   is met twice, every string of the trigger is repeated.
3. The triggers between (a few at each end of a repeat) are spelt out, one name for each
   string, together with one witness of each class of step 2 that has the same name in
   step 1 as a trigger in doubt.

Names that decide (2 and 3) are four polynomials modulo 2^31 - 1 at places that the
driver draws anew for each run.  Two given strings of up to 527 bytes that differ, however
they were made, get one name with chance (528 / (2^31 - 1))^4, less than 4e-27.

Equal names within a batch are folded before each shuffle: one of them is sent to meet
the others, the rest is known to be repeated and dealt out at random.  So a passage held
by a third of all documents reaches no task more than once a batch.

Rows are numbered once, in the table that all steps read.  Lists of runs are put together
by that number and meet texts that have any; other texts are never shuffled.

Defined cases: null text is empty; texts shorter than ``length`` keep all bytes; rows
that repeat an id are documents of their own; a null id too; very long texts are parsed
in overlapping pieces; other columns are ignored.
"""

from __future__ import annotations

import secrets
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import chunks, small_enough, stash, trimmed
from ledgerlark.llm.words import mix

U = np.uint64
LENGTH = 400
REACH = 128
GRAM = 24
PIECE = 1 << 18
_BASE = U(0xB5297A4D3F84D5A5)
_UNBASE = U(pow(int(_BASE), -1, 1 << 64))
_CODES = mix(np.arange(1, 257, dtype=np.uint64) * U(0x9E3779B97F4A7C15))
_POWERS: dict[str, np.ndarray] = {}
_PRIME = U((1 << 31) - 1)
PLACES = 4


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", _UNBASE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


class Names:
    """Names of all substrings of some bytes, from prefix sums of a polynomial."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_CODES[data] * up[:-1], out=self.sums[1:])

    def of(self, start: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        return mix((self.sums[start + size] - self.sums[start]) * self.down[start])


def drawn_places() -> list[tuple[int, int]]:
    """Where this run takes its polynomials: for each a place and a weight for shapes."""
    return [(2 + secrets.randbelow(int(_PRIME) - 3), 1 + secrets.randbelow(int(_PRIME) - 2))
            for _ in range(PLACES)]


class Strong:
    """Names that decide, of all substrings of some bytes: two longs each."""

    def __init__(self, data: np.ndarray, places: list[tuple[int, int]]):
        self.parts = []
        for place, weight in places:
            up, down = _residues(place, len(data) + 1)
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum((data + U(1)) * up[:-1] % _PRIME, out=sums[1:])
            self.parts.append((sums, down, U(weight)))

    def of(self, start: np.ndarray, size: np.ndarray | int, shape: np.ndarray | int = 0
           ) -> list[np.ndarray]:
        """Names of the strings; of different ``shape``, equal strings are told apart."""
        shape = np.asarray(shape, np.uint64) + U(1)
        values = [((sums[start + size] - sums[start]) % _PRIME * down[start] + shape * weight) % _PRIME
                  for sums, down, weight in self.parts]
        return [(values[k] << U(31) | values[k + 1]).view(np.int64) for k in (0, 2)]


def _residues(place: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a place and of its inverse, by doubling."""
    key = f"{place}"
    if len(_POWERS) > 8 * PLACES:  # a worker may serve many runs
        _POWERS.clear()
    if len(_POWERS.get(key, ())) < n:
        for name, base in ((key, place), (f"-{key}", pow(place, -1, int(_PRIME)))):
            powers = np.ones(1, np.uint64)
            while len(powers) < n:
                step = U(pow(base, len(powers), int(_PRIME)))
                powers = np.concatenate((powers, powers * step % _PRIME))
            _POWERS[name] = powers
    return _POWERS[key][:n], _POWERS[f"-{key}"][:n]


def parse(data: np.ndarray, bounds: list[tuple[int, int]], length: int
          ) -> tuple[Names, np.ndarray, np.ndarray, np.ndarray]:
    """Names of ``data`` and, of each trigger, its place and the first and last start of
    the strings that belong to it.  ``bounds``: the texts in ``data``."""
    names = Names(data)
    starts = np.concatenate([np.arange(a, b - length + 1) for a, b in bounds if b - a >= length]
                            or [np.empty(0, np.int64)])
    if not len(starts):
        return names, starts, starts, starts
    grams = names.of(np.arange(len(data) - GRAM + 1), GRAM)
    least = (grams >> U(24) << U(24)) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while width < REACH:  # least of `width` positions, the leftmost of equals
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    trigger = (least[starts] & U((1 << 24) - 1)).astype(np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (trigger[1:] != trigger[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    return names, trigger[first], starts[first], starts[last]


def pieces(texts: list[bytes | None], length: int) -> Iterator[tuple[np.ndarray, list, list]]:
    """The texts as one array, their bounds in it, and (row, offset) of each.  A text
    over PIECE is cut in pieces that overlap by length - 1 bytes."""
    data, bounds, owners, size = [], [], [], 0
    for row, text in enumerate(texts):
        for offset in range(0, max(1, len(text or b"") - length + 1), PIECE):
            part = (text or b"")[offset:offset + PIECE + length - 1]
            if size and size + len(part) > PIECE:
                yield np.frombuffer(b"".join(data), np.uint8), bounds, owners
                data, bounds, owners, size = [], [], [], 0
            data.append(part)
            bounds.append((size, size + len(part)))
            owners.append((row, offset))
            size += len(part)
    if data:
        yield np.frombuffer(b"".join(data), np.uint8), bounds, owners


def _alike(keys: list[np.ndarray]) -> np.ndarray:
    """Whether each of some sorted names equals the one before."""
    same = np.zeros(len(keys[0]), bool)
    if len(same):
        same[1:] = np.logical_and.reduce([k[1:] == k[:-1] for k in keys])
    return same


def fold(keys: list[np.ndarray], seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each name, whether it is met twice here already, and a salt.  Of equal names
    the first has salt 0 and goes to meet the others; the rest only pass through."""
    order = np.lexsort(keys)
    same = _alike([k[order] for k in keys])
    known = same.copy()
    known[:-1] |= same[1:]
    twice, salt = np.empty(len(order), bool), np.zeros(len(order), np.int32)
    twice[order] = known
    passing = np.flatnonzero(same)
    salt[order[passing]] = 1 + (passing * 7919 + seed) % 1_000_003
    return twice, salt


def _neighbours(width: int, columns: list[str]):
    """Rows (``width`` columns of a name, salt, known, ...) in order of name, those passing
    through last: adds ``twice``, whether the name is met twice, and ``lead``, whether the
    row is its first."""

    def names(batch: pa.RecordBatch) -> list[np.ndarray]:
        asked = batch.column(width).to_numpy() == 0
        return [batch.column(k).to_numpy()[asked] for k in range(width)]

    def judged(batch: pa.RecordBatch, last: list | None, later: list | None) -> pa.RecordBatch:
        through = batch.column(width).to_numpy() > 0
        known = batch.column(width + 1).to_numpy(zero_copy_only=False)
        asked = names(batch)
        same, first = np.zeros(len(asked[0]), bool), np.ones(len(asked[0]), bool)
        if len(same):
            ends = [k[0] for k in asked], [k[-1] for k in asked]
            before = _alike(asked)
            before[0] = last is not None and ends[0] == last
            first = ~before
            same = before.copy()
            same[:-1] |= before[1:]
            same[-1] |= later is not None and ends[1] == later
        twice, lead = known.copy(), ~through
        twice[~through] |= same
        lead[~through] = first
        return pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in columns), pa.array(twice), pa.array(lead)],
            names=[*columns, "twice", "lead"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                asked, own = names(batch), names(held)
                yield judged(held, last, [k[0] for k in asked] if len(asked[0]) else None)
                last = [k[-1] for k in own] if len(own[0]) else last
            held = batch
        if held is not None:
            yield judged(held, last, None)

    return trimmed(run)


def by_name(rows: DataFrame, width: int, partitions: int) -> DataFrame:
    """``rows`` (``width`` columns of a name, salt, ...) with equal names as neighbours in one
    partition; salted rows are dealt out."""
    name = rows.columns[:width]
    return rows.repartition(partitions, *name, "salt").sortWithinPartitions(
        F.col("salt") > 0, *name)


def met_twice(rows: DataFrame, width: int, columns: list[str], partitions: int) -> DataFrame:
    """``columns`` of ``rows`` (name, salt, known, ...), whether a row's name occurs
    twice, and whether the row is the first with it."""
    ddl = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in columns)
    return by_name(rows, width, partitions).mapInArrow(
        _neighbours(width, columns), f"{ddl}, twice boolean, lead boolean")


def _triggers(length: int, places: list[tuple[int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seed = 0
        for batch in batches:
            for rows, texts in chunks(batch, "text"):
                numbers = rows.column(0).to_numpy()
                for data, bounds, owners in pieces(texts, length):
                    names, trigger, lo, hi = parse(data, bounds, length)
                    if not len(lo):
                        continue
                    seed += 1
                    follow = names.of(trigger, length - REACH + 1).view(np.int64)
                    whole = Strong(data, places).of(
                        lo, hi - lo + length, (trigger - lo) * 65536 + hi - lo)
                    known, salt = fold([follow], int(numbers[0] & 0xFFFF) + seed)
                    own = np.searchsorted([a for a, _ in bounds], lo, "right") - 1
                    row = np.array([r for r, _ in owners])[own]
                    offset = np.array([o for _, o in owners])[own]
                    begin = np.array([a for a, _ in bounds])[own]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(follow), pa.array(salt), pa.array(known), *map(pa.array, whole),
                         pa.array(numbers[row]), pa.array(lo - begin + offset),
                         pa.array((hi - lo).astype(np.int16))],
                        names=["follow", "salt", "known", "whole", "whole2", "number", "lo", "more"])

    return trimmed(run)


def _shared_whole(columns: list[str]):
    """Of the rows whose name is met twice, ``whole`` as the next name, folded.  One
    function does both steps: chained ones would each hold a Python worker a task."""
    judge = _neighbours(1, ["whole", "whole2", *columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in judge(batches):
            batch = batch.filter(batch.column("twice"))
            if batch.num_rows:
                whole = [batch.column(k).to_numpy() for k in range(2)]
                known, salt = fold(whole, int(whole[0][0] & 0xFFFF))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(salt), pa.array(known),
                     *(batch.column(c) for c in columns)],
                    names=["whole", "whole2", "salt", "known", *columns])

    return run


def _spell(length: int, places: list[tuple[int, int]]):
    """One name for each string of the triggers in doubt."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seed = 0
        for batch in batches:
            for rows, texts in chunks(batch, "text", PIECE):
                starts, owner = [], []
                numbers = rows.column(0).to_numpy()
                hashes: list[list[np.ndarray]] = []
                doubts = rows.column(rows.schema.get_field_index("doubt")).to_pylist()
                for row, (text, doubt) in enumerate(zip(texts, doubts)):
                    for first, more in merged([(d["lo"], d["lo"] + d["more"]) for d in doubt]):
                        for at in range(first, more + 1, PIECE):
                            end = min(more, at + PIECE - 1)
                            part = np.frombuffer(text[at:end + length], np.uint8)
                            hashes.append(Strong(part, places).of(np.arange(end - at + 1), length))
                            starts.append(np.arange(at, end + 1))
                            owner.append(np.full(end - at + 1, row))
                if not starts:
                    continue
                seed += 1
                own = np.concatenate(owner)
                name = [np.concatenate(part) for part in zip(*hashes)]
                known, salt = fold(name, int(numbers[0] & 0xFFFF) + seed)
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, name), pa.array(salt), pa.array(known),
                     pa.array(numbers[own]), pa.array(np.concatenate(starts))],
                    names=["name", "name2", "salt", "known", "number", "lo"])

    return trimmed(run)


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of starts [first, last], sorted, with neighbours put together."""
    whole: list[tuple[int, int]] = []
    for first, last in sorted(runs):
        if whole and first <= whole[-1][1] + 1:
            whole[-1] = (whole[-1][0], max(whole[-1][1], last))
        else:
            whole.append((first, last))
    return whole


def _cut(length: int, as_text: bool):
    """The spans to remove, and what is left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in chunks(batch, "text"):
                found = rows.column(rows.schema.get_field_index("runs")).to_pylist()
                spans, kept = [], []
                for text, runs in zip(texts, found):
                    starts = merged([(r["lo"], r["lo"] + r["more"]) for r in runs or ()])
                    cover = merged([(a, b + length - 1) for a, b in starts])
                    spans.append([[a, b + 1] for a, b in cover])
                    ends = [0, *(x for a, b in cover for x in (a, b + 1)), len(text or b"")]
                    left = b"".join((text or b"")[a:b] for a, b in zip(ends[::2], ends[1::2]))
                    kept.append(left.decode("utf-8", "ignore") if as_text else left)
                skip = ("text", "runs")
                names = [n for n in rows.schema.names if n not in skip]
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(rows.schema.get_field_index(n)) for n in names),
                     pa.array(spans, pa.list_(pa.list_(pa.int64()))),
                     pa.array([len(t or b"") for t in texts], pa.int64()),
                     pa.array(kept, pa.string() if as_text else pa.binary())], names=[*names, "spans", "n_bytes", "kept"])

    return trimmed(run)


def without_repeats(docs: DataFrame, length: int = LENGTH, as_text: bool = False) -> DataFrame:
    """``docs`` with ``text`` (and old columns of these names) replaced by spans (removed
    byte runs [start, end)), n_bytes and kept: the bytes left, or as text, without
    characters that were cut in two."""
    if length < REACH + GRAM:
        raise ValueError(f"length must be at least {REACH + GRAM}")
    others = [c for c in docs.columns if c not in ("text", "spans", "n_bytes", "kept")]
    rows = stash(docs.select(
        F.monotonically_increasing_id().alias("number"),
        F.col("text").cast("string").cast("binary").alias("text"),
        F.struct(*others).alias("row")), "numbered")
    places = drawn_places()
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = ["follow", "number", "lo", "more"]
    types = "number long, lo long, more short"
    triggers = rows.select("number", "text").mapInArrow(
        _triggers(length, places),
        f"follow long, salt int, known boolean, whole long, whole2 long, {types}")
    asked = by_name(triggers, 1, width).mapInArrow(
        _shared_whole(place), f"whole long, whole2 long, salt int, known boolean, follow long, {types}")
    settled = stash(met_twice(asked, 2, place, width), "settled")
    doubtful = settled.where("NOT twice")
    asked_for = stash(doubtful.select("follow").distinct(), "asked")
    witness = settled.where("twice AND lead").join(asked_for, "follow", "left_semi")
    run = F.struct("lo", "more")
    doubts = stash(doubtful.unionByName(witness).groupBy("number").agg(
        F.collect_list(run).alias("doubt")), "doubts")
    spelt = with_lists(rows.select("number", "text"), doubts).mapInArrow(
        _spell(length, places),
        "name long, name2 long, salt int, known boolean, number long, lo long")
    found = met_twice(spelt, 2, ["number", "lo"], width).where("twice").select(
        "number", F.struct("lo", F.lit(0).cast("short").alias("more")).alias("run"))
    runs = stash(settled.where("twice").select("number", run.alias("run")).unionByName(found)
                 .groupBy("number").agg(F.collect_list("run").alias("runs")), "runs")
    none = F.lit(None).cast(runs.schema["runs"].dataType).alias("runs")
    whole = rows.join(small_enough(runs.select("number")), "number", "left_anti")
    cut = with_lists(rows, runs).select("row", "text", "runs").union(
        whole.select("row", "text", none))
    row_type = rows.schema["row"].dataType.simpleString()
    result = cut.mapInArrow(
        _cut(length, as_text), f"row {row_type}, spans array<array<long>>, n_bytes long, "
        f"kept {'string' if as_text else 'binary'}")
    return result.select("row.*", "spans", "n_bytes", "kept")


def with_lists(rows: DataFrame, lists: DataFrame) -> DataFrame:
    """``rows`` that have a list, with it; the others are left out before texts move."""
    return rows.join(small_enough(lists.select("number")), "number", "left_semi").join(lists, "number")


def repeat_digests(cut: DataFrame) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return cut.select("doc_id", "n_bytes", removed.alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))
