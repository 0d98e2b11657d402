"""Phrase collocations from depth-truncated suffix subtrees.

Texts fall into pieces at sentence marks and line ends, pieces into words.  Every word
begins a suffix of its piece, of which only the first LONGEST words matter.

1. One scan counts the words of each language and, by a 64-bit name, the pairs of
   neighbours; a second one the triples of which both pairs may be frequent.  Names met
   often enough set bits of a map of fixed size for each.  Names that share a bit only
   let more through: the maps save work and decide nothing.
2. A third scan reads each suffix only as far as its pairs and triples may be frequent
   (an elastic range), so no word of a frequent phrase is lost.  Equal suffixes are added
   up to leaves.
3. Vertical partitioning: leaves are counted by their first word; a prefix that holds
   more leaves than BUDGET is extended by one word, up to the full depth.  The prefixes
   are dealt out to as many groups as keep the mean group at half the budget.
4. Each group sorts its leaves, which is its part of the suffix tree: nodes are runs of
   neighbours with a common prefix, and the leaf totals below a node are its count.
   Nodes above a prefix that was extended are counted by the partitioning itself.

A cut's parts are nodes or words too, as a part occurs at least as often as the whole.
Scores are exact decimals of 38 digits.  A phrase is dropped for a longer one around it
of the same count; it then also has a same count one word longer, so only that is looked up.

Defined cases: null text is empty; null lang is ``und``; rows that repeat an id or a text
all count; very long texts are read in blocks; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.llm.common import chunks, stash
from ledgerlark.llm.words import WordHashes, mix

U = np.uint64
LONGEST = 5
LEAST = 100
TOP = 2000
BUDGET = 1 << 18  # leaves of a group
MAP_BITS = 26
BLOCK = 1 << 22
_HELD = 300_000
_MARK = b"\n"
_TABLE = bytes(0x0A if chr(c) in ".,;:!?\n\x0b\x0c\r" else 0x20 if c == 9 else c for c in range(256))
_ODD = U(0x9E3779B97F4A7C15)


def blocks(text: bytes | None, depth: int = LONGEST, size: int = BLOCK
           ) -> Iterator[tuple[list[bytes], int]]:
    """Words of a text with a mark between pieces, and how many of them begin suffixes
    here: the last ``depth - 1`` of a block come again before the next one."""
    held: list[bytes] = []
    start, length = 0, len(text or b"")
    while start < length:
        end = start + size
        if end < length:
            edges = [text.rfind(c, start, end) for c in (b" ", b"\t", b"\n", b".", b",")]
            end = max(edges) + 1 if max(edges) >= start else _word_end(text, end)
        part = text[start:end].lower().translate(_TABLE).replace(_MARK, b" \n ")
        held += filter(None, part.split(b" "))
        start = end
        if start >= length:
            yield held, len(held)
        elif len(held) >= depth:
            yield held, len(held) - depth + 1
            held = held[len(held) - depth + 1:]


def _word_end(text: bytes, at: int) -> int:
    """The end of a word that goes on at ``at``."""
    while at < len(text) and _TABLE[text[at]] not in (0x0A, 0x20):
        at += 1
    return at


def pair_names(words: list[bytes], hashes: WordHashes, lang: int
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names of the words and of the pairs (i, i + 1) of one language, and whether both
    are words."""
    own = hashes.of(words)
    word = own != U(hashes[_MARK])
    return own, mix(own[:-1] * _ODD + own[1:] + U(lang)), word[:-1] & word[1:]


def longer_names(names: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Names one word longer than ``names``, which start at the same places."""
    size = len(own) - len(names) + 1
    return mix(names[:len(own) - size] * _ODD + own[size:])


def in_map(names: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    at = (names >> U(64 - MAP_BITS)).astype(np.int64)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1) == 1


def _lang_name(lang: str) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode())


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, pair, n): counts of words (pair null) and of named pairs (word null)."""
    hashes = WordHashes()
    words: dict[str, Counter] = {}
    names: list[np.ndarray] = []
    waiting = 0

    def word_rows() -> Iterator[pa.RecordBatch]:
        for lang, counter in words.items():
            n = len(counter)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * n, pa.string()), pa.array(list(counter), pa.binary()),
                 pa.nulls(n, pa.int64()), pa.array(list(counter.values()), pa.int64())],
                names=["lang", "word", "pair", "n"])
        words.clear()

    def pair_rows() -> Iterator[pa.RecordBatch]:
        for pair, n in tallied(names):
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(n), pa.string()), pa.nulls(len(n), pa.binary()), pair, n],
                names=["lang", "word", "pair", "n"])

    for batch in batches:
        for rows, texts in chunks(batch, "text"):
            for lang, text in zip(rows.column(0).to_pylist(), texts):
                for tokens, starts in blocks(text):
                    own = words.setdefault(lang, Counter())
                    own.update(tokens[:starts])
                    own.pop(_MARK, None)
                    _, pair, both = pair_names(tokens, hashes, _lang_name(lang))
                    names.append(pair[:starts][both[:starts]])
                    waiting += len(names[-1])
            if sum(map(len, words.values())) > _HELD:
                yield from word_rows()
            if waiting > 1 << 22:
                yield from pair_rows()
                waiting = 0
    yield from word_rows()
    yield from pair_rows()


def tallied(names: list[np.ndarray]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Distinct names and how often each occurs; empties the list."""
    if names:
        name, n = np.unique(np.concatenate(names), return_counts=True)
        names.clear()
        yield pa.array(name.view(np.int64)), pa.array(n)


def _triples(pairs: bytes):
    """(pair, n): names of triples of which both pairs may be frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, bits = WordHashes(), np.frombuffer(pairs, np.uint8)
        names: list[np.ndarray] = []
        for batch in batches:
            for rows, texts in chunks(batch, "text"):
                for lang, text in zip(rows.column(0).to_pylist(), texts):
                    for tokens, starts in blocks(text):
                        own, pair, both = pair_names(tokens, hashes, _lang_name(lang))
                        go = both & in_map(pair, bits)
                        if len(go) > 1:
                            names.append(longer_names(pair, own)[:starts][(go[:-1] & go[1:])[:starts]])
                if sum(map(len, names)) > 1 << 21:
                    yield from (pa.RecordBatch.from_arrays(list(t), names=["pair", "n"])
                                for t in tallied(names))
        yield from (pa.RecordBatch.from_arrays(list(t), names=["pair", "n"]) for t in tallied(names))

    return run


def _leaves(pairs: bytes, triples: bytes, depth: int):
    """(lang, suffix, n): suffixes as far as their pairs and triples may be frequent, two
    words at least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        maps = [np.frombuffer(m, np.uint8) for m in (pairs, triples)]
        found: dict[str, Counter] = {}

        def rows_out() -> Iterator[pa.RecordBatch]:
            for lang, counter in found.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(counter), pa.string()), pa.array(list(counter), pa.binary()),
                     pa.array(list(counter.values()), pa.int64())], names=["lang", "suffix", "n"])
            found.clear()

        for batch in batches:
            for rows, texts in chunks(batch, "text"):
                for lang, text in zip(rows.column(0).to_pylist(), texts):
                    for tokens, starts in blocks(text, depth):
                        own, pair, both = pair_names(tokens, hashes, _lang_name(lang))
                        go = both & in_map(pair, maps[0])
                        on = np.zeros(len(go), bool)  # the suffix goes on after its pair
                        if len(go) > 1:
                            on[:-1] = go[:-1] & go[1:] & in_map(longer_names(pair, own), maps[1])
                        reach = go.astype(np.int8)  # words to read after the first one
                        for _ in range(depth - 2):
                            after = np.append(reach[1:], np.int8(0))
                            reach = np.where(on, np.minimum(after + 1, depth - 1), go).astype(np.int8)
                        counter = found.setdefault(lang, Counter())
                        places = np.flatnonzero(reach[:starts])
                        counter.update(b" ".join(tokens[i:i + n + 1]) for i, n in zip(
                            places.tolist(), reach[places].tolist()))
                if sum(map(len, found.values())) > _HELD:
                    yield from rows_out()
        yield from rows_out()

    return run


def frequent_names(counts: DataFrame, least: int) -> bytes:
    """The map of the names that are met ``least`` times: 2^MAP_BITS bits, of which
    at most 2^(MAP_BITS - 6) words come to the driver, whatever the corpus."""
    bit = F.shiftrightunsigned("pair", 64 - MAP_BITS)
    words = counts.where("pair IS NOT NULL").groupBy("pair").agg(F.sum("n").alias("n")).where(
        F.col("n") >= least).select(bit.alias("bit")).groupBy((F.col("bit").bitwiseAND(
            ~63)).alias("first")).agg(F.bit_or(F.call_function(
                "shiftleft", F.lit(1).cast("long"), F.col("bit").bitwiseAND(63).cast("int")
            )).alias("bits")).toArrow()
    bitmap = np.zeros(1 << (MAP_BITS - 6), np.int64)
    bitmap[words.column("first").to_numpy() >> 6] = words.column("bits").to_numpy()
    return bitmap.astype("<i8").tobytes()


def _first_words(column: str, n: int | Column) -> Column:
    """The first ``n`` words of a phrase, or all if it has fewer."""
    return F.call_function("substring_index", F.col(column), F.lit(" "),
                           n if isinstance(n, Column) else F.lit(n))


def _size(column: str) -> Column:
    return F.length(column) - F.length(F.replace(F.col(column), F.lit(" "), F.lit(""))) + 1


def partitioned(leaves: DataFrame, depth: int, budget: int) -> tuple[DataFrame, DataFrame]:
    """``leaves`` with the prefix that each belongs to, and the counts (lang, phrase, f) of
    the prefixes that were extended.

    A prefix is extended while more than ``budget`` leaves begin with it: at most
    leaves / budget prefixes a depth, joined by broadcast only below a counted bound."""
    above = None
    placed = leaves.withColumn("prefix", _first_words("suffix", 1))
    for size in range(1, depth):
        heavy = placed.where(_size("prefix") == size).groupBy("lang", "prefix").agg(
            F.count("*").alias("leaves"), F.sum("n").alias("f")).where(F.col("leaves") > budget)
        heavy = stash(heavy.select("lang", "prefix", "f"), "heavy")
        number = heavy.count()
        if not number:
            break
        phrases = heavy.select("lang", F.col("prefix").alias("phrase"), "f")
        above = phrases if above is None else above.unionByName(phrases)
        listed = heavy.select("lang", "prefix", F.lit(True).alias("long"))
        listed = F.broadcast(listed) if number <= 1 << 16 else listed
        longer = F.when(F.col("long"), _first_words("suffix", size + 1)).otherwise(F.col("prefix"))
        # A leaf that is the prefix itself has no node below it.
        placed = placed.join(listed, ["lang", "prefix"], "left").where(
            "long IS NULL OR suffix <> prefix").select(
            "lang", "suffix", "n", longer.alias("prefix"))
    if above is None:
        above = leaves.limit(0).select("lang", F.col("suffix").alias("phrase"), F.col("n").alias("f"))
    return placed, above


def subtree_counts(suffixes: list[bytes], totals: np.ndarray, prefixes: list[bytes], depth: int,
                   least: int) -> Iterator[tuple[bytes, int]]:
    """Nodes (phrase, count) of a subtree, two words deep at least and not above the
    prefix of their leaves; its leaves come in byte order of their words."""
    words = [s.split(b" ") for s in suffixes]
    sizes = np.array([len(w) for w in words])
    top = np.array([p.count(b" ") + 1 for p in prefixes])
    for size in range(2, depth + 1):
        inside = np.flatnonzero((sizes >= size) & (top <= size))
        if not len(inside):
            continue
        heads = [words[i][:size] for i in inside]
        first = np.flatnonzero([k == 0 or heads[k] != heads[k - 1] for k in range(len(heads))])
        sums = np.add.reduceat(totals[inside], first)
        for k in np.flatnonzero(sums >= least):
            yield b" ".join(heads[first[k]]), int(sums[k])


def _subtree(depth: int, least: int):
    def run(rows: pa.Table) -> pa.Table:
        langs, suffixes, n, prefixes = (rows.column(c).to_pylist()
                                        for c in ("lang", "suffix", "n", "prefix"))
        totals = np.array(n, np.int64)
        order = sorted(range(len(langs)), key=lambda i: (langs[i], suffixes[i].split(b" ")))
        out: list[tuple[str, bytes, int]] = []
        start = 0
        while start < len(order):
            end = start
            while end < len(order) and langs[order[end]] == langs[order[start]]:
                end += 1
            own = order[start:end]
            out += [(langs[own[0]], phrase, f) for phrase, f in subtree_counts(
                [suffixes[i] for i in own], totals[own], [prefixes[i] for i in own], depth, least)]
            start = end
        lang, phrase, f = zip(*out) if out else ((), (), ())
        return pa.table({"lang": pa.array(lang, pa.string()), "phrase": pa.array(phrase, pa.binary()),
                         "f": pa.array(f, pa.int64())})

    return run


def phrase_counts(docs: DataFrame, depth: int = LONGEST, least: int = LEAST, budget: int = BUDGET
                  ) -> tuple[DataFrame, DataFrame]:
    """(lang, n): words of each language; (lang, phrase, f): words and phrases of up to
    ``depth`` words that occur ``least`` times."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                        F.col("text").cast("string").cast("binary").alias("text"))
    counts = texts.mapInArrow(_count, "lang string, word binary, pair long, n long").groupBy(
        "lang", "word", "pair").agg(F.sum("n").alias("n"))
    counts = stash(counts.where((F.col("n") >= least) | F.col("word").isNotNull()), "counts")
    words = counts.where("word IS NOT NULL")
    sizes = stash(words.groupBy("lang").agg(F.sum("n").alias("n")), "sizes")
    pairs = frequent_names(counts, least)
    triples = frequent_names(texts.mapInArrow(_triples(pairs), "pair long, n long"), least)
    leaves = stash(texts.mapInArrow(
        _leaves(pairs, triples, depth), "lang string, suffix binary, n long"
    ).groupBy("lang", "suffix").agg(F.sum("n").alias("n")).select(
        "lang", F.col("suffix").cast("string").alias("suffix"), "n"), "leaves")
    placed, above = partitioned(leaves, depth, budget)
    groups = 1 + 2 * leaves.count() // budget
    group = F.pmod(F.xxhash64("lang", "prefix"), F.lit(groups))
    nodes = placed.select(
        group.alias("group"), "lang", F.col("suffix").cast("binary").alias("suffix"), "n",
        F.col("prefix").cast("binary").alias("prefix")).groupBy("group").applyInArrow(
        _subtree(depth, least), "lang string, phrase binary, f long")
    single = words.where(F.col("n") >= least).select(
        "lang", F.col("word").cast("string").alias("phrase"), F.col("n").alias("f"))
    longer = nodes.select("lang", F.col("phrase").cast("string").alias("phrase"), "f").unionByName(
        above.where((_size("phrase") > 1) & (F.col("f") >= least)))
    return sizes, stash(single.unionByName(longer), "phrases")


def collocations(docs: DataFrame, depth: int = LONGEST, least: int = LEAST, top: int = TOP,
                 budget: int = BUDGET) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the ``top`` phrases of each language in
    ``docs`` (lang, text)."""
    sizes, counted = phrase_counts(docs, depth, least, budget)
    phrases = counted.withColumn("size", _size("phrase")).where("size > 1")
    shorter = phrases.where("size > 2").select("lang", "f", F.explode(F.array(
        _first_words("phrase", F.col("size") - 1),
        _first_words("phrase", 1 - F.col("size")))).alias("phrase"))
    inside = shorter.groupBy("lang", "phrase").agg(F.max("f").alias("around"))
    kept = phrases.join(inside, ["lang", "phrase"], "left").where("around IS NULL OR around < f")
    cuts = kept.select("lang", "phrase", "f", "size",
                       F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.withColumns({"left": _first_words("phrase", F.col("k")),
                             "right": _first_words("phrase", F.col("k") - F.col("size"))})
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(counted.select("lang", F.col("phrase").alias(side),
                                        F.col("f").alias(name)), ["lang", side])
    cuts = cuts.join(sizes, "lang")
    score = F.expr("(CAST(1000 AS DECIMAL(4,0)) * f * n) DIV (CAST(l AS DECIMAL(19,0)) * r)")
    best = cuts.withColumn("score", score).groupBy("lang", "phrase", "f", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(
        F.desc("cut.score"), F.desc("f"), "phrase"))
    return best.withColumn("rank", rank).where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", F.col("f").alias("a"),
        "cut.l", "cut.r", "n", "cut.score")
