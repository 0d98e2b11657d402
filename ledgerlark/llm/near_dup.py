"""Near-duplicate groups by MinHash bands and odd sketches.

Each distinct word sequence is one class, with a number of its own; documents, and ids
that stand on several texts, are put together by their classes.
Classes whose MinHash values agree in one band meet in a bucket.  A candidate pair is
first judged by its odd sketches: every MinHash sample flips one bit of a bitmap, so
the bits in which two bitmaps differ are at most twice the samples that differ.  Pairs
beyond what the asked similarity allows (chance below 1e-9) go; all others are
confirmed on their full shingle sets.

Buckets are never paired off whole.  First each member meets the bucket's least member
(one pair a member), and the confirmed links are contracted to components.  Only
buckets that still hold several components are compared further, block by block, and
only across components: a link within one cannot change the result.  There the sets are
intersected in place, so that a large group of almost-duplicates costs no emitted pairs.

There are as many bands as make a pair at the asked similarity share none with chance
MISSED at most: 26 at 85 %, 39 at 80 %.

Defined cases: texts without words (null, empty, blank) have no shingles and stand
alone; rows with one doc_id are one document and each gets a row with the size of its own
text, and the links of all its texts; a null doc_id links with nothing (component_id
null, kept true); other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil, comb, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import chunks, small_enough, stash
from ledgerlark.llm.components import connected_components
from ledgerlark.llm.words import WordHashes, mix, shingle_set, split_words

U = np.uint64
SHINGLE_WORDS = 5
BAND_ROWS = 5
MISSED = 2.5e-7
SKETCH_BITS = 1024
BLOCK_MEMBERS, BLOCK_SHINGLES = 512, 200_000


def bands_for(percent: int, missed: float = MISSED) -> int:
    """Bands of BAND_ROWS samples of which a pair at ``percent`` shares one, but for the
    chance ``missed``."""
    alike = min(max(percent, 1), 99) / 100
    return ceil(log(missed) / log(1 - alike**BAND_ROWS))


def most_differing_bits(percent: int, chance: float = 1e-9) -> int:
    """Bits by which two sketches of documents at ``percent`` similarity differ at
    most, but for ``chance``: two for each differing sample."""
    miss = 1 - percent / 100
    hashes = bands_for(percent) * BAND_ROWS
    tail, samples = 1.0, 0
    for samples in range(hashes + 1):
        tail -= comb(hashes, samples) * miss**samples * (1 - miss) ** (hashes - samples)
        if tail < chance:
            break
    return 2 * samples


def min_hashes(shingles: np.ndarray, hashes: int) -> np.ndarray:
    seeds = mix(np.arange(1, 2 * hashes + 1, dtype=np.uint64) * U(0x9E3779B97F4A7C15))
    flip, times = seeds[:hashes, None], seeds[hashes:, None] | U(1)
    least = np.full(hashes, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 2048):
        part = (shingles[None, start:start + 2048] ^ flip) * times
        np.minimum(least, part.min(axis=1), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    bands = len(least) // BAND_ROWS
    value = np.arange(1, bands + 1, dtype=np.uint64)
    for k in range(BAND_ROWS):
        value = mix(value * U(0x9E3779B97F4A7C15) + least.reshape(bands, BAND_ROWS)[:, k])
    return value.view(np.int64)


def odd_sketch(least: np.ndarray) -> bytes:
    """Parity of the samples that fall on each bit."""
    bits = mix(least + np.arange(len(least), dtype=np.uint64) * U(0x632BE59BD9B4E019))
    parity = np.bincount((bits % U(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(parity.astype(np.uint8)).tobytes()


def content_of(words: list[bytes]) -> bytes | None:
    """What a word sequence is known by."""
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest() if words else None


def _sign(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, samples = WordHashes(), bands_for(percent) * BAND_ROWS
        for batch in batches:
            for rows, texts in chunks(batch, "text"):
                counts, contents, keys, sketches = [], [], [], []
                for text in texts:
                    words = split_words(text)
                    shingles = shingle_set(hashes.of(words), SHINGLE_WORDS)
                    counts.append(len(shingles))
                    contents.append(content_of(words))
                    if not words:
                        keys.append(None), sketches.append(None)
                        continue
                    least = min_hashes(shingles, samples)
                    keys.append(band_keys(least))
                    sketches.append(odd_sketch(least))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(counts, pa.int64()), pa.array(contents, pa.binary()),
                     pa.array(keys, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
                    names=["doc_id", "n_shingles", "content", "bands", "sketch"])

    return run


def signatures(docs: DataFrame, percent: int) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _sign(percent),
        "doc_id long, n_shingles long, content binary, bands array<long>, sketch binary")


def _with_content(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, texts in chunks(batch, "text"):
            contents = [content_of(split_words(t)) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(contents, pa.binary())],
                names=[*rows.schema.names, "content"])


def _plausible(size_a: str, size_b: str, percent: int) -> str:
    """The smaller set holds at least the asked share of the larger one."""
    return f"100 * least({size_a}, {size_b}) >= {percent} * greatest({size_a}, {size_b})"


def _differing_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint64)
                .reshape(batch.num_rows, -1) for k in (2, 3))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1),
             pa.array(np.bitwise_count(a ^ b).sum(axis=1).astype(np.int32))],
            names=["a", "b", "bits"])


def likely(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose set sizes and odd sketches allow the similarity."""
    for side in ("a", "b"):
        pairs = pairs.join(nodes.select(
            F.col("id").alias(side), F.col("n").alias(f"n_{side}"),
            F.col("sketch").alias(f"s_{side}")), side)
    close = pairs.where(_plausible("n_a", "n_b", percent)).select("a", "b", "s_a", "s_b")
    return close.mapInArrow(_differing_bits, "a long, b long, bits int").where(
        F.col("bits") <= most_differing_bits(percent)).select("a", "b")


def confirm(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of which the full shingle sets have the asked similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        held: tuple[bytes | None, np.ndarray] = (None, np.empty(0, np.uint64))
        for batch in batches:
            keep = []
            for row in range(batch.num_rows):
                text_a, text_b = (batch.column(k)[row].as_py() for k in (2, 3))
                if text_a != held[0]:
                    held = (text_a, shingle_set(hashes.of(split_words(text_a)), SHINGLE_WORDS))
                other = shingle_set(hashes.of(split_words(text_b)), SHINGLE_WORDS)
                common = len(np.intersect1d(held[1], other, assume_unique=True))
                union = len(held[1]) + len(other) - common
                keep.append(100 * common >= percent * union > 0)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    for side in ("b", "a"):
        pairs = pairs.join(texts.select(F.col("id").alias(side),
                                        F.col("text").alias(f"t_{side}")), side)
    return pairs.select("a", "b", "t_a", "t_b").mapInArrow(run, "a long, b long")


def common_counts(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Set bits that a row has in common with each of many rows."""
    return np.bitwise_count(many & one).sum(axis=1, dtype=np.int64)


def incidence(sets: list[np.ndarray]) -> np.ndarray:
    """One row of bits for each set: the members it has of all."""
    members = np.unique(np.concatenate(sets))
    bits = np.zeros((len(sets), -(-len(members) // 64) * 64), np.uint8)
    for row, one in enumerate(sets):
        bits[row, np.searchsorted(members, one)] = 1
    return np.packbits(bits, axis=1).view(np.uint64)


def _across(percent: int):
    """Links between members of two blocks of one bucket (or of one) that lie in other
    components; a pair is looked at in the first band it shares only."""
    bits_allowed, bands = most_differing_bits(percent), bands_for(percent)

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        ids, comps, n, side, band = (rows.column(c).to_numpy()
                                     for c in ("id", "comp", "n", "side", "band"))
        sketch = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint64)
        sketch = sketch.reshape(len(ids), -1)
        keys = rows.column("bands").chunk(0).flatten().to_numpy().reshape(len(ids), bands)
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        likely: list[tuple[int, np.ndarray]] = []
        for i in left:
            j = right[(comps[right] != comps[i]) & ((side[i] != 2) | (ids[right] > ids[i]))]
            j = j[100 * np.minimum(n[j], n[i]) >= percent * np.maximum(n[j], n[i])]
            j = j[np.bitwise_count(sketch[j] ^ sketch[i]).sum(axis=1) <= bits_allowed]
            j = j[np.argmax(keys[j] == keys[i], axis=1) == band[i]]
            if len(j):
                likely.append((i, j))
        a, b = [], []
        if likely:
            used = np.unique(np.concatenate([np.append(j, i) for i, j in likely]))
            hashes = WordHashes()
            texts = rows.column("text").take(pa.array(used)).to_pylist()
            bits = incidence([shingle_set(hashes.of(split_words(t)), SHINGLE_WORDS)
                              for t in texts])
            for i, j in likely:
                common = common_counts(bits[np.searchsorted(used, i)],
                                       bits[np.searchsorted(used, j)])
                j = j[100 * common >= percent * (n[i] + n[j] - common)]
                a.extend(np.minimum(ids[j], ids[i]).tolist())
                b.extend(np.maximum(ids[j], ids[i]).tolist())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def across_components(buckets: DataFrame, nodes: DataFrame, texts: DataFrame, comps: DataFrame,
                      percent: int) -> DataFrame:
    """Links between members of one bucket but different components.

    A bucket is cut into blocks of about BLOCK_MEMBERS members and BLOCK_SHINGLES
    shingles; every two blocks meet once and emit links only.
    """
    labelled = buckets.join(comps.withColumnRenamed("component", "comp"), "id", "left").select(
        "key", "band", "id", F.coalesce("comp", "id").alias("comp"))
    labelled = stash(labelled.join(nodes.select("id", "n"), "id"), "labelled")
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK_MEMBERS, F.sum("n") / BLOCK_SHINGLES))
    mixed = stash(labelled.groupBy("key").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), blocks.alias("blocks")
    ).where("lo != hi").select("key", "blocks"), "mixed")
    members = labelled.join(mixed, "key").withColumn("block", F.pmod(F.xxhash64("id"), "blocks"))
    members = members.join(nodes.drop("n"), "id").join(texts, "id").withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    placed = members.select(
        "id", "comp", "n", "band", "bands", "sketch", "text", "key",
        F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"),
        F.expr("CASE WHEN block = other THEN 2 WHEN block < other THEN 0 ELSE 1 END").alias("side"))
    return placed.groupBy("key", "p", "q").applyInArrow(_across(percent), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of ``docs`` (doc_id, text):
    documents whose shingle sets share ``percent`` of their union are linked."""
    signed = stash(signatures(docs, percent), "signatures")
    able = signed.where("content IS NOT NULL AND doc_id IS NOT NULL")
    classes = able.groupBy("content").agg(F.min("doc_id").alias("doc_id"))
    classes = stash(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    nodes = signed.join(classes, ["doc_id", "content"]).select(
        "id", F.col("n_shingles").alias("n"), "bands", "sketch")
    rows = nodes.select("id", F.posexplode("bands").alias("band", "key"))
    # Written, so that the joins on it have plain shuffles, whose hot keys Spark splits.
    shared = stash(rows.groupBy("key").agg(
        F.min("id").alias("least"), F.max("id").alias("most")
    ).where("least != most").select("key", "least"), "shared")
    buckets = stash(rows.join(shared, "key").select("key", "band", "id", "least"), "buckets")
    met = stash(buckets.select("id").distinct(), "met")
    nodes = stash(nodes.dropDuplicates(["id"]).join(small_enough(met), "id"), "nodes")
    texts = stash(class_texts(docs, classes.join(small_enough(met), "id", "left_semi")), "texts")

    first = buckets.where("id != least").select(
        F.col("least").alias("a"), F.col("id").alias("b")).distinct()
    links = stash(confirm(likely(first, nodes, percent), texts, percent), "confirmed")
    links = stash(links.union(links_by_id(able, classes)), "confirmed")
    comps = stash(connected_components(links), "components")
    more = stash(across_components(
        buckets.select("key", "band", "id"), nodes, texts, comps, percent), "links")
    if more.take(1):
        comps = stash(connected_components(links.union(more)), "components")

    named = classes.join(comps, "id", "left").select(
        "content", "doc_id", F.coalesce("component", "id").alias("component"))
    least = named.groupBy("component").agg(F.min("doc_id").alias("least"))
    known = named.join(least, "component").select("content", "least")
    return signed.select("doc_id", "n_shingles", "content").join(known, "content", "left").select(
        "doc_id", "n_shingles",
        F.expr("CASE WHEN doc_id IS NOT NULL THEN coalesce(least, doc_id) END"
               ).alias("component_id"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def class_texts(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(id, text): one text of each of some ``classes`` (id, doc_id, content).  Only texts
    under the ids of classes move."""
    ids = small_enough(stash(classes.select("doc_id").distinct(), "class-ids"))
    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    named = own.join(ids, "doc_id", "left_semi").mapInArrow(
        _with_content, "doc_id long, text binary, content binary")
    return named.join(classes, ["doc_id", "content"]).dropDuplicates(["doc_id", "content"]).select(
        "id", "text")


def links_by_id(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of an id that stands on several texts."""
    pairs = rows.select("doc_id", "content").distinct()
    least = pairs.groupBy("doc_id").agg(
        F.min("content").alias("least"), F.count("*").alias("n")).where("n > 1")
    both = pairs.join(least.select("doc_id", "least"), "doc_id").where("content <> least")
    for name, column in (("a", "least"), ("b", "content")):
        both = both.join(classes.select(F.col("content").alias(column), F.col("id").alias(name)),
                         column)
    return both.select("a", "b").distinct()
