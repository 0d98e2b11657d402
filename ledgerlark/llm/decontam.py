"""Benchmark decontamination by Wu-Manber search over words.

Test strings are the runs of ``window`` consecutive words of the benchmark items (an
item with fewer words is one string).  For each string length a shift table tells, for
the two words that end the current position, how far the search may jump; a zero shift
leads to the suffix bucket of strings with those last words, and each is compared
directly.

The strings are broadcast in blocks of at most ``BLOCK_WORDS`` words, one after the
other; more benchmark text means more passes over the documents.  Each pass writes the
rows it hits, under a number that each row got once, and hits are united by that number.

Defined cases: null or empty texts have no words; an item without words has no string;
null items are ignored; repeated items count once; repeated documents get a row each.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import chunks, schema_with, stash

WINDOW = 10
BLOCK_WORDS = 2_000_000
#: A-Z in lower case; every other ASCII byte but 0-9 and a-z parts words.
_FOLD = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A
              else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))

Words = list[bytes]


def words_of(text: bytes | None) -> Words:
    return text.translate(_FOLD).split() if text else []


class WuManber:
    """Search for many word strings at once."""

    def __init__(self, strings: dict[tuple[bytes, ...], list[str]]):
        """strings: each word string with the items that hold it."""
        self.owners = strings
        by_length = defaultdict(list)
        for string in strings:
            by_length[len(string)].append(string)
        self.tables = []
        for length, found in sorted(by_length.items()):
            block = min(2, length)
            jump = length - block + 1
            shift: dict[tuple[bytes, ...], int] = {}
            bucket = defaultdict(list)
            for string in found:
                for end in range(block, length + 1):
                    key = string[end - block:end]
                    shift[key] = min(shift.get(key, jump), length - end)
                bucket[string[length - block:]].append(string)
            self.tables.append((length, block, jump, shift, dict(bucket)))

    def search(self, words: Words) -> Iterator[tuple[int, tuple[bytes, ...]]]:
        """(first word, string) of every occurrence."""
        for length, block, jump, shift, bucket in self.tables:
            end, last = length, len(words)
            while end <= last:
                key = tuple(words[end - block:end])
                step = shift.get(key, jump)
                if step:
                    end += step
                    continue
                here = tuple(words[end - length:end])
                for string in bucket[key]:
                    if string == here:
                        yield end - length, string
                end += 1


def strings_of(items: list[tuple[str, bytes | None]], window: int
               ) -> dict[tuple[bytes, ...], list[str]]:
    owners: dict[tuple[bytes, ...], set[str]] = defaultdict(set)
    for item, text in items:
        words = words_of(text)
        for start in range(max(1, len(words) - window + 1) if words else 0):
            owners[tuple(words[start:start + window])].add(item)
    return {string: sorted(ids) for string, ids in owners.items()}


def _blocks(benchmark: DataFrame, limit: int) -> Iterator[list[tuple[str, bytes | None]]]:
    """The benchmark in blocks of about ``limit`` words, one partition at a time."""
    block, size = [], 0
    rows = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(
        F.col("item_id").cast("string").alias("i"), F.col("text").cast("binary").alias("t"))
    for row in rows.toLocalIterator():
        block.append((row.i, bytes(row.t)))
        size += len(row.t) // 2 + 1
        if size >= limit:
            yield block
            block, size = [], 0
    yield block


def _scan(docs: DataFrame, shared: Broadcast, window: int) -> DataFrame:
    """``docs`` with n_words, spans and items; ``shared``: a block of the benchmark."""
    found = ("n_words", "spans", "items")
    names = [c for c in docs.columns if c not in found]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = WuManber(strings_of(shared.value, window))
        for batch in batches:
            for rows, texts in chunks(batch, "text"):
                counts, spans, items = [], [], []
                for text in texts:
                    words = words_of(text)
                    hits, ids = set(), set()
                    for start, string in search.search(words):
                        hits.add((start, start + len(string)))
                        ids.update(search.owners[string])
                    counts.append(len(words))
                    spans.append(united(sorted(hits)))
                    items.append(sorted(ids))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(counts, pa.int64()),
                     pa.array(spans, pa.list_(pa.list_(pa.int64()))),
                     pa.array(items, pa.list_(pa.string()))], names=[*names, *found])

    return docs.select(*names).mapInArrow(run, schema_with(
        docs, (), "n_words long", "spans array<array<long>>", "items array<string>"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                         block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` that hold no test string, one pass a block of strings.  Other
    columns travel in one struct, whatever their names."""
    others = F.struct(*(c for c in docs.columns if c != "text")).alias("others")
    kept, context = docs.select("text", others), docs.sparkSession.sparkContext
    for block in _blocks(benchmark, block_words):
        kept = _scan(kept, context.broadcast(block), window).where("size(spans) = 0").select(
            "text", "others")
    return kept.select(*(F.col(c) if c == "text" else F.col(f"others.`{c}`") for c in docs.columns))


def united(spans: list) -> list[list[int]]:
    """Sorted spans [start, end) with those that touch put together."""
    whole: list[list[int]] = []
    for start, end in spans:
        if whole and start <= whole[-1][1]:
            whole[-1][1] = max(whole[-1][1], end)
        else:
            whole.append([start, end])
    return whole


def united_column(spans: Column) -> Column:
    """``united`` of an array of spans, as an expression."""
    none = F.expr("CAST(array() AS array<array<bigint>>)")

    def add(whole: Column, span: Column) -> Column:
        last = F.element_at(whole, -1)
        longer = F.array(F.array(last[0], F.greatest(last[1], span[1])))
        return F.when((F.size(whole) > 0) & (span[0] <= F.try_element_at(whole, F.lit(-1))[1]),
                      F.concat(F.slice(whole, 1, F.size(whole) - 1), longer)
                      ).otherwise(F.concat(whole, F.array(span)))

    return F.aggregate(F.sort_array(spans), none, add)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, n_words, spans (hit word runs [start, end)) and items (sorted ids)."""
    texts = docs.select("doc_id", F.col("text").cast("string"))
    context = docs.sparkSession.sparkContext
    blocks = _blocks(benchmark, block_words)
    block, following = next(blocks), next(blocks, None)
    if following is None:
        return _scan(texts, context.broadcast(block), window).drop("text")
    rows = stash(texts.withColumn("_row", F.monotonically_increasing_id()), "rows")
    counted, hits = None, None
    while block is not None:
        shared = context.broadcast(block)
        found = _scan(rows, shared, window).drop("text")
        if counted is None:  # the first pass counts the words of all rows
            counted = found = stash(found, "counted")
        found = found.where("size(spans) > 0").select("_row", "spans", "items")
        hits = stash(found, "hits") if hits is None else hits.union(stash(found, "hits"))
        shared.destroy()  # the driver holds one block and the next
        block, following = following, next(blocks, None)
    joined = hits.groupBy("_row").agg(
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    joined = joined.select("_row", united_column(F.col("spans")).alias("spans"), "items")
    return counted.drop("spans", "items").join(joined, "_row", "left").select(
        "doc_id", "n_words", F.coalesce("spans", F.expr("CAST(array() AS array<array<long>>)")).alias("spans"),
        F.coalesce("items", F.expr("CAST(array() AS array<string>)")).alias("items"))


def hit_digests(found: DataFrame) -> DataFrame:
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"))
