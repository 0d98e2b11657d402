"""Language identification by rank-order profiles.

A profile lists the most frequent character n-grams (1 to 3, of lower-cased words with
a space on each side) of a language, in order of frequency.  A document's own profile is
compared with each: every n-gram is out of place by the difference of its two ranks, or
by the profile's full length if the language does not list it.  The language with the
least sum is predicted.  Profiles are counted over all allowed documents.

Defined cases: null or letterless text is ``und`` with score 0; ties go to the smaller
n-gram and the smaller language name; without any profile all is ``und``; repeated rows
count and are predicted each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.llm.common import chunks, fold, schema_with

UNDETERMINED = "und"
PROFILE = 400
_SPACE = 32


@cache
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.array([0 <= c < 0xD800 or c > 0xDFFF for c in range(0x110000)]) & np.array(
        [chr(c).isalpha() for c in range(0x110000)])


def letters_of(text: bytes | None) -> np.ndarray:
    """Code points of the lower-cased words, with one space before, between and behind
    them; empty without letters."""
    lower = (text or b"").decode("utf-8", "replace").lower()
    code = np.frombuffer(lower.encode("utf-32-le", "replace"), np.uint32)
    code = np.where(_letters()[code], code, _SPACE)
    code = np.concatenate(([_SPACE], code, [_SPACE])).astype(np.uint64)
    blank = code == _SPACE
    code = code[~(blank & np.concatenate(([False], blank[:-1])))]
    return code if len(code) > 1 else code[:0]


def grams_of(code: np.ndarray) -> np.ndarray:
    """n-grams as 63-bit numbers; a space stands only at the ends of a word."""
    if len(code) < 3:
        return np.empty(0, np.uint64)
    blank = code == _SPACE
    one = code[~blank]
    two = code[:-1] << np.uint64(21) | code[1:]
    three = code[:-2] << np.uint64(42) | two[1:]
    return np.concatenate((one, two, three[~blank[1:-1]]))


def ranked(grams: np.ndarray, size: int) -> np.ndarray:
    """The most frequent n-grams, of equals the smaller first."""
    found, counts = np.unique(grams, return_counts=True)
    if len(found) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        found, counts = found[counts >= least], counts[counts >= least]
    return found[np.argsort(-counts, kind="stable")[:size]]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def flush() -> pa.RecordBatch:
        langs = [lang for lang, (g, _) in held.items() for _ in range(len(g))]
        parts = list(held.values()) or [(np.empty(0, np.uint64), np.empty(0, np.int64))]
        held.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()),
             pa.array(np.concatenate([g for g, _ in parts]).view(np.int64)),
             pa.array(np.concatenate([n for _, n in parts]).astype(np.int64))],
            names=["lang", "gram", "n"])

    for batch in batches:
        for rows, texts in chunks(batch, "text", 1 << 20):
            by_lang: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(rows.column(0).to_pylist(), texts):
                by_lang.setdefault(lang, []).append(grams_of(letters_of(text)))
            for lang, parts in by_lang.items():
                grams, counts = _tally(np.concatenate(parts))
                if lang in held:
                    grams = np.concatenate((held[lang][0], grams))
                    counts = np.concatenate((held[lang][1], counts))
                    grams, at = np.unique(grams, return_inverse=True)
                    counts = np.bincount(at, counts, len(grams)).astype(np.int64)
                held[lang] = grams, counts
        if sum(len(g) for g, _ in held.values()) > 500_000:
            yield flush()
    yield flush()


def _tally(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams and their counts; by direct address where the alphabet is small."""
    mask = np.uint64((1 << 21) - 1)
    seen = np.zeros(0x110000, bool)
    seen[(grams & mask).astype(np.int64)] = True
    seen[(grams >> np.uint64(42)).astype(np.int64)] = True
    seen[(grams >> np.uint64(21) & mask).astype(np.int64)] = True
    seen[0] = True
    alphabet = np.flatnonzero(seen)
    size = len(alphabet)
    if size**3 > 1 << 22:
        return np.unique(grams, return_counts=True)
    place = np.zeros(0x110000, np.int32)
    place[alphabet] = np.arange(size, dtype=np.int32)
    cell = (place[(grams >> np.uint64(42)).astype(np.int64)] * size
            + place[(grams >> np.uint64(21) & mask).astype(np.int64)]) * size \
        + place[(grams & mask).astype(np.int64)]
    counts = np.bincount(cell, minlength=size**3)
    used = np.flatnonzero(counts)
    letters = alphabet.astype(np.uint64)
    values = (letters[used // (size * size)] << np.uint64(42)
              | letters[used // size % size] << np.uint64(21) | letters[used % size])
    return values, counts[used]


class Profiles:
    """Ranks of every listed n-gram in each language."""

    def __init__(self, rows: list[tuple[str, int, int]], size: int):
        """rows: (language, n-gram, rank from 0)."""
        self.size = size
        self.langs = sorted({lang for lang, _, _ in rows})
        self.grams = np.array(sorted({gram for _, gram, _ in rows}), np.uint64)
        self.ranks = np.full((len(self.grams) + 1, len(self.langs)), -1, np.int64)
        if rows:
            at = np.searchsorted(self.grams, np.array([gram for _, gram, _ in rows], np.uint64))
            where = {lang: k for k, lang in enumerate(self.langs)}
            self.ranks[at, [where[lang] for lang, _, _ in rows]] = [rank for _, _, rank in rows]

    def predict(self, text: bytes | None) -> tuple[str, float, bool]:
        """Language, score, and whether there is any letter."""
        own = ranked(grams_of(letters_of(text)), self.size)
        if not len(own) or not self.langs:
            return UNDETERMINED, 0.0, len(own) > 0
        at = np.searchsorted(self.grams, own)
        at[at == len(self.grams)] = 0
        at = np.where(self.grams[at] == own, at, len(self.grams))  # the last row lists none
        ranks = self.ranks[at]
        apart = np.abs(ranks - np.arange(len(own))[:, None])
        sums = np.where(ranks < 0, self.size, apart).sum(axis=0)
        best = int(np.argmin(sums))
        return self.langs[best], float(1 - sums[best] / (self.size * len(own))), True


def learn(docs: DataFrame, allowed: Column, size: int = PROFILE) -> Profiles:
    """Profiles of the languages of the ``allowed`` rows, counted over all of them."""
    counted = docs.where(allowed & F.col("lang").isNotNull()).select(
        F.col("lang").cast("string"), F.col("text").cast("string")
    ).mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = counted.withColumn("place", place).where(F.col("place") <= size)
    return Profiles([(r.lang, r.gram, r.place - 1) for r in top.collect()], size)


def with_prediction(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """``docs`` with lang_pred, score and letters (whether there is any), from each row's
    text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(profiles)
    names = [c for c in docs.columns if c not in ("lang_pred", "score", "letters")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in chunks(batch, "text"):
                found = [shared.value.predict(t) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array([lang for lang, _, _ in found], pa.string()),
                     pa.array([score for _, score, _ in found], pa.float64()),
                     pa.array([letters for _, _, letters in found], pa.bool_())],
                    names=[*rows.schema.names, "lang_pred", "score", "letters"])

    return docs.select(*names).mapInArrow(
        run, schema_with(docs, (), "lang_pred string", "score double", "letters boolean"))


def language_id(docs: DataFrame, size: int = PROFILE) -> DataFrame:
    """doc_id, held_out, lang_pred, score; languages of held-out ids are never read."""
    held_out = fold("doc_id", 3) == 1
    profiles = learn(docs, ~held_out, size)
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return with_prediction(texts, profiles).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score")
