"""Phrase counts, scores and dropped phrases against brute force."""

import random
import re
from collections import Counter, defaultdict

import pytest

from ledgerlark.llm import collocations
from ledgerlark.llm.collocations import blocks, subtree_counts

DOCS = "doc_id long, text string, lang string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces_of(text):
    for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
        yield [w for w in re.split("[ \t]+", piece) if w]


def brute_force(rows, depth, least, top):
    counts, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        for words in pieces_of(text):
            n[lang or "und"] += len(words)
            for k in range(1, depth + 1):
                counts[lang or "und"].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        own = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        around = defaultdict(int)
        for p, a in own.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    around[p[i:i + k]] = max(around[p[i:i + k]], a)
        scored = []
        for p, a in own.items():
            if around[p] >= a:
                continue
            score, k = min((1000 * a * n[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def sentences(rng, n, words):
    return " ".join(rng.choice(["new york city", "the", "of the", "a", "Red", "é ü"] + words)
                    + rng.choice([" ", "", ",", ".\n", " \t"]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    words = [f"w{k}" for k in range(30)]
    out = [(k, sentences(rng, rng.randint(0, 80), words), rng.choice(["en", "fr", None, "und"]))
           for k in range(200)]
    out += [(1, None, "en"), (2, "", "fr"), (None, " \t .,", "xx"), (3, out[3][1], out[3][2]),
            (4, "dup " * 3000, "en"), (5, "new york city " * 400, "en")]
    return out


@pytest.mark.parametrize("depth, least, budget", [(5, 4, 1 << 18), (5, 4, 20), (3, 2, 5), (2, 10, 1)])
def test_collocations_equal_brute_force(spark, rows, depth, least, budget):
    df = spark.createDataFrame(rows, DOCS).repartition(3).selectExpr("*", "1 AS n", "2 AS suffix")
    got = collocations.collocations(df, depth, least, 50, budget)
    assert sorted(map(tuple, got.collect())) == brute_force(rows, depth, least, 50)


def test_empty_table_and_no_frequent_phrase(spark):
    assert collocations.collocations(spark.createDataFrame([], DOCS)).count() == 0
    few = spark.createDataFrame([(1, "a b c", "en")], DOCS)
    assert collocations.collocations(few).count() == 0


@pytest.mark.parametrize("size", [1, 7, 64])
def test_blocks_of_a_long_text_begin_each_suffix_once(size):
    rng = random.Random(size)
    text = sentences(rng, 300, ["x" * 40, "b"]).encode()
    whole = [(tokens[i:i + 5]) for tokens, n in blocks(text) for i in range(n)]
    assert [s for tokens, n in blocks(text, 5, size) for s in (tokens[i:i + 5] for i in range(n))
            ] == whole


def test_products_beyond_64_bits_stay_exact(spark):
    a, n, left, right = 3 * 10**14, 9 * 10**16, 7 * 10**14, 5 * 10**15
    row = spark.sql(f"SELECT (CAST(1000 AS DECIMAL(4,0)) * {a}L * {n}L) DIV "
                    f"(CAST({left}L AS DECIMAL(19,0)) * {right}L) AS s").first()
    assert row.s == 1000 * a * n // (left * right)


def test_subtree_totals():
    import numpy as np

    leaves = [b"a b", b"a b c", b"a b d", b"a c"]
    got = dict(subtree_counts(leaves, np.array([2, 3, 4, 5]), [b"a"] * 4, 5, 3))
    assert got == {b"a b": 9, b"a c": 5, b"a b c": 3, b"a b d": 4}
