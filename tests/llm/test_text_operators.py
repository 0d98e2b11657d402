"""Encoding, languages, decontamination, repeats and near duplicates on small texts."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from ledgerlark.llm import bpe, common, decontam, language, near_dup, repeats
from ledgerlark.llm.words import WordHashes, shingle_set, split_words

WORDS = [f"w{k}" for k in range(400)]
DOCS = "doc_id long, text string"


@pytest.fixture(scope="module")
def ranks():
    return bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture
def odd_rows():
    """Null and repeated ids, null, empty, blank and long texts."""
    long = " ".join(random.Random(5).choices(WORDS, k=6000))
    return [(1, None), (2, ""), (3, " \n\t "), (4, "Ünï x 日本 12!"), (4, "Ünï x 日本 12!"),
            (None, "plain text"), (5, long), (6, long), (7, "a" * 3000)]


def rows_of(df):
    return sorted(df.collect(), key=str)


def test_bpe_equals_the_reference_library(spark, ranks, odd_rows):
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                 special_tokens={})
    df = spark.createDataFrame(odd_rows, DOCS).withColumn("ids", F.lit("clash"))
    for row in bpe.encode(df, ranks, public_tokenizers.PATTERN).join(
            df.drop("ids"), "doc_id").collect():
        assert row.ids == encoding.encode_ordinary(row.text or "")
    digests = bpe.token_digests(df, ranks, public_tokenizers.PATTERN)
    want = sorted((i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in odd_rows if i)
    assert sorted((r.doc_id, r.decoded_sha256) for r in digests.collect() if r.doc_id) == want
    assert bpe.token_digests(df.limit(0), ranks, public_tokenizers.PATTERN).count() == 0


def test_merge_replay_on_random_words(ranks):
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                 special_tokens={})
    replay = bpe.MergeReplay(ranks, public_tokenizers.PATTERN)
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcdeé aaathing日1 ") for _ in range(40)) for _ in range(3000)]
    for text, ids in zip(texts, replay.encode(texts)):
        assert memoryview(ids).cast("i").tolist() == encoding.encode_ordinary(text)


def test_language_profiles(spark):
    rng = random.Random(1)
    letters = {"xx": "abcd", "yy": "dcef", "zz": "ßüäh"}
    rows = [(k, " ".join("".join(rng.choices(letters[lang], k=5)) for _ in range(40)), lang)
            for k, lang in enumerate(rng.choices(sorted(letters), k=150))]
    rows += [(900, None, "xx"), (901, "12 !?", "yy"), (902, "", None), (None, "abba baab", None)]
    out = {r.doc_id: r for r in language.language_id(
        spark.createDataFrame(rows, DOCS + ", lang string")).collect()}
    assert all(out[k].lang_pred == lang for k, _, lang in rows[:150])
    assert [out[k].lang_pred for k in (900, 901, 902)] == ["und"] * 3
    assert out[None].lang_pred == "xx" and 0 < out[None].score <= 1
    empty = spark.createDataFrame([], DOCS + ", lang string")
    assert language.language_id(empty).count() == 0


def test_decontamination_against_brute_force(spark):
    rng = random.Random(2)
    items = [(1, " ".join(rng.choices(WORDS[:30], k=14))), (2, "W1, w2-w3"), (3, None), (4, "?"),
             (10, " ".join(rng.choices(WORDS[:30], k=14))), (2, "W1, w2-w3")]
    docs = []
    for k in range(120):
        words = rng.choices(WORDS[:30], k=rng.randrange(60))
        if k % 3 == 0:
            source = items[rng.choice((0, 1, 4))][1].split(" ")
            at = rng.randrange(len(words) + 1)
            words[at:at] = source[:rng.randrange(8, 15)]
        docs.append((k, " ".join(words)))
    docs += [(500, None), (501, ""), (None, items[0][1]), (7, docs[7][1])]

    windows = {}
    for item, text in items:
        words = decontam.words_of((text or "").encode())
        for s in range(max(1, len(words) - 9) if words else 0):
            windows.setdefault(tuple(words[s:s + 10]), set()).add(str(item))
    want = []
    for doc, text in docs:
        words = decontam.words_of((text or "").encode())
        hit, ids = set(), set()
        for s in range(len(words)):
            for string, owners in windows.items():
                if tuple(words[s:s + len(string)]) == string:
                    hit.update(range(s, s + len(string)))
                    ids |= owners
        want.append((doc, len(words), len(hit), len(ids),
                     hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    docs_df = spark.createDataFrame(docs, DOCS).withColumn("spans", F.lit(1))
    items_df = spark.createDataFrame(items, "item_id long, text string")
    for block in (decontam.BLOCK_WORDS, 10):  # one pass, and several
        got = decontam.hit_digests(decontam.contamination(docs_df, items_df, block_words=block))
        assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
        clean = decontam.without_contaminated(docs_df, items_df, block_words=block)
        assert clean.columns == docs_df.columns
        assert clean.count() == sum(not w[5] for w in want)


def brute_repeats(texts, length):
    counts = {}
    for text in texts:
        for s in range(len(text) - length + 1):
            counts[text[s:s + length]] = counts.get(text[s:s + length], 0) + 1
    for text in texts:
        mask = bytearray(len(text))
        for s in range(len(text) - length + 1):
            if counts[text[s:s + length]] > 1:
                mask[s:s + length] = b"\1" * length
        kept = bytes(b for b, m in zip(text, mask) if not m)
        runs = sum(m > p for m, p in zip(mask, b"\0" + mask))
        yield len(text), sum(mask), runs, hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("length", [160, 400])
def test_repeats_against_brute_force(spark, length, monkeypatch):
    rng = random.Random(length)
    shared = [" ".join(rng.choices(WORDS, k=n)) for n in (40, 100, 250)]
    rows = []
    for k in range(60):
        parts = [" ".join(rng.choices(WORDS, k=rng.randrange(120)))]
        for _ in range(rng.randrange(4)):
            text = rng.choice(shared)
            a, b = sorted(rng.sample(range(len(text)), 2))
            parts += [text[a:b] if rng.random() < 0.5 else text, rng.choice("xyü")]
        rows.append((k, " ".join(parts)))
    rows += [(100, "ab" * 700), (101, "é" * 500), (102, None), (103, ""), (104, "b" * 150),
             (None, shared[2]), (5, rows[5][1]), (105, "z" * 401)]
    df = spark.createDataFrame(rows, DOCS).withColumn("spans", F.lit("clash")).repartition(5)
    got = repeats.repeat_digests(repeats.without_repeats(df.drop("spans"), length))
    want = zip((k for k, _ in rows), brute_repeats([(t or "").encode() for _, t in rows], length))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        ((k, *w) for k, w in want), key=str)
    assert repeats.without_repeats(df.limit(0), length).count() == 0


def brute_components(rows, percent):
    hashes = WordHashes()
    sets = {}
    for k, text in rows:
        if k is not None:
            sets[k] = set(shingle_set(hashes.of(split_words((text or "").encode())), 5).tolist())
    parent = {k: k for k in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), root(k)) for k in sets}


@pytest.mark.parametrize("percent, broadcast_ids", [(80, common.BROADCAST_IDS), (85, 0)])
def test_near_duplicates_against_brute_force(spark, percent, broadcast_ids, odd_rows, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_IDS", broadcast_ids)
    rng = random.Random(9)
    rows = [(1000 + k, t) for k, (_, t) in enumerate(odd_rows)]
    for group in range(12):
        words = rng.choices(WORDS, k=rng.choice((3, 40, 150)))
        for _ in range(8):
            copy = list(words)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = rng.choice(WORDS)
            rows.append((len(rows), " ".join(copy).title() if rng.random() < 0.3 else "\n".join(copy)))
    want = brute_components(rows, percent)
    df = spark.createDataFrame([*rows, (None, "plain text"), rows[3]], DOCS)
    out = near_dup.near_duplicates(df.withColumn("kept", F.lit(1)), percent).collect()
    assert len(out) == len(rows) + 2
    for r in out:
        if r.doc_id is None:
            assert (r.component_id, r.kept) == (None, True)
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id]
            assert r.kept == (r.doc_id == r.component_id)
    assert near_dup.near_duplicates(df.limit(0), percent).count() == 0


def test_an_id_with_two_texts_links_through_both(spark):
    """9 and 11, and 10 and 12, share 36 of 38 shingles; 5 has the texts of 9 and 10."""
    one, two = [f"a{k}" for k in range(41)], [f"b{k}" for k in range(41)]
    texts = {9: one, 11: [*one[:-1], "x"], 10: two, 12: [*two[:-1], "y"], 20: ["other"] * 9}
    rows = [(k, " ".join(t)) for k, t in texts.items()]
    alone = near_dup.near_duplicates(spark.createDataFrame(rows, DOCS), 85).collect()
    assert {r.doc_id: r.component_id for r in alone} == {9: 9, 11: 9, 10: 10, 12: 10, 20: 20}
    rows += [(5, " ".join(one)), (5, " ".join(two).upper()), (5, None)]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, DOCS).repartition(3), 85).collect()
    assert {(r.doc_id, r.component_id, r.kept) for r in got} == {
        (5, 5, True), (9, 5, False), (10, 5, False), (11, 5, False), (12, 5, False), (20, 20, True)}
    assert len(got) == len(rows)


def test_bands_keep_what_is_missed_below_one_bound():
    for percent, bands in ((85, 26), (80, 39), (50, 479)):
        assert near_dup.bands_for(percent) == bands
        assert (1 - (percent / 100) ** 5) ** bands <= near_dup.MISSED
