"""Token counts against the library on whole texts."""

import json
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlark.llm import token_counts
from ledgerlark.llm.token_counts import Counter, cut_points, cuttable, segments

PATH = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string"


@pytest.fixture(scope="module")
def source():
    with open(PATH, encoding="utf-8") as file:
        return file.read()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def size(library, text):
    return len(library.encode(text or "", add_special_tokens=False))


def mixed(rng, n):
    parts = ["word", " ", "  ", "\n", "\n \n", "it's", "don't 've", "12", "3.5", "日本", "é", "ß ",
             "<|endoftext|>", "<|endof", "text|>", "!!", " ?", "\t", " ", "  x", "𝒳",
             "́", "'s", "' s", "\x85", "\x1c"]
    return "".join(rng.choice(parts) for _ in range(n))


def test_segments_of_odd_texts_count_as_the_whole(source, library):
    counter, rng = Counter(source), random.Random(1)
    texts = [mixed(rng, rng.randint(0, 60)) for _ in range(3000)] + ["", " ", "a", " a", "a  b "]
    assert counter.count_all(texts) == [size(library, t) for t in texts]
    assert segments("a b  c\n d, e") == ["a", "b  c\n d,", "e"]


def test_every_character_at_a_segment_edge(source, library):
    counter = Counter(source)
    chars = [chr(c) for c in [*range(0x3100), *range(0xFE00, 0xFF70), *range(0x1F600, 0x1F650)]]
    texts = [f"x {c} y {c}{c} 1{c} {c}a" for c in chars]
    whole = library.encode_batch(texts, add_special_tokens=False)
    assert counter.count_all(texts) == [len(e) for e in whole]


def test_chunks_start_at_characters():
    text = ("aé日𝒳" * 50).encode()
    points = cut_points(text, 7)
    assert b"".join(text[a:b] for a, b in zip(points, points[1:])) == text
    for a, b in zip(points, points[1:]):
        text[a:b].decode()


@pytest.mark.parametrize("chunk, overlap", [(60, 24), (200, 64), (32, 30)])
def test_spliced_chunks_count_as_the_whole(spark, source, library, chunk, overlap):
    rng = random.Random(chunk)
    texts = [mixed(rng, 400) for _ in range(20)]
    texts += ["a" * 3000, " " * 3000, "x " * 900, "a" * 1000 + " b" * 300 + "c" * 900,
              "<|endoftext|>" * 200, "\n" * 500 + "end", "日" * 700, None, "", "short"]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, texts[0]), (3, texts[3])]
    got = token_counts.token_counts(
        spark.createDataFrame(rows, DOCS).withColumn("row", F.lit("clash")), source,
        limit=50, long=100, chunk=chunk, overlap=overlap).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit)
                  for r in got) == sorted(
        (i is None, i or 0, len((t or "").encode()), size(library, t), size(library, t) > 50)
        for i, t in rows)


def test_a_chunk_is_not_trusted_near_its_end(spark, source, library):
    """A special string or run of spaces cut in two by every chunk end."""
    text = ("word" + " " * 9 + "<|endoftext|>" + " next") * 60
    got = token_counts.token_counts(spark.createDataFrame([(1, text)], DOCS), source,
                                    long=64, chunk=33, overlap=40).first()
    assert got.n_tokens == size(library, text)


def test_empty_table_and_text_ids(spark, source):
    empty = spark.createDataFrame([], DOCS)
    assert token_counts.token_counts(empty, source).count() == 0
    named = spark.createDataFrame([("k", "a b")], "doc_id string, text string")
    assert token_counts.token_counts(named, source).first().doc_id == "k"


def test_other_tokenizers_are_not_cut(source):
    parts = json.loads(source)
    assert cuttable(parts)
    assert not cuttable(parts | {"normalizer": {"type": "Lowercase"}})
    token = parts["added_tokens"][0]
    assert not cuttable(parts | {"added_tokens": [token | {"content": "<a<"}]})
    assert not cuttable(parts | {"added_tokens": [token | {"lstrip": True}]})
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        other = file.read()
    lower = Tokenizer.from_str(other)
    texts = ["Some Words  here", "", "ÉTÉ 12"]
    assert Counter(other).count_all(texts) == [
        len(e) for e in lower.encode_batch(texts, add_special_tokens=False)]
