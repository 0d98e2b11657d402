"""Prior and threshold come from all documents, and long words tell too."""

import random

import pytest

from ledgerlark.llm import toxicity


def test_rare_toxic_documents_and_long_words(spark):
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefgh", k=4)) for _ in range(300)]
    mark = "z" * 60 + " " + "y" * 60  # longer than WORD_BYTES
    docs = [(k, " ".join(rng.choices(words, k=30) + ([mark] if k % 100 == 0 else [])))
            for k in range(6000)]
    labels = [(k, int(k % 100 == 0)) for k, _ in docs]
    frames = (spark.createDataFrame(docs, "doc_id long, text string"),
              spark.createDataFrame(labels, "doc_id long, toxic int"))
    marked = frames[1].where("toxic = 1").selectExpr("doc_id AS _id")
    assert toxicity.fit(frames[0], marked, None, sample=30).prior == pytest.approx(0.01)
    out = toxicity.toxicity(*frames, sample=30).collect()
    assert sum(r.predicted != int(r.doc_id % 100 == 0) for r in out) == 0


def test_a_beginning_counts_by_its_share_of_the_words():
    text = b"baddest " + b"badder baddies " + b"x " * 60 + b"rare"
    found = toxicity.word_set(text)
    shares = {w for w in found if w.endswith(b"^badd")}
    assert shares == {b"^badd", b"7^badd", b"6^badd", b"5^badd"}  # three words of 64
    assert {w for w in found if w.endswith(b"^badde")} == {b"^badde", b"7^badde", b"6^badde", b"5^badde"}
    assert {w for w in found if w.endswith(b"^baddi")} == {b"^baddi"}  # one word has no share
    assert toxicity.share_starts(found) == {b"badd"}
    assert toxicity.word_set(text, {b"badd"}) == found
    assert toxicity.word_set(text, set()) == {w for w in found if b"^" not in w[1:]}
    assert toxicity.word_set(b"", None) == toxicity.word_set(None, {b"badd"}) == set()


def test_toxic_text_told_by_the_share_of_a_beginning_alone(spark):
    """Every document holds the beginning once, the toxic ones many times."""
    def text(i, times):
        return " ".join([f"vile{(i * 7 + k) % 97}x" for k in range(times)]
                        + [f"word{(i * 31 + k * 17) % 89}" for k in range(120 - times)])

    docs = [(i, text(i, 12 if i % 10 == 0 else 1)) for i in range(600)]
    labels = [(i, int(i % 10 == 0)) for i in range(600)]
    out = toxicity.toxicity(spark.createDataFrame(docs, "doc_id long, text string"),
                            spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    held = [r for r in out if r.held_out]
    assert held and all(r.predicted == int(r.doc_id % 10 == 0) for r in held)
