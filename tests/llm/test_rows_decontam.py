"""Rows with one id and equal word counts are judged each alone in every number of passes."""

import random

from pyspark.sql import functions as F

from ledgerlark.llm import decontam


def test_passes_do_not_mix_rows_of_one_id(spark):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(500)]
    items = [(k, " ".join(rng.choices(words, k=12))) for k in range(6)]
    docs = []
    for k in range(60):
        text = rng.choices(words, k=20)
        if k % 4 == 0:
            text[3:15] = items[k % 6][1].split(" ")
        docs.append((None if k % 3 == 0 else k % 2, " ".join(text)))
    docs_df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    items_df = spark.createDataFrame(items, "item_id long, text string")
    one, many = (sorted(map(tuple, decontam.hit_digests(decontam.contamination(
        docs_df, items_df, block_words=n)).collect()), key=str)
        for n in (decontam.BLOCK_WORDS, 10))
    assert sum(r[5] for r in one) == 15
    assert many == one


def test_columns_named_as_the_operators_own_are_kept(spark):
    docs = spark.createDataFrame(
        [(1, "plain words only", 7, "mine", 3), (2, " ".join(f"q{k}" for k in range(12)), 8, "x", 4)],
        "doc_id long, text string, items int, spans string, n_words int")
    bench = spark.createDataFrame([("a", " ".join(f"q{k}" for k in range(10)))],
                                  "item_id string, text string")
    for block_words in (1 << 20, 1):
        kept = decontam.without_contaminated(docs, bench, block_words=block_words)
        assert kept.columns == docs.columns
        assert [tuple(r) for r in kept.collect()] == [(1, "plain words only", 7, "mine", 3)]


def test_spans_united_by_expression(spark):
    spans = [[5, 9], [0, 2], [2, 4], [8, 12], [20, 21], [6, 7]]
    row = spark.createDataFrame([(spans,), ([],)], "s array<array<long>>").select(
        decontam.united_column(F.col("s")).alias("u")).collect()
    assert [r.u for r in row] == [decontam.united(sorted(spans)), []]
