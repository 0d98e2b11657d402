"""Documents with columns named as those that the repeated-strings operator adds."""

import random

from pyspark.sql import functions as F

from ledgerlark.llm import repeats


def test_repeated_strings_with_clashing_columns(spark):
    import corpus_pipeline

    rng = random.Random(2)
    part = ["".join(rng.choices("abcdef ", k=600)) for _ in range(3)]
    docs = spark.createDataFrame(
        [(1, part[0] + "one", 603, "s", "n", "k"), (2, part[1] + part[0], 1200, "s", "n", "k"),
         (3, part[2], 600, "s", "n", "k")],
        "doc_id long, text string, n_chars long, spans string, n_bytes string, kept string")
    cut = repeats.without_repeats(docs, as_text=True)
    assert cut.columns == ["doc_id", "n_chars", "spans", "n_bytes", "kept"]
    assert sorted(repeats.repeat_digests(cut).select("doc_id", "n_bytes", "n_removed").collect()) == [
        (1, 603, 600), (2, 1200, 600), (3, 600, 0)]
    out = corpus_pipeline.remove_repeated_strings(spark, docs, "")
    assert out.schema.simpleString() == docs.schema.simpleString()
    assert sorted(map(tuple, out.collect())) == [
        (1, "one", 3, "s", "n", "k"), (2, part[1], 600, "s", "n", "k"),
        (3, part[2], 600, "s", "n", "k")]
    narrow = docs.select("doc_id", "text", "n_chars", F.lit(1).alias("_row2"))
    assert corpus_pipeline.remove_repeated_strings(spark, narrow, "").count() == 3


def test_near_duplicates_stage_keeps_columns_named_as_its_own(spark):
    import corpus_pipeline

    rows = [(1, "a b c d e f", 5, "x", 2.0), (2, "a b c d e f", 6, "y", 3.0), (3, "other", 7, "z", 4.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int, Row_ string, number double")
    out = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert out.columns == docs.columns
    assert sorted(map(tuple, out.collect())) == [rows[0], rows[2]]
