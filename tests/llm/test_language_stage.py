"""The language stage drops documents without letters, and no others."""

import pytest


@pytest.mark.parametrize("lang", [None, "und"])
def test_texts_with_letters_stay_without_profiles(spark, lang):
    import corpus_pipeline

    rows = [(k, f"text {k}", lang, "clash") for k in range(9)] + [
        (20, "12 !?", lang, "clash"), (21, None, lang, "clash"), (None, "日本", lang, "clash")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    out = corpus_pipeline.keep_known_languages(spark, docs, "").collect()
    assert sorted(map(tuple, out), key=str) == sorted(
        [(k, t, "und", c) for k, t, _, c in rows if k not in (20, 21)], key=str)
