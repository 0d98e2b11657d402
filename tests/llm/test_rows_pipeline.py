"""Copies under one id or a null id go through the whole pipeline."""

import hashlib
import random
from collections import Counter


def test_pipeline_leaves_one_of_copies_that_share_an_id_or_have_none(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(11)
    texts = [" ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(100)) for _ in range(8)]
    rows = [(1, texts[0]), (1, texts[0]), (None, texts[1]), (None, texts[1]), (None, texts[2]),
            (9, texts[2]), (5, texts[3]), (4, texts[3]), (4, texts[4]), (6, texts[5]),
            (None, texts[6]), (None, texts[7])]
    docs = spark.createDataFrame([(k, t, "xx", len(t)) for k, t in rows],
                                 "doc_id long, text string, lang string, n_chars long")
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "none of these words")], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    got = Counter((r.doc_id, r.decoded_sha256) for r in out)
    want = [(1, 0), (None, 1), (9, 2), (4, 3), (4, 4), (6, 5), (None, 6), (None, 7)]
    assert got == Counter((k, hashlib.sha256(texts[t].encode()).hexdigest()) for k, t in want)
