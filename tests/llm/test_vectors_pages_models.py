"""Top-k search, WARC archives, URL verdicts, classifiers, pipeline and query registry."""

import base64
import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlark.llm import quality, topk, toxicity, url_filter, warc

SF = "/root/testdata/sf0.001"


def test_top_k_against_brute_force(spark):
    rng = random.Random(4)
    rows = [(k, [rng.gauss(0, 1) * (5 if k % 7 == 0 else 0.3) for _ in range(6)])
            for k in range(700)]
    rows += [(1000 + k, rows[14][1]) for k in range(12)]  # ties
    rows += [(2000, None), (2001, [1.0, None, 0.0]), (2002, [float("nan")] * 6),
             (2003, [float("inf")] * 6), (2004, [0.0] * 6), (2010, [1.0, 2.0]), (2050, [3.0, 1.0]),
             (2005, []), (None, [1.0] * 6), (10, rows[10][1])]
    usable = sorted({(k, tuple(math.floor(256 * x) for x in v)) for k, v in rows
                     if k is not None and v is not None
                     and all(x is not None and math.isfinite(x) for x in v)})
    want = set()
    for q, vector in usable:
        if q % 10 == 0:
            scored = {}
            for k, other in usable:
                if k != q and len(other) == len(vector):
                    score = sum(a * b for a, b in zip(vector, other))
                    scored[k] = max(score, scored.get(k, score))
            best = sorted(scored.items(), key=lambda x: (-x[1], x[0]))[:5]
            want |= {(q, rank, k, s) for rank, (k, s) in enumerate(best, 1)}
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn(
        "score", F.lit(1))
    got = topk.top_k(df, F.col("id") % 10 == 0)
    assert {tuple(r) for r in got.collect()} == want
    assert topk.top_k(df.limit(0), F.col("id") % 10 == 0).count() == 0


def test_an_id_on_several_vectors_takes_one_rank(spark):
    """Vec_id 7 on six vectors and six others, all in one bucket."""
    rows = [(50, [1.0, 1.0])] + [(7, [1.0, 1.0 + k / 100]) for k in range(6)]
    rows += [(k, [1.0, 1.0 - k / 1000]) for k in (1, 2, 3, 4, 5, 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(topk.top_k(df, F.col("id") == 50).collect())
    vector = [256, 256]
    best = {}
    for k, v in rows[1:]:
        score = sum(a * math.floor(256 * x) for a, x in zip(vector, v))
        best[k] = max(score, best.get(k, score))
    want = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:5]
    assert [tuple(r) for r in got] == [(50, n, k, s) for n, (k, s) in enumerate(want, 1)]


def test_pruning_keeps_what_reaches_the_threshold():
    rng = np.random.default_rng(0)
    vectors = rng.normal(size=(500, 8)) * rng.uniform(0.8, 1, (500, 1))
    norms = np.linalg.norm(vectors, axis=1)
    order = np.argsort(-norms)
    vectors, norms = vectors[order], norms[order]
    unit = vectors / norms[:, None]
    for query in rng.normal(size=(50, 8)):
        scores = vectors @ query
        for threshold in np.quantile(scores, [0.5, 0.9, 0.99, 1]):
            kept = topk.survivors(query, np.linalg.norm(query), threshold, unit, norms)
            assert set(np.flatnonzero(scores >= threshold)) <= set(kept)


def test_warc_round_trip(spark, monkeypatch):
    rng = random.Random(6)
    long = "".join(rng.choices("abcé日\r\n", k=60_000))
    html = [None, "", "<p>x</p>", long, "WARC/1.1\r\n\r\n\r\n", "<p>x</p>", long, "<p>x</p>", "\r\n"]
    rows = [(k, f"http://h/{k}\r\nX: y" if k % 2 else None, h) for k, h in enumerate(html)]
    rows += [(None, "u", "solo"), (2, None, "<p>x</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn(
        "digest", F.lit("clash"))
    for least in (0, 5):
        got = warc.archive_round_trip(df, least).collect()
        assert all(r.digest_holds for r in got)
        want = []
        for page, _, text in rows:
            payload = (text or "").encode()
            same = [p for p, _, t in rows if (t or "").encode() == payload and p is not None]
            first = min(same, default=None) if len(payload) >= least else page
            digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            want.append((page, len(payload), digest, "response" if page == first else "revisit",
                         None if page == first else first))
        fields = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
        assert sorted((tuple(r[f] for f in fields) for r in got), key=str) == sorted(want, key=str)
    assert warc.archive_round_trip(df.limit(0)).count() == 0


def test_lost_segments_are_an_error(spark, tmp_path):
    records = list(warc.records("1", None, b"x" * 5000, "D", None, 1000))[:-1]
    spark.createDataFrame([(r.decode(),) for r in records], "value string").coalesce(1).write.option(
        "lineSep", "\r\n\r\n").text(str(tmp_path / "w"))
    with pytest.raises(Exception, match="segments missing"):
        warc.read_archives(spark, str(tmp_path / "w")).collect()


URLS = {
    "http://a.ORG/x?y": ("a.org", "/x", "org/", "allow"),
    "http://org": ("org", "", None, None),
    "http://b.example.org/es/1#t": ("b.example.org", "/es/1", "example.org/es/", "block"),
    "http://example.org/en/12": ("example.org", "/en/12", "example.org/en/1", "block"),
    "http://example.org/en/2": ("example.org", "/en/2", "org/", "allow"),
    "x://m.com/fr/": ("m.com", "/fr/", "com/fr/", "allow"),
    "x://m.com/de/?a://b": ("m.com", "/de/", "com/de/", "block"),
    "x://mcom/de/": ("mcom", "/de/", None, None),
    "no scheme": ("", "", None, None),
    "": ("", "", None, None),
}


def test_url_rules_and_models(spark):
    rows = [(k, u) for k, u in enumerate(URLS)] + [(99, None), (None, "http://a.org/")]
    rows += [(1000 + k, f"http://good.org/{k}/fine") for k in range(80)]
    rows += [(2000 + k, f"http://spam.com/de/{k}zz") for k in range(80)]
    rows += [(3000, "http://good.net/55/fine"), (3001, "http://spam.net/de/77zz")]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumn("rule", F.lit("clash"))
    out = {r.page_id: r for r in url_filter.judge(df).collect()}
    assert len(out) == len(rows)
    for k, (url, (host, path, rule, verdict)) in enumerate(URLS.items()):
        assert (out[k].host, out[k].path, out[k].rule) == (host, path, rule), url
        assert verdict is None or out[k].verdict == verdict
    assert (out[99].host, out[99].path, out[99].rule) == ("", "", None)
    assert (out[3000].verdict, out[3001].verdict) == ("allow", "block")
    assert {r.verdict for r in out.values()} == {"allow", "block"}
    unruled = spark.createDataFrame([(1, "http://x.net/")], "page_id long, url string")
    assert [r.verdict for r in url_filter.judge(unruled).collect()] == ["allow"]


def _held_out(doc_id, folds, fold):
    return zlib.crc32(str(doc_id).encode()) % folds == fold


def test_quality_on_held_out_documents(spark):
    rng = random.Random(8)
    docs, labels = [], []
    for k in range(400):
        good = k % 3 > 0
        words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(40)]
        docs.append((k, " ".join(words) if good else "!! ".join(w.upper() for w in words)))
        labels.append((k, int(good)))
    docs += [(900, None), (901, ""), (None, "abc")]
    labels += [(None, 1), (5, None), (7, 0), (7, 1)]
    frames = (spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit(9)),
              spark.createDataFrame(labels, "doc_id long, quality int"))
    out = {r.doc_id: r for r in quality.quality(*frames).collect()}
    assert all(r.held_out == _held_out(k, 3, 1) for k, r in out.items() if k is not None)
    assert np.mean([out[k].predicted == int(k % 3 > 0) for k in range(400)
                    if out[k].held_out]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out.values())
    none = quality.quality(frames[0], frames[1].limit(0)).collect()
    assert {r.score for r in none} == {0.5}


def test_toxicity_on_held_out_documents(spark):
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefgh", k=4)) for _ in range(300)]
    docs, labels = [], []
    for k in range(900):
        text = rng.choices(words, k=40)
        if k % 8 == 0:
            text[rng.randrange(20)], text[25] = "vile", "nasty"
        docs.append((k, " ".join(text)))
        labels.append((k, int(k % 8 == 0)))
    docs += [(2000, None), (2001, ""), (None, "vile nasty")]
    frames = (spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit(9)),
              spark.createDataFrame(labels, "doc_id long, toxic int"))
    out = {r.doc_id: r for r in toxicity.toxicity(*frames).collect()}
    assert all(r.held_out == _held_out(k, 5, 0) for k, r in out.items() if k is not None)
    held = [k for k in range(900) if out[k].held_out]
    assert np.mean([out[k].predicted == int(k % 8 == 0) for k in held]) > 0.97
    assert out[None].predicted == 1 and out[2000].predicted == out[2001].predicted == 0
    assert {r.score for r in toxicity.toxicity(frames[0], frames[1].limit(0)).collect()} == {0.0}


def test_pipeline_keeps_the_columns_and_drops_by_decision(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r.doc_id: r.text for r in docs.collect()}
    step = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        step = spark.createDataFrame(stage(spark, step, SF).toPandas(), docs.schema)
        assert step.columns == docs.columns, name
        assert step.count() > 0.5 * len(before), name
    left = {r.doc_id: r.text for r in step.collect()}
    assert set(left) <= set(before)
    out = corpus_pipeline.run(spark, SF)
    got = {r.doc_id: r.decoded_sha256 for r in out.collect()}
    assert got == {k: hashlib.sha256(t.encode()).hexdigest() for k, t in left.items()}


def test_every_operator_has_one_query():
    import __spark_entry__

    names = [n for n in __spark_entry__.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11))
    assert "pipeline" in __spark_entry__.queries()
