"""Rows with one page_id or none, over several segments."""

import base64
import hashlib
import random

from ledgerlark.llm import warc


def test_segments_and_revisits_of_repeated_and_null_page_ids(spark):
    rng = random.Random(7)
    a, b, c = ("".join(rng.choices("abcé\r\n", k=n)) for n in (40_000, 50_000, 70))
    rows = [(1, a), (1, b), (1, c), (1, c), (2, a), (3, b), (3, b), (4, c), (None, a), (None, b)]
    df = spark.createDataFrame([(p, "u", h) for p, h in rows],
                               "page_id long, url string, html string").repartition(3)
    got = warc.archive_round_trip(df).collect()
    want = []
    for page, html in rows:
        data = html.encode()
        kind, first = ("response", None) if page == 1 else ("revisit", 1)
        want.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                     kind, first, True))
    want = [(p, n, d, "response", None, True) if p is None else (p, n, d, k, f, h)
            for p, n, d, k, f, h in want]
    fields = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
              "digest_holds")
    assert sorted((tuple(r[f] for f in fields) for r in got), key=str) == sorted(want, key=str)
