"""The URL models keep every context apart, also where there are more than 2^16."""

import math
import random
from collections import Counter

import pytest

from ledgerlark.llm import url_filter


def test_scores_against_exact_counts(spark):
    rng = random.Random(5)
    name = "abcdefghijklmnopqrstuvwxyz0123456789"
    rows = [(k, f"http://{'a.org' if k % 2 else 'b.com/de'}/{''.join(rng.choices(name, k=40))}")
            for k in range(4000)]
    rows += [(9000, "http://a.net/" + "xyzzy" * 4), (9001, None), (9002, "")]
    rows += [(9100 + k, f"x://{u[7:]}") for k, (_, u) in enumerate(rows[:40])]
    rules = [("allow", "org", "/"), ("block", "com", "/de/")]

    def events(url):
        text = [1] * 5 + [ord(c) + 3 for c in url or ""] + [2]
        for at in range(5, len(text)):
            for order in range(6):
                yield order, tuple(text[at - order:at]), text[at]

    counts = {side: Counter() for side in (0, 1)}
    for k, url in rows:
        host = (url or "").partition("://")[2].partition("/")[0]
        side = {"a.org": 1, "b.com": 0}.get(host)
        if side is not None:
            for order, context, following in events(url):
                counts[side][order, context] += 1
                counts[side][order, context, following] += 1
    assert sum(len(k) == 2 and k[0] == 5 for k in counts[1]) > 1 << 16

    def score(url):
        total, n, chance = 0.0, 0, {}
        for order, context, following in events(url):
            for side in (0, 1):
                before = chance[side] if order else 1 / 256
                chance[side] = (counts[side][order, context, following] + 2 * before) / (
                    counts[side][order, context] + 2)
            if order == 5:
                total, n = total + math.log(chance[1]) - math.log(chance[0]), n + 1
        return total / n

    df = spark.createDataFrame(rows, "page_id long, url string").repartition(3)
    out = {r.page_id: r for r in url_filter.judge(df, rules).collect()}
    assert len(out) == len(rows)
    for k, url in rows[::50] + rows[4000:]:
        assert out[k].score == pytest.approx(score(url), abs=1e-9)
