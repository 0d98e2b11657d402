"""URL verdicts by rules, and by character language models where no rule fits.

Two variable-order Markov models, one of accepted and one of rejected URLs, are
counted over every URL that a rule decides.  A context of up to ORDER characters
predicts the next one; the estimate of a longer context counts the shorter one's as
BACK_OFF further sightings, so that rare contexts lean on it.  Counts are a distributed
table with a row for each context and each context with its next character, under 64-bit
names (two of them share a name with chance 2^-64 a pair), so the models grow with the
URLs.  URLs are scored in groups of GROUP rows: each group asks the table once for every
distinct name in it.  A URL's score is the log-likelihood difference per character.  The
threshold is calibrated on the scores of all ruled URLs: that of best balanced accuracy.

Defined cases: a null url, or one without ``://``, has empty host and path and no rule;
an empty url scores 0; with no ruled URL on one side every score is 0 and the verdict
allow; repeated rows are counted and judged each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import stash
from ledgerlark.llm.words import mix

U = np.uint64
ORDER = 5
BACK_OFF = 2.0
GROUP = 1024
SLICE = 256
BINS = 2000
SCORE_RANGE = 10.0

#: Verdict, host, path.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substr(url, instr(url, '://') + 3)")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*(/[^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def apply_rules(pages: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``pages`` (page_id, url) with host, path, rule and rule_verdict.  The longest
    rule wins, of equals that of the longer host, then the smaller text."""
    host, path = host_and_path(F.col("url"))
    rows = pages.withColumns({"host": host, "path": path})
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    ranked = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[1] + r[2]))
    for kind, rule_host, rule_path in reversed(ranked):
        fits = ((F.col("host") == rule_host) | F.col("host").endswith("." + rule_host)
                ) & F.col("path").startswith(rule_path)
        rule = F.when(fits, rule_host + rule_path).otherwise(rule)
        verdict = F.when(fits, kind).otherwise(verdict)
    return rows.withColumns({"rule": rule, "rule_verdict": verdict})


def _events(urls: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of each context length 0..ORDER: names of the contexts, names of the contexts
    with the next character, and the URL of each.  Every URL ends with an end mark and
    begins after a start mark."""
    codes = [np.frombuffer((u or "").encode("utf-32-le"), np.uint32) for u in urls]
    lengths = np.array([len(c) + 1 for c in codes])
    pad = ORDER
    total = int(lengths.sum()) + pad * len(codes)
    text = np.full(total, 1, np.uint64)  # start marks
    is_next = np.zeros(total, bool)
    owner = np.zeros(total, np.int64)
    at = 0
    for k, code in enumerate(codes):
        at += pad
        text[at:at + len(code)] = code.astype(np.uint64) + U(3)
        text[at + len(code)] = 2  # end mark
        is_next[at:at + len(code) + 1] = True
        owner[at:at + len(code) + 1] = k
        at += len(code) + 1
    spots = np.flatnonzero(is_next)
    context = np.zeros(len(spots), np.uint64)
    for order in range(ORDER + 1):
        if order:
            context = mix(context * U(0x9E3779B97F4A7C15) + text[spots - order])
        seen = mix(context + U(order))
        pair = mix(seen * U(0x9E3779B97F4A7C15) + text[spots])
        yield seen, pair, owner[spots]


_START = mix(np.zeros(1, np.uint64))  # name of the context of no character


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, GROUP):
            urls = batch.column(0).slice(start, GROUP).to_pylist()
            sides = np.array(batch.column(1).slice(start, GROUP).to_pylist(), np.int64)
            names, accepted = [], []
            for seen, pair, owner in _events(urls):
                names += [seen, pair]
                accepted += [sides[owner]] * 2
            found, at = np.unique(np.concatenate(names), return_inverse=True)
            both = np.bincount(at, minlength=len(found))
            n1 = np.bincount(at, np.concatenate(accepted), len(found)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.view(np.int64)), pa.array(both - n1), pa.array(n1)],
                names=["name", "n0", "n1"])


def fit(ruled: DataFrame) -> DataFrame:
    """name, n0, n1: how often the rejected and the accepted of ``ruled`` (url, side; side
    1 is accepted) show a context, or a context with its next character."""
    return stash(ruled.mapInArrow(_count, "name long, n0 long, n1 long").groupBy("name").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1")), "counts")


def score_urls(urls: list[str | None], names: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Log-likelihood difference (accepted minus rejected) per character.  ``counts``: two
    rows, of the sorted ``names``; others were never seen."""

    def seen_times(asked: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(names, asked), len(names) - 1)
        return np.where(names[at] == asked, counts[:, at], 0)

    if not len(urls) or not len(names) or not seen_times(_START).all():
        return np.zeros(len(urls))
    chance, owner = 1 / 256, None
    for seen, pair, owner in _events(urls):
        chance = (seen_times(pair) + BACK_OFF * chance) / (seen_times(seen) + BACK_OFF)
    logs = np.log(chance)
    sums = np.bincount(owner, logs[1] - logs[0], minlength=len(urls))
    return sums / np.maximum(np.bincount(owner, minlength=len(urls)), 1)


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(name, group) of the distinct names in each group of URLs."""
    for batch in batches:
        groups = batch.column(0).to_numpy()
        for group in np.unique(groups):
            urls = batch.column(1).take(pa.array(np.flatnonzero(groups == group))).to_pylist()
            names = np.empty(0, np.uint64)
            for start in range(0, len(urls), SLICE):
                names = np.unique(np.concatenate([names, *(
                    x for seen, pair, _ in _events(urls[start:start + SLICE]) for x in (seen, pair))]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names.view(np.int64)), pa.array(np.full(len(names), group))],
                names=["name", "group"])


def score(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """``rows`` with the score of its ``url`` in place of that."""
    # Written, so that a row is in one group in all that reads it.
    grouped = stash(rows.withColumn(
        "group", F.shiftright(F.monotonically_increasing_id(), GROUP.bit_length() - 1)), "urls")
    asked = stash(grouped.select("group", "url").mapInArrow(_asked, "name long, group long"), "asked")
    known = stash(asked.join(counts, "name"), "known")
    keep = [c for c in rows.columns if c != "url"]

    def run(urls: pa.Table, met: pa.Table) -> pa.Table:
        name = met.column("name").to_numpy().view(np.uint64)
        name, first = np.unique(name, return_index=True)
        n = np.array([met.column(c).to_numpy()[first] for c in ("n0", "n1")])
        texts = urls.column("url").to_pylist()
        scores = [score_urls(texts[k:k + SLICE], name, n) for k in range(0, len(texts), SLICE)]
        return urls.select(keep).append_column(
            "score", pa.array(np.concatenate(scores) if scores else [], pa.float64()))

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop("url").schema)
    return stash(grouped.groupBy("group").cogroup(known.groupBy("group")).applyInArrow(
        run, f"{ddl}, score double"), "scored")


def calibrate(scored: DataFrame) -> float:
    """Threshold of best balanced accuracy over the scores of all ruled URLs (side, score),
    from a histogram of fixed size; of equals the middle one."""
    place = F.floor((F.greatest(F.lit(-SCORE_RANGE), F.least(F.lit(SCORE_RANGE), "score"))
                     + SCORE_RANGE) * (BINS / (2 * SCORE_RANGE)))
    counts = np.zeros((2, BINS + 1))
    for row in scored.groupBy("side", place.alias("place")).count().collect():
        counts[row["side"], int(row["place"])] = row["count"]
    if not counts.sum(axis=1).all():
        return 0.0
    share = counts / counts.sum(axis=1, keepdims=True)
    balanced = np.cumsum(share[0]) + 1 - np.cumsum(share[1])  # cut after each bin
    best = np.flatnonzero(balanced >= balanced.max() - 1e-12)
    return float((best[len(best) // 2] + 1) * (2 * SCORE_RANGE / BINS) - SCORE_RANGE)


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, score: the rule's verdict, else the models'."""
    ruled = apply_rules(pages.select("page_id", F.col("url").cast("string")), rules)
    side = F.expr("CAST(rule_verdict = 'allow' AS int)").alias("side")
    scored = score(ruled, fit(ruled.where("rule IS NOT NULL").select("url", side)))
    threshold = calibrate(scored.where("rule IS NOT NULL").select(side, "score"))
    return scored.select(
        "page_id", "host", "path", "rule",
        F.coalesce("rule_verdict", F.when(F.col("score") >= threshold, "allow").otherwise("block")
                   ).alias("verdict"), "score")
