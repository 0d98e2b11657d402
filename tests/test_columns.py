"""Column expressions: Unicode trimming, lenient numbers, strict dates, predicates."""

from __future__ import annotations

import math


from ledgerlark.functions import columns as C


def _one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_trim_text_strips_unicode_whitespace_like_python(spark):
    samples = [" a ", "\tb\n", "\xa0c　", "\x1cd\x1f", "e", "", "   ", None, " f g "]
    df = spark.createDataFrame([(s,) for s in samples], "v string")
    got = [r["r"] for r in df.select(C.trim_text("v").alias("r")).collect()]
    assert got == [None if s is None else s.strip() for s in samples]


def test_is_blank_treats_null_as_not_blank(spark):
    samples = ["", "  ", " \t", "x", " x ", None]
    df = spark.createDataFrame([(s,) for s in samples], "v string")
    got = [r["r"] for r in df.select(C.is_blank("v").alias("r")).collect()]
    assert got == [True, True, True, False, False, False]


def test_lenient_double_accepts_numbers_and_rejects_literals(spark):
    cases = {"5": 5.0, " 5 ": 5.0, "1e3": 1000.0, "-2.5": -2.5, ".5": 0.5, "abc": None,
             "1.0d": None, "0x10": None, "": None, None: None}
    for text, want in cases.items():
        assert _one(spark, C.lenient_double("v"), text) == want, text
    assert math.isinf(_one(spark, C.lenient_double("v"), "inf"))
    assert math.isinf(_one(spark, C.lenient_double("v"), "-Infinity"))
    assert math.isnan(_one(spark, C.lenient_double("v"), "nan"))


def test_strict_timestamp_rejects_trailing_text_and_impossible_days(spark):
    parse = C.strict_timestamp("v")
    assert _one(spark, parse, "2010-12-01 08:26:00") is not None
    assert _one(spark, parse, "2010-12-01") is not None
    for bad in ["2010-12-01 junk", "invalid-date", "2010-02-30", "", None]:
        assert _one(spark, parse, bad) is None, bad


def test_fixed_width_detection():
    assert C._fixed_width("yyyy-MM-dd HH:mm:ss")
    assert not C._fixed_width("dd MMM yyyy")
    assert not C._fixed_width("yyyy-MM-dd'T'HH")


def test_finite_and_positive_handle_nan_and_inf(spark):
    df = spark.createDataFrame([(x,) for x in [1.0, 0.0, -1.0, float("nan"), float("inf"),
                                              float("-inf"), None, 0.001]], "v double")
    got = [(r["f"], r["p"]) for r in df.select(C.finite("v").alias("f"),
                                                C.positive_finite("v").alias("p")).collect()]
    assert got == [(True, True), (True, False), (True, False), (False, False),
                   (False, False), (False, False), (False, False), (True, True)]


def test_valid_quantity_requires_whole_nonzero(spark):
    df = spark.createDataFrame([(x,) for x in [2.0, -1.0, 0.0, 1.5, float("inf"), None]],
                               "v double")
    got = [r["q"] for r in df.select(C.valid_quantity("v").alias("q")).collect()]
    assert got == [True, True, False, False, False, False]


def test_line_status_and_segment(spark):
    df = spark.createDataFrame([("C1", 2.0, "United Kingdom"), ("c2", 1.0, "France"),
                                ("3", -1.0, "France"), ("4", 1.0, "United Kingdom")],
                               "o string, q double, c string")
    got = [(r["s"], r["g"]) for r in df.select(
        C.line_status("o", "q").alias("s"),
        C.segment("c", "United Kingdom").alias("g")).collect()]
    assert got == [("canceled", "domestic"), ("canceled", "export"), ("canceled", "export"),
                   ("paid", "domestic")]


def test_money_round_rounds_the_binary_value(spark):
    # 1.005 is stored just below 1.005, so rounding the binary value gives 1.0.
    assert _one(spark, C.money_round("v"), 1.005, "v double") == 1.0
    assert _one(spark, C.money_round("v"), 2.675, "v double") == 2.68  # 267.5 exactly
    assert _one(spark, C.money_round("v"), 0.125, "v double") == 0.13
