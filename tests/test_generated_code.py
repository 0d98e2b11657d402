"""Generated methods stay short enough for the JIT compiler, and cells are parsed once."""

from __future__ import annotations

import pytest

from ledgerlark.functions import columns as C
from ledgerlark.plans import catalog
from tests.conftest import SF_SMALL

# HotSpot interprets methods of more bytes than this.
JIT_LIMIT = 8000


@pytest.mark.parametrize("name", [
    "normalize_items", "normalize_customers", "line_status_segment", "quality_checks",
    "skipped_checks", "bad_value_samples"])
def test_generated_methods_are_compiled(spark, name):
    own = spark.newSession()
    own.conf.set("spark.sql.adaptive.enabled", "false")
    plan = catalog.QUERIES[name](own, SF_SMALL)._jdf.queryExecution()
    code = plan.debug().codegenToSeq()
    assert max(code.apply(i)._3().maxMethodCodeSize() for i in range(code.size())) < JIT_LIMIT


def test_clean_lines_parse_each_date_once(spark):
    """No join condition or filter below the projection parses cells again."""
    plan = catalog.QUERIES["valid_rows"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("regexp_extract") == 1


def test_odd_texts_keep_their_meaning(spark):
    cases = {"+NaN": True, "-inf": True, "INFINITY": True, "+1e5": True, "1_0": False, "1f": False,
             "inf x": False, "nan\n": False, "x\n1": False, "1\n": True, "e": False, "--1": False}
    df = spark.createDataFrame([(t,) for t in cases], "v string")
    got = {r["v"]: r["ok"] for r in df.select(
        "v", C.lenient_double("v").isNotNull().alias("ok")).collect()}
    assert got == cases
    spaced = [f"{ch}a{ch}b{ch}" for ch in C.SPACE_CHARS] + ["'\\ x", "​a", "\U0001f600 "]
    texts = spark.createDataFrame([(s,) for s in spaced], "v string")
    assert [r[0] for r in texts.select(C.trim_text("v")).collect()] == [s.strip() for s in spaced]
    dates = ["0000-01-01", "2010-12-01T08:26:00", "2010-12-01 24:00:00", "2010-12-01\n", "10-12-01",
             "2012-02-29 23:59:59", "٢٠١٠-01-01"]
    days = spark.createDataFrame([(s,) for s in dates], "v string")
    assert [r[0] for r in days.select(C.strict_timestamp("v").isNotNull()).collect()] == [
        True, False, False, False, False, True, False]


def test_numbers_beyond_the_finite_are_told_apart(spark):
    values = [5e-324, 1.7976931348623157e308, float("inf"), float("-inf"), float("nan"), -0.0, 0.0, None]
    df = spark.createDataFrame([(x,) for x in values], "v double")
    got = [tuple(r) for r in df.select(C.finite("v"), C.positive_finite("v"), C.whole("v")).collect()]
    no = (False, False, False)
    assert got == [(True, True, False), (True, True, True), no, no, no, (True, False, True),
                   (True, False, True), no]
