"""What a gated run costs at size: one shuffle of keys, no count by key where none is hot, money
by integers, joins without sorts."""

from __future__ import annotations

import random
import re
from collections import Counter
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerlark.functions import columns as C
from ledgerlark.operators import joins, marts, money, quality
from ledgerlark.plans import job
from ledgerlark.session import shared_dir
from ledgerlark.sources import fs
from ledgerlark.sources.driver_tables import DriverTables
from tests.conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_gate_shuffles_keys_once(spark):
    """Row checks do not part the rows of a key."""
    plan = _plan(quality.QualityEngine(DriverTables(spark, SF_SMALL).dirty_tables()).results())
    gate = [line for line in plan.splitlines() if "hashpartitioning(_space" in line]
    assert len(gate) == 1


def test_masks_and_keys_of_one_table(spark):
    """Failing rows count once in their checks and once in their keys, also without a key."""
    rows = [("a", " "), ("a", None), (None, "x"), ("b", " "), ("c", "x")]
    frame = spark.createDataFrame(rows, "k string, v string")
    for unique, dup in (((("t", "k"),), 2), ((), None)):
        rules = quality.QualityRules({"t": ("k", "v")}, {"t": ("k", "v")}, {"t": ("v",)}, unique, (), (), (), ())
        got = {r.name: r.failed_rows for r in quality.QualityEngine({"t": frame}, rules).run()}
        assert got["t.not_null"] == 2 and got["t.not_blank"] == 2 and got["t.not_empty"] == 0
        assert got.get("t.k.unique") == dup


def test_only_keys_of_crowded_buckets_are_counted(spark, monkeypatch):
    lines = spark.range(4000).selectExpr("concat('o', id) k")
    grouped = []
    plain = type(lines).groupBy
    monkeypatch.setattr(type(lines), "groupBy", lambda self, *c: grouped.append(c) or plain(self, *c))
    assert joins.hot_keys(lines, "k", partitions=4) is None
    assert ("k",) not in grouped


def test_hot_keys_are_those_of_a_plain_count(spark):
    rng = random.Random(5)
    keys = [int(2000 * rng.random() ** 6) for _ in range(20000)]
    lines = spark.createDataFrame([(k,) for k in keys] + [(None,)] * 3000, "k int")
    for partitions in (2, 7, 40):
        pieces = {k: -(-n * joins.PIECE_SHARE * partitions // len(keys)) for k, n in Counter(keys).items()
                  if n * joins.HOT_SHARE * partitions > len(keys)}
        got = {r.k: r["_parts"] for r in joins.hot_keys(lines, "k", partitions).collect()}
        assert got == {k: min(p, Counter(keys)[k]) for k, p in pieces.items() if p > 1}


def test_prices_in_cents_go_by_integers(spark):
    rng = random.Random(3)
    cents = [0, 1, 7, 29, 57, 58, 114, 115, 10**9 - 1, *(rng.randrange(10**9) for _ in range(3000))]
    other = [0.001, 1.005, 0.285, 0.1 + 0.2, 1.0e7, 12345678.91, 999999999.99, 2.0000000000000004, -0.0, -1.25, -0.07]
    prices = [c / 100 for c in cents] + other
    rows = [(k, p, rng.choice((1, 12, -3, 2**31 - 1, -(2**31)))) for k, p in enumerate(prices)]
    df = spark.createDataFrame(rows, "k int, unit_price double, quantity long")
    got = df.select("k", F.expr(money.IN_CENTS_SQL).alias("cents"), F.expr(money.FITS_SQL).alias("fits"),
                    F.expr(money.line_value_sql(True)).alias("v")).orderBy("k").collect()
    for (k, price, quantity), r in zip(rows, got):
        assert r.cents == (k < len(cents) or price == 0), price
        if r.fits:
            assert r.v == Decimal(repr(price)) * quantity, (price, quantity)
    assert not got[len(cents) + 7].fits and all(r.fits for r in got[:len(cents)])
    odd = spark.createDataFrame([(x,) for x in (float("nan"), float("inf"), -float("inf"), None, 1e300)], "unit_price double")
    assert [tuple(r) for r in odd.select(F.expr(money.IN_CENTS_SQL), F.expr(money.FITS_SQL)).collect()] == [
        (False, False)] * 3 + [(False, None), (False, False)]


def test_blank_test_stops_at_the_first_letter(spark):
    assert "LEADING" in C.is_blank_sql("v")
    texts = ["", " ", " \t ", "a", " a", "a ", " a ", " x ", " ", None, "​"]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    want = [t is not None and not t.strip() for t in texts]
    assert [r[0] for r in df.select(C.is_blank("v")).collect()] == want


def test_bounded_headers_are_hashed_not_sorted(spark):
    raw = DriverTables(spark, SF_SMALL).raw_tables()
    tables = raw["customers"], raw["orders"], raw["order_items"]
    plain, hashed = (marts.fact_order_items(*tables, hashed=h) for h in ((), ("customers", "orders")))
    assert "ShuffledHashJoin" not in _plan(plain)
    assert len(re.findall("ShuffledHashJoin", _plan(hashed))) == 2
    assert plain.exceptAll(hashed).isEmpty() and hashed.exceptAll(plain).isEmpty()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert joins.fits_hash_map(spark, joins.MAX_HASHED_BYTES * parts)
    assert not joins.fits_hash_map(spark, joins.MAX_HASHED_BYTES * parts + 1)
    assert not joins.fits_hash_map(spark, None)


def test_shuffled_run_reads_the_rollup_from_the_fact(spark, tmp_path, monkeypatch):
    """The lines are not aggregated and shuffled once more beside a shuffled fact join."""
    release = job.Release(spark, str(tmp_path / "wh"))
    v = job.run_quality_stage(spark, DriverTables(spark, SF_SMALL).raw_tables(), str(tmp_path / "rep"), "r1",
                              "2026-01-01T00:00:00.000Z", release=release)
    monkeypatch.setattr(marts, "order_rollup_from_raw", lambda *a, **k: 1 / 0)
    base = job.build_base(spark, v.tables, v.raw_bytes, release, "r1", True, broadcast_bytes=0)
    monkeypatch.undo()
    want = marts.order_rollup_from_raw(v.tables["customers"], v.tables["orders"], v.tables["order_items"])
    got = spark.read.parquet(base.rollup_path).select(*want.columns)
    assert got.count() and want.exceptAll(got).isEmpty() and got.exceptAll(want).isEmpty()


def test_sizes_are_estimated(spark):
    """A scan has its file's size, so small tables are broadcast and larger ones hashed."""
    part = DriverTables(spark, SF_SMALL).table("part")
    assert 0 < joins.estimated_bytes(part) < joins.DEFAULT_BROADCAST_BYTES
    feed = _plan(DriverTables(spark, SF_SMALL).retail_source())
    assert feed.count("BroadcastHashJoin") == 4 and "SortMergeJoin" not in feed


def test_lines_are_not_sorted_for_their_tables(spark, monkeypatch):
    tables = DriverTables(spark, SF_SMALL)
    want = sorted(tables.retail_source().collect(), key=repr)
    monkeypatch.setattr(joins, "DEFAULT_BROADCAST_BYTES", 1)
    hashed = tables.retail_source()
    assert "SortMergeJoin" not in _plan(hashed) and "SortMergeJoin" not in _plan(tables.raw_order_items())
    assert sorted(hashed.collect(), key=repr) == want
    # A table too large for hash maps is sorted.
    monkeypatch.setattr(joins, "MAX_HASHED_BYTES", 1)
    monkeypatch.setattr(joins.fits_hash_map, "__defaults__", (1,))
    assert "SortMergeJoin" in _plan(tables.raw_order_items())


def test_cells_are_read_without_replacing(spark):
    """Plain numbers and texts pass no regular-expression replacement and no search for
    Unicode spaces."""
    assert "regexp_replace" not in C.lenient_double_sql("v")
    assert C.trim_text_sql("v").startswith("CASE WHEN") and C.is_blank_sql("v").startswith("CASE WHEN")
    ends = ["a", "", " ", "\t", "!", "~", "\x7f", "é", " ", "\x1c", " ", "a b", "\x00"]
    texts = [x + y for x in ends for y in ends] + [None]
    got = spark.createDataFrame([(t,) for t in texts], "v string").select(
        "v", C.trim_text("v").alias("t"), C.is_blank("v").alias("b")).collect()
    assert all(r.t == (r.v if r.v is None else r.v.strip()) for r in got)
    assert all(r.b == (r.v is not None and not r.v.strip()) for r in got)


def test_samples_scan_each_table_once(spark):
    """Bad values of a table come from one scan, keys without parents from one shuffle of keys,
    and no task sees more than the first values of each other task."""
    engine = quality.QualityEngine(DriverTables(spark, SF_SMALL).dirty_tables())
    values = {s.name for s in engine.specs if s.kind == "positive_finite"}
    plan = _plan(engine.samples(values))
    assert plan.count("lineitem.parquet") == 1 and "WindowGroupLimit" in plan
    keys = _plan(engine.samples({s.name for s in engine.specs if s.kind == "foreign_key"}))
    assert keys.count("hashpartitioning(_space") == 1 and "LeftAnti" not in keys


def test_samples_are_the_first_bad_values(spark):
    rows = [("a", "x%02d" % i, "k%02d" % (i % 30)) for i in range(40)] + [("b", "1", None), (None, None, "p")]
    child = spark.createDataFrame(rows, "c string, v string, fk string")
    parent = spark.createDataFrame([("p",), ("k00",), (None,)], "id string")
    fks = (quality.ForeignKey("t", "fk", "u", "id"), quality.ForeignKey("t", "c", "u", "id"))
    rules = quality.QualityRules({"t": (), "u": ()}, {}, {}, (), (), (("t", "v"),), (("t", "c"),), fks)
    found = quality.QualityEngine({"t": child, "u": parent}, rules).run()
    details = {r.name: r.details for r in found}
    assert details["t.v.positive_finite"]["invalid_values"] == ["x%02d" % i for i in range(20)]
    assert details["t.c.parseable_date"]["invalid_values"] == ["a", "b"]
    assert details["t.fk.fk_u.id"]["missing_values"] == ["k%02d" % i for i in range(1, 21)]
    assert details["t.c.fk_u.id"]["missing_values"] == ["a", "b"]


def test_the_gate_leaves_the_keys_without_parents(spark, tmp_path, monkeypatch):
    """A gated run shuffles the keys once, whatever failed: the first job stores the orphans that
    the samples are taken from, and its checks are those of the plain way."""
    tables = DriverTables(spark, SF_SMALL)
    clean, dirty = tables.raw_tables(), tables.dirty_tables()
    none = {name: frame.where("false") for name, frame in clean.items()}
    orphans = clean | {"orders": none["orders"]}
    absent = {name: frame for name, frame in dirty.items() if name != "orders"}
    for k, case in enumerate((clean, dirty, none, orphans, absent)):
        want = quality.QualityEngine(case).run()
        assert quality.QualityEngine(case).run(work=str(tmp_path / str(k))) == want
    monkeypatch.setattr(quality.QualityEngine, "_missing_keys", lambda *a: 1 / 0)
    engine = quality.QualityEngine(dirty)
    assert any(c.details.get("missing_values") for c in engine.run(work=str(tmp_path / "again")))
    root = str(tmp_path / "rep")
    try:
        job.check_and_report(spark, dirty, root, "r1", "2026-01-01T00:00:00.000Z")
    except quality.QualityGateError as error:
        assert any(c.details.get("missing_values") for c in error.checks)
    # Nothing is left in the work folder.
    assert not fs.exists(spark, f"{shared_dir(spark)}/ledgerlark/r1/gate")


def _fact(spark):
    t = DriverTables(spark, SF_SMALL).raw_tables()
    return marts.fact_order_items(t["customers"], t["orders"], t["order_items"])


def test_cents_are_summed_as_integers(spark):
    """Whole cents pass no decimal arithmetic before their sums, which are those of decimals,
    also where 64 bits would run over, next to other prices, and without any."""
    rows = [("cents", 3, 0.29), ("cents", 5, 100.01), ("large", 2**31 - 1, 9999999.99)] + [
        ("many", 2**31 - 1, 9999999.99)] * 12 + [("mixed", 7, 1.005), ("mixed", 2, 8.5), ("mixed", -4, 0.1),
        ("odd", 3, 0.0001), ("part", None, 2.0), ("part", 3, None), ("part", 1, 4.0), ("none", None, None)]
    lines = spark.createDataFrame(rows, "k string, quantity int, unit_price double")
    want = lines.groupBy("k").agg(F.expr(f"sum({money.line_value_sql(False)})").alias("v"))
    got = lines.withColumn("_c", F.expr(money.CENTS_SQL)).groupBy("k").agg(
        F.expr(money.line_sum_sql("_c", False)).alias("v"))
    assert got.schema == want.schema
    totals = {r.k: r.v for r in got.collect()}
    assert totals == {r.k: r.v for r in want.collect()}
    assert totals["many"] == 12 * (2**31 - 1) * Decimal("9999999.99") and totals["none"] is None
    fact = _fact(spark)
    for frame in (marts.order_rollup(fact), marts.product_revenue(fact)):
        assert re.search(r"partial_sum\(shiftright\(_cents", _plan(frame))


def test_customer_and_country_marts_share_one_reduction(spark, tmp_path):
    """Both marts are read from the stored customers, and are those of the order rollup."""
    rollup = marts.order_rollup(_fact(spark))
    marts.customer_rollup(rollup, True).write.parquet(str(tmp_path / "c"))
    stored = spark.read.parquet(str(tmp_path / "c"))
    for mart in (marts.customer_revenue, marts.country_revenue):
        shared = mart(rollup, True, per_customer=stored)
        assert "lineitem.parquet" not in _plan(shared)
        assert shared.collect() == mart(rollup, False).collect() != []


def test_the_gate_leaves_the_bad_values(spark, tmp_path, monkeypatch):
    """Bad numbers and dates are kept by the gate's job, not searched for, next to text keys;
    without text keys they are searched for."""
    engine = quality.QualityEngine(DriverTables(spark, SF_SMALL).dirty_tables())
    sought = []
    plain = quality.QualityEngine._bad_values
    monkeypatch.setattr(quality.QualityEngine, "_bad_values",
                        lambda self, specs: sought.extend(s.kind for s in specs) or plain(self, specs))
    found = {c.name: c.details for c in engine.run(work=str(tmp_path / "text"))}
    assert found["order_items.unit_price.positive_finite"]["invalid_values"]
    assert found["orders.order_date.parseable_date"]["invalid_values"]
    assert not {"positive_finite", "parseable_date", "foreign_key"} & set(sought)
    # A column named as the gate's own, a value that is null or NaN, keys that are no text.
    rows = [(1, None, "a"), (2, float("nan"), None), (2, -1.5, "b"), (4, 3.0, "2010-02-30"), (5, -1.5, "2010-01-02")]
    child = spark.createDataFrame(rows, "k long, v double, d string").withColumn("_mask", F.lit("x"))
    for kind in ("long", "string"):
        case = {"t": child.withColumn("k", F.col("k").cast(kind)),
                "u": spark.range(1, 4).select(F.col("id").cast(kind).alias("id"))}
        rules = quality.QualityRules({"t": ("_mask",), "u": ()}, {}, {}, (("t", "k"),), (), (("t", "v"),),
                                     (("t", "d"),), (quality.ForeignKey("t", "k", "u", "id"),))
        want = quality.QualityEngine(case, rules).run()
        assert quality.QualityEngine(case, rules).run(work=str(tmp_path / kind)) == want
        details = {c.name: c.details for c in want}
        assert details["t.v.positive_finite"]["invalid_values"] == ["-1.5"]
        assert details["t.d.parseable_date"]["invalid_values"] == ["2010-02-30", "a", "b"]


def test_the_gate_tells_where_no_key_is_hot(spark, tmp_path, monkeypatch):
    """The warehouse stage does not count keys that the gate has counted, also from a manifest,
    and deals out hot ones as before."""
    release = job.Release(spark, str(tmp_path / "wh"))
    raw = DriverTables(spark, SF_SMALL).raw_tables()
    job.run_quality_stage(spark, raw, str(tmp_path / "rep"), "r1", "2026-01-01T00:00:00.000Z", release=release)
    v = job.read_manifest(release, "r1")
    for table, key in (("orders", "customer_id"), ("order_items", "order_id")):
        rows = [r["count"] for r in v.tables[table].groupBy(key).count().collect()]
        assert v.key_rows[f"{table}.{key}"] == (max(rows), sum(rows))
    searched = []
    plain = joins.hot_keys
    monkeypatch.setattr(joins, "hot_keys", lambda lines, key, *a: searched.append(key) or plain(lines, key, *a))
    few = {c: (1, 10**9) for c in v.key_rows}
    job.build_base(spark, v.tables, v.raw_bytes, release, "r1", True, broadcast_bytes=0, key_rows=few)
    assert searched == []
    many = {c: (10**6, 10**6) for c in v.key_rows}
    job.build_base(spark, v.tables, v.raw_bytes, release, "r1", True, broadcast_bytes=0, key_rows=many)
    assert searched == ["customer_id", "order_id"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert joins.none_hot(spark, (1, joins.HOT_SHARE * parts)) and not joins.none_hot(spark, None)
    assert not joins.none_hot(spark, (1, joins.HOT_SHARE * parts - 1))
