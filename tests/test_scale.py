"""Scale properties: hot keys, pre-aggregation before shuffles, join strategy."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import joins, marts, normalize, quality
from ledgerlark.plans import job
from ledgerlark.sources.driver_tables import DriverTables
from tests.conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _hot_tables(spark):
    """One order carries a third of all lines."""
    raw = DriverTables(spark, SF_SMALL).raw_tables()
    items = raw["order_items"]
    # A deterministic half of the lines (a plain limit may pick different rows
    # each time the frame is evaluated) is re-keyed to one order.
    hot = items.where(F.col("order_id").cast("long") % 2 == 0).withColumn("order_id", F.lit("0"))
    raw["order_items"] = items.unionByName(hot)
    return raw


def test_hot_order_marts_match_plain_computation(spark):
    raw = _hot_tables(spark)
    fact = marts.fact_order_items(raw["customers"], raw["orders"], raw["order_items"])
    daily = {r.order_date: r for r in marts.daily_revenue(marts.order_rollup(fact)).collect()}
    plain = (fact.groupBy("order_date").agg(
        F.countDistinct("order_id").alias("n"),
        F.sum(F.when(F.col("status") == "paid", F.col("quantity").cast("decimal(10,0)")
                     * F.col("unit_price").cast("decimal(18,6)"))).alias("rev"))
        .collect())
    for r in plain:
        got = daily[r.order_date]
        assert got.total_orders == r.n
        assert got.gross_revenue == float(round(r.rev or 0, 2))


def test_key_checks_and_rollup_aggregate_before_shuffling(spark):
    raw = _hot_tables(spark)
    engine = quality.QualityEngine(raw)
    engine.specs = [s for s in engine.specs if s.kind in ("unique", "foreign_key")]
    plan = _plan(engine.results())
    # Every exchange of key counts is fed by a partial aggregate, so a hot key
    # crosses the shuffle once per map task.
    assert "partial_count" in plan
    assert "LeftAnti" not in plan and "Expand" not in plan
    fact = marts.fact_order_items(raw["customers"], raw["orders"], raw["order_items"])
    rollup_plan = _plan(marts.order_rollup(fact))
    assert re.search(r"HashAggregate\(keys=\[.*order_id.*functions=\[partial_sum", rollup_plan)


def test_measured_broadcast_and_shuffle_paths_agree(spark, tmp_path):
    raw = DriverTables(spark, SF_SMALL).raw_tables()
    results = {}
    for label, limit in (("broadcast", job.MEASURED_BROADCAST_BYTES), ("shuffle", 0)):
        release = job.Release(spark, str(tmp_path / label))
        validation = job.run_quality_stage(spark, raw, str(tmp_path / f"rep-{label}"), label,
                                           "2026-01-01T00:00:00.000Z", release=release)
        assert validation.raw_bytes["customers"] > 0
        job.run_warehouse_stage(spark, validation, str(tmp_path / label),
                                broadcast_bytes=limit)
        results[label] = {
            m: sorted(tuple(r) for r in release.read(f"marts/{m}").collect())
            for m in marts.MART_NAMES
        }
    assert results["broadcast"] == results["shuffle"]


def test_scans_read_only_needed_columns(spark, tmp_path):
    raw = DriverTables(spark, SF_SMALL).raw_tables()
    fact = marts.fact_order_items(raw["customers"], raw["orders"], raw["order_items"])
    fact.write.parquet(str(tmp_path / "fact"))
    stored = spark.read.parquet(str(tmp_path / "fact"))
    plan = stored.select("product_id", "description", "quantity", "unit_price",
                         "is_revenue_order").transform(marts.product_revenue)
    text = plan._jdf.queryExecution().executedPlan().toString()
    schema = re.search(r"FileScan parquet \[([^\]]*)\]", text).group(1)
    assert "product_id" in schema and "quantity" in schema
    for unused in ("customer_id", "country", "segment", "order_date", "line_value"):
        assert unused not in schema, unused
    daily = marts.daily_revenue(marts.order_rollup(stored), ordered=False)
    text = daily._jdf.queryExecution().executedPlan().toString()
    schema = re.search(r"FileScan parquet \[([^\]]*)\]", text).group(1)
    assert "product_id" not in schema and "description" not in schema


def test_the_gate_scans_each_table_once(spark, tmp_path):
    tables = {}
    for name, frame in DriverTables(spark, SF_SMALL).raw_tables().items():
        frame.write.parquet(str(tmp_path / name))
        tables[name] = spark.read.parquet(str(tmp_path / name))
    plan = _plan(quality.QualityEngine(tables).results())
    assert plan.count("FileScan parquet") == len(tables)
    for column in ("first_invoice_date", "status", "unit_price"):  # one of each table alone
        assert len(re.findall(rf"FileScan parquet \[[^\]]*{column}", plan)) == 1, column
    assert "Join" not in plan


def test_order_header_and_counts_fold_in_hash_maps(spark):
    tables = DriverTables(spark, SF_SMALL)
    lines = normalize.parsed_lines(tables.retail_source(), tables.home_country)
    header = _plan(normalize.orders_from(normalize.clean_lines(lines)))
    assert "HashAggregate" in header and "SortAggregate" not in header
    counts = _plan(normalize.preparation_counts(lines))
    assert "SortAggregate" not in counts
    assert len(re.findall(r"FileScan parquet [^\n]*/lineitem\.parquet", counts)) == 1


def _one_hot_order(spark, n_orders=4000, n_customers=800):
    """Orders of six lines each but for one that holds a third of all lines; a third of the
    orders is of one customer."""
    customers = spark.range(n_customers).selectExpr(
        "concat('c', id) customer_id", "concat('land', id % 5) country", "'new' segment")
    orders = spark.range(n_orders).selectExpr(
        "concat('o', id) order_id", f"concat('c', IF(id % 3 = 0, 7, id % {n_customers})) customer_id",
        "'2026-01-02' order_date", "IF(id % 9 = 0, 'canceled', 'paid') status")
    items = spark.range(9 * n_orders).selectExpr(
        f"concat('o', IF(id % 3 = 0, 11, id % {n_orders})) order_id", "concat('p', id % 50) product_id",
        "'thing' description", "id % 7 + 1 quantity", "1.25D unit_price")
    return customers, orders, items


@pytest.fixture
def no_aqe(spark):
    names = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def _loads(frame):
    return sorted(r["count"] for r in frame.groupBy(F.spark_partition_id().alias("task")).count().collect())


def test_hot_order_is_dealt_out_without_aqe(spark, no_aqe):
    customers, orders, items = _one_hot_order(spark)
    hot = {"order_id": joins.hot_keys(items, "order_id"),
           "customer_id": joins.hot_keys(orders, "customer_id")}
    assert [r.order_id for r in hot["order_id"].collect()] == ["o11"]
    assert [r.customer_id for r in hot["customer_id"].collect()] == ["c7"]
    plain = marts.fact_order_items(customers, orders, items)
    dealt = marts.fact_order_items(customers, orders, items, hot=hot)
    assert dealt.columns == plain.columns
    assert dealt.exceptAll(plain).isEmpty() and plain.exceptAll(dealt).isEmpty()
    before, after = _loads(plain), _loads(dealt)
    assert before[-1] > 2 * before[len(before) // 2]  # the salt has something to do
    assert len(after) == 8 and after[-1] < 2 * after[len(after) // 2]
    headers = _loads(marts._with_customers(orders.select("order_id", "customer_id"), customers, hot))
    assert headers[-1] < 2 * headers[len(headers) // 2]
    rollup = [marts.order_rollup_from_raw(customers, orders, items, hot=h) for h in (None, hot)]
    assert rollup[0].exceptAll(rollup[1]).isEmpty() and rollup[1].exceptAll(rollup[0]).isEmpty()


def test_dealt_join_of_null_repeated_and_missing_keys(spark):
    lines = spark.createDataFrame([("a", n) for n in range(40)] + [("b", 1), (None, 2), ("gone", 3)],
                                  "k string, n long")
    header = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), ("idle", 5)], "k string, h long")
    hot = joins.hot_keys(lines, "k", partitions=2)
    assert [r.k for r in hot.collect()] == ["a"]
    got = sorted(map(tuple, joins.join_dealt(lines, header, "k", hot).collect()))
    want = sorted(map(tuple, header.join(lines, "k").collect()))
    assert len(got) == 81 and got == want
    empty = lines.limit(0)
    assert joins.hot_keys(empty, "k") is None
    assert joins.join_dealt(empty, header, "k", hot).isEmpty()
