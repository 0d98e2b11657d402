"""Exact money at both ends of the range, against decimal arithmetic."""

from __future__ import annotations

from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal, getcontext

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerlark.operators import marts, money
from ledgerlark.plans import job
from ledgerlark.sources.sinks import Release

getcontext().prec = 700
PRICES = (1e-13, 1e-7, 1e16, 0.1, 1.005, 123456789.123456789, 2.5e-300, 999999999.99, 0.005,
          1.7976931348623157e300, 1234567890123456.8, 3e9)


@pytest.fixture
def tables(spark):
    """Each customer has its own set of prices; one has plain ones only."""
    customers = [(f"C{k}", "Chile", "export", "2026-01-01") for k in range(5)]
    orders = [(f"O{k}", f"C{k % 5}", f"2026-01-{1 + k % 5:02d}", "paid" if k % 4 else "canceled")
              for k in range(60)]
    items = []
    for k in range(60):
        some = {0: PRICES, 1: PRICES[:3], 2: PRICES[3:5], 3: (0.005, 1e-7), 4: PRICES[6:]}[k % 5]
        items += [(f"O{k}", f"P{n % 3}", "d", 1 + (k * 7 + n) % 13, price) for n, price in enumerate(some)]
    return {
        "customers": spark.createDataFrame(customers, "customer_id string, country string, segment "
                                                      "string, first_invoice_date string"),
        "orders": spark.createDataFrame(orders, "order_id string, customer_id string, order_date "
                                                "string, status string"),
        "order_items": spark.createDataFrame(items, "order_id string, product_id string, description "
                                                    "string, quantity bigint, unit_price double")}


def cents(total):
    return float(total.quantize(Decimal("0.01"), ROUND_HALF_UP))


def expected(tables, key):
    orders = {r.order_id: r for r in tables["orders"].collect()}
    totals, paid = defaultdict(Decimal), defaultdict(set)
    for r in tables["order_items"].collect():
        o = orders[r.order_id]
        name = key(o, r)
        totals[name] += r.quantity * Decimal(repr(r.unit_price)) * (o.status == "paid")
        paid[name] |= {r.order_id} if o.status == "paid" else set()
    return totals, paid


@pytest.mark.parametrize("partitions", [1, 16])
def test_marts_equal_the_exact_sum(spark, tables, partitions):
    t = {**tables, "order_items": tables["order_items"].repartition(partitions)}
    fact = marts.fact_order_items(t["customers"], t["orders"], t["order_items"])
    assert marts.has_wide_prices(t["order_items"])
    built = marts.build_marts(fact, split=True)
    totals, paid = expected(tables, lambda o, r: o.order_date)
    for r in built["daily_revenue"].collect():
        day = str(r.order_date)
        assert r.gross_revenue == cents(totals[day])
        mean = float(totals[day]) / len(paid[day])
        assert r.avg_order_value == pytest.approx(mean, rel=1e-12, abs=0.005)
    totals, _ = expected(tables, lambda o, r: o.customer_id)
    assert {r.customer_id: r.gross_revenue for r in built["customer_revenue"].collect()} == {
        k: cents(v) for k, v in totals.items()}
    totals, _ = expected(tables, lambda o, r: r.product_id)
    assert {r.product_id: r.gross_revenue for r in built["product_revenue"].collect()} == {
        k: cents(v) for k, v in totals.items()}
    totals, _ = expected(tables, lambda o, r: "all")
    assert built["country_revenue"].first().gross_revenue == cents(totals["all"])


def test_many_tiny_prices_add_up_to_cents(spark):
    """Half a cent from 5,000 lines of 1e-6 exactly, and just below it."""
    for n, want in ((5000, 0.01), (4999, 0.0)):
        lines = spark.range(n, numPartitions=7).select(
            F.lit("k").alias("k"), F.lit(1).alias("quantity"), F.lit(1e-6).alias("unit_price"))
        lines = lines.unionByName(spark.createDataFrame([("k", 1, 1e-300)], lines.schema))
        plain = lines.groupBy("k").agg(F.expr(f"sum({money.line_value_sql(True)})").alias("total"))
        limbs = money.limb_sums(lines, ["k"])
        row = money.with_limbs(plain, limbs, ["k"]).selectExpr(
            f"{money.cents_sql('total')} AS cents", f"{money.double_sql('total')} AS exact").first()
        assert row.cents == want
        assert row.exact == float(n * Decimal("1e-6") + Decimal("1e-300"))


def test_a_wide_price_is_never_lost(spark, tables):
    fact = marts.fact_order_items(tables["customers"], tables["orders"], tables["order_items"])
    with pytest.raises(PySparkException, match="limbs"):
        marts.build_marts(fact)["daily_revenue"].collect()


@pytest.mark.parametrize("overlap", [False, True])
def test_a_run_over_wide_prices(spark, tables, tmp_path, overlap):
    out = str(tmp_path / "wh")
    job.run_pipeline(spark, tables, out, str(tmp_path / "rep"), overlap=overlap)
    totals, _ = expected(tables, lambda o, r: o.customer_id)
    got = Release(spark, out).read("marts/customer_revenue").collect()
    assert {r.customer_id: r.gross_revenue for r in got} == {k: cents(v) for k, v in totals.items()}
