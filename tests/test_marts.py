"""Warehouse marts: paid/canceled split, reconciliation, plan shape."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import marts
from ledgerlark.sources.driver_tables import DriverTables
from tests.conftest import SF_SMALL


@pytest.fixture
def split_frames(spark, valid_frames):
    valid_frames["orders"] = spark.createDataFrame(
        [("O1", "C001", "2026-01-01", "paid"), ("O2", "C001", "2026-01-01", "canceled")],
        valid_frames["orders"].schema)
    valid_frames["order_items"] = spark.createDataFrame(
        [("O1", "P1", "Course", 2, 10.0), ("O2", "P1", "Course", 1, 10.0)],
        valid_frames["order_items"].schema)
    return valid_frames


@pytest.mark.parametrize("unique_orders", [False, True])
def test_paid_and_canceled_orders_are_kept_apart(split_frames, unique_orders):
    t = split_frames
    fact = marts.fact_order_items(t["customers"], t["orders"], t["order_items"])
    built = marts.build_marts(fact, unique_orders=unique_orders)
    daily = built["daily_revenue"].first()
    assert (daily.total_orders, daily.paid_orders, daily.canceled_orders) == (2, 1, 1)
    assert daily.gross_revenue == 20.0 and daily.avg_order_value == 20.0
    product = built["product_revenue"].first()
    assert (product.units_sold, product.units_canceled, product.gross_revenue) == (2, 1, 20.0)
    country = built["country_revenue"].first()
    assert (country.customers, country.total_orders) == (1, 2)
    customer = built["customer_revenue"].first()
    assert str(customer.last_paid_order_date) == "2026-01-01"


def test_canceled_only_group_has_zero_revenue_and_null_average(spark, split_frames):
    t = split_frames
    t["orders"] = t["orders"].where(F.col("status") == "canceled")
    fact = marts.fact_order_items(t["customers"], t["orders"], t["order_items"])
    daily = marts.daily_revenue(marts.order_rollup(fact)).first()
    assert daily.gross_revenue == 0.0 and daily.avg_order_value is None


@pytest.fixture(scope="module")
def small_marts(spark):
    raw = DriverTables(spark, SF_SMALL).raw_tables()
    fact = marts.fact_order_items(raw["customers"], raw["orders"], raw["order_items"])
    return raw, fact


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_fast_paths_equal_general_forms(small_marts):
    raw, fact = small_marts
    general = marts.build_marts(fact, unique_orders=False)
    rollup = marts.order_rollup_from_raw(raw["customers"], raw["orders"], raw["order_items"])
    fast = marts.build_marts(fact, unique_orders=True, rollup=rollup)
    for name in marts.MART_NAMES:
        assert _rows(general[name]) == _rows(fast[name]), name


def test_marts_reconcile(small_marts):
    _, fact = small_marts
    built = marts.build_marts(fact)
    sums = {}
    for name in ("daily_revenue", "customer_revenue", "country_revenue"):
        row = built[name].agg(F.sum("total_orders"), F.sum("paid_orders"),
                              F.sum("canceled_orders"), F.sum("gross_revenue")).first()
        sums[name] = (row[0], row[1], row[2], round(row[3], 2))
    assert sums["daily_revenue"] == sums["customer_revenue"] == sums["country_revenue"]


def test_repartitioning_does_not_change_marts(small_marts):
    _, fact = small_marts
    one = marts.build_marts(fact.repartition(1))
    many = marts.build_marts(fact.repartition(16, "product_id"))
    for name in marts.MART_NAMES:
        assert _rows(one[name]) == _rows(many[name]), name


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_mart_plans_have_no_expand_and_no_python(small_marts):
    _, fact = small_marts
    for name, frame in marts.build_marts(fact).items():
        plan = _plan(frame)
        assert "Expand" not in plan, name
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_top_products_plan_is_a_bounded_top_k(small_marts):
    _, fact = small_marts
    plan = _plan(marts.product_revenue(fact))
    assert "TakeOrderedAndProject" in plan


def test_general_path_equals_distinct_counts_on_ungated_keys(spark):
    """Duplicate order ids across customers and statuses, a null order id and
    a canceled-only day: the rollup form must equal COUNT(DISTINCT ...)."""
    import duckdb

    from ledgerlark.plans import oracle_sql

    customers = spark.createDataFrame(
        [("C1", "France", "export"), ("C2", "Spain", "export"), ("C3", "France", "export")],
        "customer_id string, country string, segment string")
    orders = spark.createDataFrame(
        [("O1", "C1", "2026-01-01", "paid"), ("O1", "C2", "2026-01-01", "canceled"),
         ("O2", "C1", "2026-01-01", "paid"), ("O3", "C3", "2026-01-02", "canceled"),
         (None, "C3", "2026-01-02", "paid"), ("O4", "C2", "2026-01-03", "pending")],
        "order_id string, customer_id string, order_date string, status string")
    items = spark.createDataFrame(
        [("O1", "P1", "A", 2, 10.005), ("O1", "P2", "B", 1, 0.001), ("O2", "P1", "A", 3, 10.005),
         ("O3", "P2", "B", 5, 1.0), (None, "P1", "A", 1, 1.0), ("O4", "P3", "C", 1, 2.5)],
        "order_id string, product_id string, description string, quantity bigint, "
        "unit_price double")
    fact = marts.fact_order_items(customers, orders, items)
    built = marts.build_marts(fact, unique_orders=False)

    con = duckdb.connect()
    con.register("fact_df", fact.toPandas())
    for name, body in oracle_sql.MART_BODIES.items():
        sql = "WITH fact AS (SELECT * FROM fact_df)" + oracle_sql.MART_BASE + body
        res = con.execute(sql)
        cols = [d[0] for d in res.description]
        want = sorted(tuple(str(v) for v in row) for row in res.fetchall())
        got = sorted(tuple(str(r[c]) for c in cols) for r in built[name].collect())
        assert got == want, name
