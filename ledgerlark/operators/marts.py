"""Warehouse: the order-line fact table and four revenue marts (M0-M5).

Plan shape
----------
* The fact is two equi-joins (orders-customers on ``customer_id``, then the
  items on ``order_id``).  No hints: AQE turns a join into a broadcast only
  from measured sizes.  When one order or one customer carries a large share of
  the rows, its rows are dealt out by a salt (``joins.join_dealt``).
* Money is summed exactly (``operators/money.py``), so the totals do not depend on
  partitioning or summation order.  Lines whose price DECIMAL(27,12) does not hold are
  summed by limbs and joined to each mart; where there are none, no plan changes.
* Distinct order counts never use ``count(DISTINCT ...)``: with three distinct
  expressions Catalyst plans an ``Expand`` that multiplies the input rows.
  Instead lines are first rolled up to one row per order (``order_rollup``),
  a reduction that partial aggregation performs map-side, and the marts
  count those rows.  When the quality gate has proven ``order_id`` and
  ``customer_id`` unique (``unique_orders=True``) the rollup holds each order
  exactly once and every mart is a single aggregate over it; otherwise an
  extra ``(mart keys, order_id)`` level keeps the distinct semantics exact for
  any input.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.columns import (
    DEFAULT_DATE_FORMATS,
    Sql,
    money_round_sql,
    revenue_flag,
    strict_timestamp,
)
from ledgerlark.operators import money
from ledgerlark.operators.joins import join_dealt

# Mart names and their column order.
MART_COLUMNS: dict[str, tuple[str, ...]] = {
    "daily_revenue": ("order_date", "total_orders", "paid_orders", "canceled_orders",
                      "gross_revenue", "avg_order_value"),
    "customer_revenue": ("customer_id", "country", "segment", "total_orders", "paid_orders",
                         "canceled_orders", "gross_revenue", "last_paid_order_date"),
    "product_revenue": ("product_id", "description", "units_sold", "units_canceled",
                        "gross_revenue"),
    "country_revenue": ("country", "segment", "customers", "total_orders", "paid_orders",
                        "canceled_orders", "gross_revenue"),
}
MART_NAMES: tuple[str, ...] = tuple(MART_COLUMNS)
PRODUCT_TOP_N = 25

FACT_COLUMNS = (
    "order_id", "customer_id", "country", "segment", "order_date", "status", "product_id",
    "description", "quantity", "unit_price", "line_value", "is_revenue_order",
)

_ORDER_KEYS = ("order_id", "customer_id", "country", "segment", "order_date", "status")


# (column, descending) pairs of each mart's published order; nulls last.
_SORT: dict[str, tuple[tuple[str, bool], ...]] = {
    "daily_revenue": (("order_date", False),),
    "customer_revenue": (("gross_revenue", True), ("customer_id", False)),
    "product_revenue": (("gross_revenue", True), ("product_id", False), ("description", False)),
    "country_revenue": (("gross_revenue", True), ("country", False), ("segment", False)),
}


def sort_keys(mart: str) -> list[Column]:
    """The published order of a mart; nulls last in both directions."""
    return [F.col(c).desc_nulls_last() if desc else F.col(c).asc_nulls_last()
            for c, desc in _SORT[mart]]


def _with_cents(fact: DataFrame) -> DataFrame:
    """Fact lines with _cents, the paid revenue of a line as BIGINT; 0 for unpaid lines, null if
    unknown or not in whole cents."""
    return fact.withColumn("_cents", F.expr(
        f"CASE WHEN is_revenue_order = 1 THEN {money.CENTS_SQL} ELSE 0L END"))


def _exprs(*pairs: tuple[str, str]) -> list[Column]:
    return [F.expr(f"{expr} AS {name}") for name, expr in pairs]


def _dated(orders: DataFrame, date_formats: Sequence[str]) -> DataFrame:
    """Order headers with the day as a date, in the layouts the gate accepts.  ISO
    text needs the cast only; text in no layout fails the cast."""
    day = F.col("order_date").cast("date")
    if tuple(date_formats) != DEFAULT_DATE_FORMATS:
        parsed = strict_timestamp("order_date", date_formats, orders.schema["order_date"].dataType)
        day = F.coalesce(parsed.cast("date"), day)
    return orders.select("order_id", "customer_id", day.alias("order_date"), "status")


def _with_customers(orders: DataFrame, customers: DataFrame,
                    hot: Mapping[str, DataFrame | None] | None) -> DataFrame:
    """Order headers with their customer's attributes."""
    dealt = (hot or {}).get("customer_id")
    if dealt is None:
        return orders.join(customers, "customer_id")
    return join_dealt(orders, customers, "customer_id", dealt)


def fact_order_items(customers: DataFrame, orders: DataFrame, items: DataFrame,
                     date_formats: Sequence[str] = DEFAULT_DATE_FORMATS,
                     hot: Mapping[str, DataFrame | None] | None = None,
                     hashed: Sequence[str] = ()) -> DataFrame:
    """One row per order line with customer attributes (M0, J1, J2, F18-F20).  ``hot``: by
    join key, the keys whose rows are dealt out (``joins.hot_keys``).  ``hashed``: which of
    customers and orders (``joins.fits_hash_map``) are looked up in hash maps where they are shuffled."""
    o = _dated(orders, date_formats)
    c = customers.select("customer_id", "country", "segment")
    i = items.select("order_id", "product_id", "description", "quantity", "unit_price")
    header = _with_customers(o, c.hint("shuffle_hash") if "customers" in hashed else c, hot)
    header = header.hint("shuffle_hash") if "orders" in hashed else header
    joined = join_dealt(i, header, "order_id", (hot or {}).get("order_id"))
    return joined.select(
        "order_id",
        "customer_id",
        "country",
        "segment",
        "order_date",
        "status",
        "product_id",
        "description",
        F.col("quantity").cast("int").alias("quantity"),
        F.col("unit_price").cast("double").alias("unit_price"),
        (F.col("quantity").cast("double") * F.col("unit_price").cast("double")).alias("line_value"),
        revenue_flag("status").alias("is_revenue_order"),
    )


def wide_lines(fact: DataFrame) -> DataFrame:
    """The paid lines whose price needs the sum by limbs."""
    return fact.where("is_revenue_order = 1").where(f"NOT {money.FITS_SQL}")


def has_wide_prices(items: DataFrame) -> bool:
    """Whether any price of ``items`` needs the sum by limbs: a scan of one column."""
    return bool(items.select("unit_price").where(f"NOT {money.FITS_SQL}").take(1))


def order_rollup(fact: DataFrame, split: bool = False) -> DataFrame:
    """Fact lines reduced to one row per order and its attributes.  With ``split`` the lines
    of ``wide_lines`` are left to the marts' limbs.

    Grouping by every order-level attribute loses nothing the marts need, and
    because the keys include ``order_id`` partial aggregation collapses the
    lines of an order before the shuffle.
    """
    return _with_cents(fact).groupBy(*_ORDER_KEYS).agg(
        *_exprs(("revenue", money.line_sum_sql("_cents", split)), ("lines", "count(1)")))


def order_rollup_from_raw(customers: DataFrame, orders: DataFrame, items: DataFrame,
                          date_formats: Sequence[str] = DEFAULT_DATE_FORMATS,
                          split: bool = False,
                          hot: Mapping[str, DataFrame | None] | None = None) -> DataFrame:
    """The same rollup computed without the fact: items are pre-aggregated per
    order (map-side partial aggregation, so only one row per order and map
    task crosses the shuffle), then joined with orders and customers.

    A paid order's revenue is the exact sum of its lines, an unpaid order's is
    0; only lines joining an order and a customer count, as in the fact.
    Equal to ``order_rollup(fact_order_items(...))`` whenever ``order_id`` is
    unique in ``orders``, which the quality gate guarantees before the job
    uses it.
    """
    per_order = items.withColumn("_cents", F.expr(money.CENTS_SQL)).groupBy("order_id").agg(
        *_exprs(("_gross", money.line_sum_sql("_cents", split)), ("lines", "count(1)")))
    o = _dated(orders, date_formats)
    c = customers.select("customer_id", "country", "segment")
    joined = _with_customers(o, c, hot).join(per_order, "order_id")
    return joined.select(
        "order_id", "customer_id", "country", "segment",
        "order_date", "status",
        F.when(revenue_flag("status") == 1, F.col("_gross")).otherwise(F.lit(0)).alias("revenue"),
        "lines",
    )


def _order_flags(rollup: DataFrame) -> DataFrame:
    return rollup.selectExpr(
        *_ORDER_KEYS, "revenue",
        "CAST(order_id IS NOT NULL AND status = 'paid' AS INT) AS paid",
        "CAST(order_id IS NOT NULL AND status = 'canceled' AS INT) AS canceled",
        "CASE WHEN status = 'paid' THEN order_date END AS paid_date",
    )


def _per_order(rollup: DataFrame, keys: Sequence[str], unique_orders: bool) -> DataFrame:
    """One row per (keys, order_id): flags folded with max, revenue summed."""
    flagged = _order_flags(rollup)
    if unique_orders:
        return flagged
    return flagged.groupBy(*keys, "order_id").agg(*_exprs(
        ("paid", "max(paid)"), ("canceled", "max(canceled)"),
        ("revenue", "sum(revenue)"), ("paid_date", "max(paid_date)")))


def _order_counts() -> list[Column]:
    return _exprs(
        ("total_orders", "count(order_id)"),
        ("paid_orders", "CAST(sum(paid) AS BIGINT)"),
        ("canceled_orders", "CAST(sum(canceled) AS BIGINT)"),
        ("_revenue", "sum(revenue)"),
    )


def _limbs(wide: DataFrame | None, keys: Sequence[str]) -> DataFrame | None:
    return None if wide is None else money.limb_sums(wide, keys)


def daily_revenue(rollup: DataFrame, unique_orders: bool = False, ordered: bool = True,
                  wide: DataFrame | None = None) -> DataFrame:
    """Orders and paid revenue per day (M1).  ``wide``: the ``wide_lines`` that the rollup
    left out."""
    per_day = _per_order(rollup, ["order_date"], unique_orders).groupBy("order_date").agg(
        *_order_counts()
    )
    per_day = money.with_limbs(per_day, _limbs(wide, ["order_date"]), ["order_date"])
    out = per_day.select(
        "order_date", "total_orders", "paid_orders", "canceled_orders",
        *_exprs(("gross_revenue", money.cents_sql("_revenue")),
                ("avg_order_value", money_round_sql(
                    Sql(f"try_divide({money.double_sql('_revenue')}, paid_orders)")))),
    )
    return out.orderBy(*sort_keys("daily_revenue")) if ordered else out


_CUSTOMER_KEYS = ("customer_id", "country", "segment")


def customer_rollup(rollup: DataFrame, unique_orders: bool = False) -> DataFrame:
    """One row per customer and its attributes, from which the customer and, of unique orders,
    the country mart are made."""
    return _per_order(rollup, _CUSTOMER_KEYS, unique_orders).groupBy(*_CUSTOMER_KEYS).agg(
        *_order_counts(), *_exprs(("last_paid_order_date", "max(paid_date)")))


def customer_revenue(rollup: DataFrame, unique_orders: bool = False, ordered: bool = True,
                     wide: DataFrame | None = None,
                     per_customer: DataFrame | None = None) -> DataFrame:
    """Orders, revenue and last paid day per customer (M2).  ``per_customer``: the stored
    ``customer_rollup``."""
    keys = list(_CUSTOMER_KEYS)
    if per_customer is None:
        per_customer = customer_rollup(rollup, unique_orders)
    per_customer = money.with_limbs(per_customer, _limbs(wide, keys), keys)
    out = per_customer.select(
        *keys, "total_orders", "paid_orders", "canceled_orders",
        *_exprs(("gross_revenue", money.cents_sql("_revenue"))), "last_paid_order_date",
    )
    return out.orderBy(*sort_keys("customer_revenue")) if ordered else out


def product_revenue(fact: DataFrame, top_n: int | None = PRODUCT_TOP_N,
                    wide: DataFrame | None = None) -> DataFrame:
    """Units sold and not paid, and paid revenue per product; top ``top_n`` (M3).

    The ordered limit plans as ``TakeOrderedAndProject``: every partition
    keeps its own best ``top_n`` rows, so only ``top_n`` x partitions reach
    the final merge.
    """
    keys = ["product_id", "description"]
    grouped = _with_cents(fact).groupBy(*keys).agg(*_exprs(
        ("units_sold", "CAST(sum(quantity * is_revenue_order) AS BIGINT)"),
        ("units_canceled", "CAST(sum(quantity * (1 - is_revenue_order)) AS BIGINT)"),
        ("_revenue", money.line_sum_sql("_cents", wide is not None)),
    ))
    grouped = money.with_limbs(grouped, _limbs(wide, keys), keys).select(
        *keys, "units_sold", "units_canceled",
        *_exprs(("gross_revenue", money.cents_sql("_revenue"))))
    ordered = grouped.orderBy(*sort_keys("product_revenue"))
    return ordered.limit(top_n) if top_n else ordered


def country_revenue(rollup: DataFrame, unique_orders: bool = False, ordered: bool = True,
                    wide: DataFrame | None = None,
                    per_customer: DataFrame | None = None) -> DataFrame:
    """Customers, orders and revenue per country and segment (M4).  ``per_customer``: the stored
    ``customer_rollup``, read where orders are unique."""
    keys = ["country", "segment"]
    if unique_orders:
        # Each order sits under exactly one customer, so customers can be
        # counted on the way up without a second distinct pass.
        if per_customer is None:
            per_customer = customer_rollup(rollup, True)
        grouped = per_customer.groupBy(*keys).agg(*_exprs(
            ("customers", "count(customer_id)"),
            ("total_orders", "CAST(sum(total_orders) AS BIGINT)"),
            ("paid_orders", "CAST(sum(paid_orders) AS BIGINT)"),
            ("canceled_orders", "CAST(sum(canceled_orders) AS BIGINT)"),
            ("_revenue", "sum(_revenue)")))
    else:
        orders_part = _per_order(rollup, keys, False).groupBy(*keys).agg(*_order_counts())
        customers_part = (
            rollup.select(*keys, "customer_id").distinct()
            .groupBy(*keys).agg(F.count("customer_id").alias("customers"))
            .withColumnsRenamed({"country": "_country", "segment": "_segment"})
        )
        grouped = orders_part.join(
            customers_part,
            F.col("country").eqNullSafe(F.col("_country"))
            & F.col("segment").eqNullSafe(F.col("_segment")),
        )
    out = money.with_limbs(grouped, _limbs(wide, keys), keys).select(
        *keys, "customers", "total_orders", "paid_orders", "canceled_orders",
        *_exprs(("gross_revenue", money.cents_sql("_revenue"))),
    )
    return out.orderBy(*sort_keys("country_revenue")) if ordered else out


def build_marts(fact: DataFrame, unique_orders: bool = False, rollup: DataFrame | None = None,
                ordered: bool = True, split: bool = False,
                per_customer: DataFrame | None = None) -> dict[str, DataFrame]:
    """All four marts from one fact (M5).  Pass a materialised ``rollup`` to
    avoid re-reducing the fact for each order-grain mart, and a ``customer_rollup`` to avoid
    re-reducing that for each customer.  ``split``: some prices need the
    sum by limbs (``has_wide_prices``); without it such a price is an error, never a loss."""
    rollup = order_rollup(fact, split) if rollup is None else rollup
    wide = wide_lines(fact) if split else None
    return {
        "daily_revenue": daily_revenue(rollup, unique_orders, ordered, wide),
        "customer_revenue": customer_revenue(rollup, unique_orders, ordered, wide, per_customer),
        "product_revenue": product_revenue(fact, wide=wide),
        "country_revenue": country_revenue(rollup, unique_orders, ordered, wide, per_customer),
    }
