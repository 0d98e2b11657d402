"""Retail relations derived from the star-schema Parquet tables.

The retail jobs consume three raw tables (customers, orders, order_items) and
a flat invoice feed.  These builders map the generic star schema onto that
model so every job and check runs over the whole given tables:

* ``raw_customers`` / ``raw_orders`` / ``raw_order_items`` are clean and pass
  every quality check;
* ``retail_source`` is the flat string feed with dirt placed by key
  arithmetic, so the normalisation has rows to drop;
* ``dirty_*`` are raw tables as strings with broken rows, so every quality
  check has something to find.

The same definitions exist as SQL in ``ledgerlark.plans.oracle_sql`` so an
independent engine can check the results.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.functions.columns import segment
from ledgerlark.operators.joins import broadcast_if_bounded, looked_up

HOME_COUNTRY = "NATION_0"

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def _money_text(c: Column) -> Column:
    # Prices are rendered through DECIMAL(18,2) so the text is engine-neutral.
    return c.cast("decimal(18,2)").cast("string")


def _pick(key: Column, cases: list[tuple[int, Column | str | None]], default: Column) -> Column:
    """``CASE key WHEN r0 THEN v0 ... ELSE default`` for residues of a modulus."""
    expr = None
    for residue, value in cases:
        lit = F.lit(value) if not isinstance(value, Column) else value
        if value is None:
            lit = F.lit(None).cast("string")
        expr = (F.when(key == residue, lit) if expr is None else expr.when(key == residue, lit))
    return expr.otherwise(default)


class DriverTables:
    """Lazily scanned star-schema tables under one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, home_country: str = HOME_COUNTRY):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.home_country = home_country

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # ------------------------------------------------------------------ clean
    def _customers_keyed(self) -> DataFrame:
        """Customers with the numeric key kept for the dirt rules."""
        first_order = (
            self.table("orders")
            .groupBy("o_custkey")
            .agg(F.min("o_orderdate").alias("first_ts"))
        )
        nation = broadcast_if_bounded(self.table("nation").select("n_nationkey", "n_name"))
        return (
            self.table("customer")
            .select("c_custkey", "c_nationkey")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(first_order, F.col("c_custkey") == F.col("o_custkey"))
            .select(
                F.col("c_custkey").alias("_key"),
                F.col("c_custkey").cast("string").alias("customer_id"),
                F.col("n_name").alias("country"),
                segment("n_name", self.home_country).alias("segment"),
                F.to_date("first_ts").cast("string").alias("first_invoice_date"),
            )
        )

    def raw_customers(self) -> DataFrame:
        return self._customers_keyed().drop("_key")

    def _orders_keyed(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("_key"),
            F.col("o_orderkey").cast("string").alias("order_id"),
            F.col("o_custkey").cast("string").alias("customer_id"),
            F.to_date("o_orderdate").cast("string").alias("order_date"),
            F.when(F.col("o_orderstatus") != "P", F.lit("paid"))
            .otherwise(F.lit("canceled"))
            .alias("status"),
        )

    def raw_orders(self) -> DataFrame:
        return self._orders_keyed().drop("_key")

    def _items_keyed(self) -> DataFrame:
        part = looked_up(self.table("part").select("p_partkey", "p_name", "p_retailprice"))
        return (
            self.table("lineitem")
            .select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
            .join(part, F.col("l_partkey") == F.col("p_partkey"))
            .select(
                F.col("l_orderkey").alias("_k"),
                F.col("l_partkey").alias("_p"),
                F.col("l_linenumber").alias("_n"),
                F.col("l_orderkey").cast("string").alias("order_id"),
                F.col("l_partkey").cast("string").alias("product_id"),
                F.col("p_name").alias("description"),
                F.col("l_quantity").cast("bigint").alias("quantity"),
                F.col("p_retailprice").cast("double").alias("unit_price"),
            )
        )

    def raw_order_items(self) -> DataFrame:
        return self._items_keyed().drop("_k", "_p", "_n")

    def raw_tables(self) -> dict[str, DataFrame]:
        return {
            "customers": self.raw_customers(),
            "orders": self.raw_orders(),
            "order_items": self.raw_order_items(),
        }

    # -------------------------------------------------------------- flat feed
    def retail_source(self) -> DataFrame:
        """Flat invoice feed, eight string columns, with injected dirt."""
        orders = self.table("orders").select(
            "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"
        )
        part = looked_up(self.table("part").select("p_partkey", "p_name", "p_retailprice"))
        # The estimate of a join is the product of its sides, so each is judged by itself.
        supplier = looked_up(self.table("supplier").select("s_suppkey", "s_nationkey"))
        nation = broadcast_if_bounded(self.table("nation").select("n_nationkey", "n_name"))
        lines = (
            self.table("lineitem")
            .select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
            .join(looked_up(orders), F.col("l_orderkey") == F.col("o_orderkey"))
            .join(part, F.col("l_partkey") == F.col("p_partkey"))
            .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
            .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        )
        k, p, n = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
        day = F.to_date("o_orderdate").cast("string")
        cancel_prefix = (
            F.when(F.col("o_orderstatus") == "P",
                   F.when(F.col("o_orderkey") % 2 == 0, F.lit("C")).otherwise(F.lit("c")))
            .otherwise(F.lit(""))
        )
        sign = F.when((F.col("o_orderstatus") == "F") & (k % 10 == 3), F.lit("-")).otherwise(F.lit(""))
        return lines.select(
            F.when(p % 211 == 0, F.lit(None).cast("string"))
            .otherwise(F.concat(F.lit("  "), cancel_prefix, F.col("o_orderkey").cast("string"), F.lit(" ")))
            .alias("InvoiceNo"),
            F.when((k + p) % 503 == 0, F.lit("")).otherwise(p.cast("string")).alias("StockCode"),
            F.when(p % 101 == 0, F.lit("   "))
            .otherwise(F.concat(F.lit(" "), F.col("p_name"), F.lit(" ")))
            .alias("Description"),
            _pick((k + p + n) % 97, [(0, "0"), (1, "1.5"), (2, "inf"), (3, "abc"), (4, None)],
                  F.concat(sign, F.col("l_quantity").cast("bigint").cast("string")))
            .alias("Quantity"),
            _pick((k + p) % 127, [(0, "invalid-date"), (1, F.concat(day, F.lit(" junk")))],
                  F.concat(day, F.lit(" 08:26:00")))
            .alias("InvoiceDate"),
            _pick((k + 2 * p + n) % 89, [(0, "0"), (1, "-1"), (2, "nan"), (3, "0.001")],
                  _money_text(F.col("p_retailprice")))
            .alias("UnitPrice"),
            F.when(F.col("o_custkey") % 13 == 0, F.lit(None).cast("string"))
            .otherwise(F.concat(F.col("o_custkey").cast("string"), F.lit(".0")))
            .alias("CustomerID"),
            F.when((k + p) % 113 == 0, F.lit(" ")).otherwise(F.col("n_name")).alias("Country"),
        )

    # ------------------------------------------------------------ dirty raw
    def dirty_customers(self) -> DataFrame:
        c = F.col("_key")
        rows = self._customers_keyed().where(c % 97 != 0)
        null = F.lit(None).cast("string")
        dirty = rows.select(
            c,
            F.when(c % 89 == 0, null).otherwise(F.col("customer_id")).alias("customer_id"),
            F.when(c % 83 == 0, F.lit("  ")).when(c % 79 == 0, null)
            .otherwise(F.col("country")).alias("country"),
            F.when(c % 71 == 0, F.lit("vip")).otherwise(F.col("segment")).alias("segment"),
            F.when(c % 67 == 0, F.lit("invalid-date"))
            .when(c % 61 == 0, F.concat(F.col("first_invoice_date"), F.lit(" junk")))
            .when(c % 59 == 0, null)
            .otherwise(F.col("first_invoice_date")).alias("first_invoice_date"),
        )
        return _duplicate_where(dirty, c % 101 == 0).drop("_key")

    def dirty_orders(self) -> DataFrame:
        o = F.col("_key")
        null = F.lit(None).cast("string")
        dirty = self._orders_keyed().select(
            o,
            F.when(o % 199 == 0, null).otherwise(F.col("order_id")).alias("order_id"),
            F.when(o % 131 == 0, null).otherwise(F.col("customer_id")).alias("customer_id"),
            F.when(o % 109 == 0, F.lit("2010-02-30")).otherwise(F.col("order_date")).alias("order_date"),
            F.when(o % 127 == 0, F.lit("pending")).when(o % 107 == 0, F.lit(" "))
            .when(o % 113 == 0, null).otherwise(F.col("status")).alias("status"),
        )
        return _duplicate_where(dirty, o % 151 == 0).drop("_key")

    def dirty_items(self) -> DataFrame:
        k, p, n = F.col("_k"), F.col("_p"), F.col("_n")
        null = F.lit(None).cast("string")
        return self._items_keyed().select(
            F.when((k + p) % 173 == 0, F.concat(F.lit("X"), k.cast("string")))
            .when((k + p) % 167 == 0, null)
            .otherwise(F.col("order_id")).alias("order_id"),
            F.col("product_id"),
            F.when(p % 103 == 0, F.lit(" ")).otherwise(F.col("description")).alias("description"),
            _pick((k + p + n) % 97, [(0, "0"), (1, "-3"), (2, None)],
                  F.col("quantity").cast("string")).alias("quantity"),
            _pick((k + 2 * p + n) % 89, [(0, "inf"), (1, "nan"), (2, "abc"), (3, "0")],
                  _money_text(F.col("unit_price"))).alias("unit_price"),
        )

    def dirty_tables(self) -> dict[str, DataFrame]:
        return {
            "customers": self.dirty_customers(),
            "orders": self.dirty_orders(),
            "order_items": self.dirty_items(),
        }



def _duplicate_where(df: DataFrame, condition: Column) -> DataFrame:
    """Emit rows matching ``condition`` twice, others once, in one pass."""
    copies = F.when(condition, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return df.withColumn("_copy", F.explode(copies)).drop("_copy")
