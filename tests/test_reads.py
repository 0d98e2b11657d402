"""Paged mart reads and readiness."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import marts, reads
from ledgerlark.plans import job
from ledgerlark.sources.driver_tables import DriverTables
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("published")
    raw = DriverTables(spark, SF_SMALL).raw_tables()
    job.run_pipeline(spark, raw, str(root / "wh"), str(root / "rep"))
    return str(root / "wh"), str(root / "rep")


def test_page_bounds_and_totals(spark, published):
    out, _ = published
    page = reads.read_mart_page(spark, out, "daily-revenue", limit=10, offset=5)
    rows = page.rows.collect()
    assert page.total >= 15 and len(rows) == 10
    full = [r.order_date for r in reads.page(spark.read.parquet(
        f"{out}/runs/{open(out + '/_CURRENT').read().strip()}/marts/daily_revenue"),
        "daily_revenue", limit=1000).collect()]
    assert [r.order_date for r in rows] == full[5:15]
    tail = reads.read_mart_page(spark, out, "daily-revenue", limit=1000, offset=page.total - 3)
    assert tail.rows.count() == 3


@pytest.mark.parametrize("limit,offset", [(0, 0), (1001, 0), (10, -1)])
def test_bad_bounds_are_rejected(spark, published, limit, offset):
    with pytest.raises(ValueError):
        reads.read_mart_page(spark, published[0], "daily-revenue", limit=limit, offset=offset)


def test_unknown_mart(spark, published):
    with pytest.raises(KeyError):
        reads.read_mart_page(spark, published[0], "weekly-revenue")


def test_readiness_without_runs_is_degraded(spark, tmp_path):
    row = reads.readiness(spark, str(tmp_path / "wh"), str(tmp_path / "rep")).first()
    assert row.status == "degraded" and row.artifacts_ready is False and row.run_id is None


def test_public_names_cover_all_marts():
    assert set(reads.PUBLIC_MARTS.values()) == set(marts.MART_NAMES)


def test_pages_of_a_large_mart_at_any_depth(spark, tmp_path):
    total = 1_000_000
    df = spark.range(total).select(
        F.concat(F.lit("C"), F.lpad((F.col("id") * 7919 % total).cast("string"), 7, "0")
                 ).alias("customer_id"),
        (F.col("id") * 7919 % total % 1000).cast("double").alias("gross_revenue")).repartition(9)
    reads.write_positions(df, "customer_revenue", str(tmp_path / "stored"))
    stored = spark.read.parquet(str(tmp_path / "stored"))
    for offset in (0, 499_990, 700_000, 999_980, total + 5):
        rows, size = reads.stored_page(stored, "customer_revenue", 50, offset)
        # Place p holds revenue 999 - p // 1000 and the p % 1000-th customer with it.
        want = [(float(999 - p // 1000), f"C{p % 1000 * 1000 + 999 - p // 1000:07d}")
                for p in range(offset, min(offset + 50, total))]
        assert [(r.gross_revenue, r.customer_id) for r in rows.collect()] == want
        assert size == total
