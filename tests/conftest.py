from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
os.environ["PYTHONPATH"] = sys.path[0]  # for Python workers

from ledgerlark.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[4]", app_name="ledgerlark-tests", shuffle_partitions=4,
        extra_conf={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("OFF")
    yield session


@pytest.fixture
def valid_frames(spark):
    """One customer, one paid order, one line: passes all 25 checks."""
    return {
        "customers": spark.createDataFrame(
            [("C001", "Brazil", "export", "2026-01-01")],
            "customer_id string, country string, segment string, first_invoice_date string"),
        "orders": spark.createDataFrame(
            [("O1", "C001", "2026-01-01", "paid")],
            "order_id string, customer_id string, order_date string, status string"),
        "order_items": spark.createDataFrame(
            [("O1", "P1", "Course", 1, 10.0)],
            "order_id string, product_id string, description string, quantity bigint, "
            "unit_price double"),
    }


SOURCE_SCHEMA = ("InvoiceNo string, StockCode string, Description string, Quantity double, "
                 "InvoiceDate string, UnitPrice double, CustomerID string, Country string")

_TEA = ("tea", "Green tea", 4.0, "2012-03-05 10:00:00", 2.25, "77.0", "Chile")


def _but(order, **cells):
    """An order line for green tea that differs in some cells."""
    names = ("product", "description", "quantity", "date", "price", "customer", "country")
    return (order, *(cells.get(n, v) for n, v in zip(names, _TEA)))


# Four lines that are kept (two customers, three orders), one line for each reason to drop a
# line, and one with two reasons.
SOURCE_ROWS = [
    ("  A-1 ", *_TEA),
    _but("A-1", product=" cup ", quantity=-3.0, customer="77", price=1.5),
    _but("c-2", quantity=1.0, date="2012-04-01", customer=" 88.0", country="United Kingdom\u00a0"),
    _but("B-3", product="pot", quantity=6.0, date="2012-02-01 09:30:00", price=10.0, country="Peru"),
    _but(None), _but("D-1", product=""), _but("D-2", description="\t"), _but("D-3", customer=None),
    _but("D-4", country="   "), _but("D-5", date="2012-13-40 00:00:00"), _but("D-6", price=0.0),
    _but("D-7", quantity=0.0), _but("D-8", quantity=2.5, price=-1.0),
]


@pytest.fixture
def source_frame(spark):
    return spark.createDataFrame(SOURCE_ROWS, SOURCE_SCHEMA)
