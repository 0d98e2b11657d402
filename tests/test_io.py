"""Typed raw CSV scans, CSV quoting, staged release and report tables."""

from __future__ import annotations

import pytest

from ledgerlark.sources import files, sinks


def _write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


@pytest.fixture
def raw_csv(tmp_path):
    raw = tmp_path / "raw"
    _write(raw / "customers.csv",
           "customer_id,country,segment,first_invoice_date\n12345,United Kingdom,domestic,2010-12-01\n")
    _write(raw / "orders.csv",
           "order_id,customer_id,order_date,status\n10001,12345,2010-12-01,paid\n")
    # Columns deliberately out of the declared order: binding is by name.
    _write(raw / "order_items.csv",
           "unit_price,order_id,product_id,description,quantity\n"
           '0.001,10001,P1,"Mug, ""large""",2\n')
    return raw


def test_typed_load_keeps_ids_as_text_and_binds_by_name(spark, raw_csv):
    loaded = files.load_raw_tables(spark, str(raw_csv), fmt="csv")
    loaded.verify()
    item = loaded.frames["order_items"].first()
    assert item.order_id == "10001" and isinstance(item.order_id, str)
    assert item.description == 'Mug, "large"'
    assert item.quantity == 2 and item.unit_price == pytest.approx(0.001)
    assert dict(loaded.frames["order_items"].dtypes)["quantity"] == "bigint"
    assert loaded.frames["customers"].first().customer_id == "12345"


def test_non_whole_quantity_is_a_typed_load_error(spark, raw_csv):
    _write(raw_csv / "order_items.csv",
           "order_id,product_id,description,quantity,unit_price\n10001,P1,Mug,1.5,1.0\n")
    loaded = files.load_raw_tables(spark, str(raw_csv), fmt="csv")
    with pytest.raises(files.RawTypeError) as err:
        loaded.verify()
    assert err.value.violations == {"order_items.quantity": 1}


def test_missing_tokens_become_null(spark, raw_csv):
    _write(raw_csv / "orders.csv",
           "order_id,customer_id,order_date,status\n10001,NA,2010-12-01,null\n")
    row = files.load_raw_tables(spark, str(raw_csv), fmt="csv").frames["orders"].first()
    assert row.customer_id is None and row.status is None


def test_csv_export_round_trips_quotes(spark, tmp_path):
    df = spark.createDataFrame([("a,b", 'say "hi"')], "x string, y string")
    sinks.write_csv(df, str(tmp_path / "out.csv"))
    back = files.read_csv_text(spark, str(tmp_path / "out.csv")).first()
    assert (back.x, back.y) == ("a,b", 'say "hi"')


def test_release_pointer_switches_atomically(spark, tmp_path):
    release = sinks.Release(spark, str(tmp_path / "wh"))
    assert release.current_run() is None
    for run_id, n in (("r1", 3), ("r2", 5)):
        sinks.write_table(spark.range(n), release.table_path(run_id, "t"))
        assert release.current_run() != run_id  # written but not yet visible
        release.publish(run_id)
        assert release.read("t").count() == n
    assert release.current_run() == "r2"


def test_write_table_observes_rows(spark, tmp_path):
    assert sinks.write_table(spark.range(7), str(tmp_path / "t"), count_rows=True) == 7


def test_source_row_cap(spark, tmp_path):
    _write(tmp_path / "feed.csv", "InvoiceNo,x\n3,a\n1,b\n2,c\n")
    capped = files.read_source(spark, str(tmp_path / "feed.csv"), max_rows=2,
                               order_by=["InvoiceNo"])
    assert [r.InvoiceNo for r in capped.collect()] == ["1", "2"]
    assert files.read_source(spark, str(tmp_path / "feed.csv")).count() == 3
    with pytest.raises(ValueError):
        files.read_source(spark, str(tmp_path / "feed.csv"), max_rows=-1)


def test_register_views_exposes_sql(spark, raw_csv):
    loaded = files.load_raw_tables(spark, str(raw_csv), fmt="csv")
    names = files.register_views(loaded.frames)
    assert names == ["raw_customers", "raw_orders", "raw_order_items"]
    assert spark.sql("SELECT count(*) AS n FROM raw_order_items").first().n == 1


def test_page_records_keep_nulls_and_drop_nan(spark):
    from ledgerlark.operators import reads

    df = spark.createDataFrame([("a", None, float("nan")), ("b", 1.5, 2.0)],
                               "k string, x double, y double")
    items = [r.item for r in reads.page_records(df).collect()]
    assert items == ['{"k":"a","x":null,"y":null}', '{"k":"b","x":1.5,"y":2.0}']


def _runs(spark, root, *run_ids):
    release = sinks.Release(spark, str(root / "wh"))
    for run_id in run_ids:
        sinks.write_table(spark.range(1), release.table_path(run_id, "t"))
    return release


def test_prune_goes_by_the_time_of_publication(spark, tmp_path):
    release = _runs(spark, tmp_path, "r1", "r2", "r3", "r4")
    for run_id in ("r4", "r2", "r1", "r3"):  # the older name r1 is published later than r4
        release.publish(run_id)
    assert release.prune(keep=2) == ["r2", "r4"]
    assert release.prune(keep=2) == []
    assert release.read("t").count() == 1
    release.publish("r1")  # the visible run stays, however few are kept
    assert release.prune(keep=0) == ["r3"]
    assert (tmp_path / "wh" / "runs" / "r1").exists()


def test_prune_leaves_running_jobs_alone(spark, tmp_path):
    release = _runs(spark, tmp_path, "done", "failed", "lapsed", "running")
    release.publish("done")
    release.lease("running")
    release.lease("lapsed", hours=-1)
    assert release.prune(keep=1) == ["failed", "lapsed"]
    assert (tmp_path / "wh" / "runs" / "running").exists()
    release.end_lease("running")
    assert release.prune(keep=1) == ["running"]


def test_feed_scan_maps_missing_tokens(spark, tmp_path):
    _write(tmp_path / "feed.csv", "InvoiceNo,CustomerID,Country\n1,NA,France\n2, NA ,null\n")
    rows = files.read_source(spark, str(tmp_path / "feed.csv")).orderBy("InvoiceNo").collect()
    assert [(r.CustomerID, r.Country) for r in rows] == [(None, "France"), (" NA ", None)]


def test_csv_keeps_blanks_and_line_breaks(spark, tmp_path):
    rows = [("  a b ", 'say "x"', "1"), (" ", "two\nlines", "2"), (None, "", "3")]
    frame = spark.createDataFrame(rows, "a string, b string, c string")
    sinks.write_csv(frame, str(tmp_path / "out"))
    back = files.read_csv_text(spark, str(tmp_path / "out"), {"multiLine": "true"})
    assert sorted(map(tuple, back.collect()), key=lambda r: r[2]) == [
        rows[0], rows[1], (None, None, "3")] or sorted(
        map(tuple, back.collect()), key=lambda r: r[2]) == rows


@pytest.mark.parametrize("text", ["a,b\n1,2,3\n", "a,b\n1\n"])
def test_rows_of_another_width_fail(spark, tmp_path, text):
    (tmp_path / "in.csv").write_text(text)
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_csv_text(spark, str(tmp_path / "in.csv")).collect()


def test_swapped_headers_fail(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "2.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv_text(spark, str(tmp_path)).collect()


def test_whole_floats_pass_and_overflow_is_counted(spark):
    items = spark.createDataFrame(
        [("O", "P", "D", "2.0", "1"), ("O", "P", "D", "99999999999999999999", "1")],
        "order_id string, product_id string, description string, quantity string, unit_price string")
    raw = files.type_raw({"order_items": items})
    assert [r.quantity for r in raw.frames["order_items"].collect()] == [2, None]
    with pytest.raises(files.RawTypeError, match="order_items.quantity: 1 rows"):
        raw.verify()


def test_shared_dir_needs_a_setting_on_a_cluster():
    from ledgerlark.session import is_one_machine

    assert is_one_machine("local[4]") and not is_one_machine("local-cluster[2,1,1024]")


def test_feed_files_of_several_headers_are_bound_by_name(spark, tmp_path):
    feed = tmp_path / "feed"
    feed.mkdir()
    _write(feed / "a.csv", "InvoiceNo,Country,Extra\n1,Chile,x\n2,Peru,y\n")
    _write(feed / "b.csv", '"Country","InvoiceNo"\n"Cuba, West",3\nNA,4\n')
    _write(feed / "c.csv", "\ufeffInvoiceNo,Country,Extra\n5,Oman,z\n")
    (feed / "empty.csv").write_bytes(b"")
    import gzip

    (feed / "d.csv.gz").write_bytes(gzip.compress(b"Country,InvoiceNo\nFiji,6\n"))
    for path in (str(feed), f"{feed}/*.csv*"):
        got = files.read_source(spark, path)
        assert sorted(got.columns) == ["Country", "InvoiceNo"]
        assert sorted((r.InvoiceNo, r.Country) for r in got.collect()) == [
            ("1", "Chile"), ("2", "Peru"), ("3", "Cuba, West"), ("4", None), ("5", "Oman"),
            ("6", "Fiji")]
    assert files.read_source(spark, str(feed / "a.csv")).columns == ["InvoiceNo", "Country", "Extra"]
