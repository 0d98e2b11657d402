"""Gated run end to end: success, idempotence, gate failure, warehouse failure."""

from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import quality, reads
from ledgerlark.plans import job
from ledgerlark.sources import sinks
from ledgerlark.sources.driver_tables import DriverTables
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def raw_tables(spark):
    return DriverTables(spark, SF_SMALL).raw_tables()


def test_successful_run_publishes_marts_and_reports(spark, raw_tables, tmp_path):
    out, rep = str(tmp_path / "wh"), str(tmp_path / "reports")
    summary = job.run_pipeline(spark, raw_tables, out, rep)
    assert summary["status"] == "success" and summary["failed_stage"] is None
    assert summary["total_checks"] == summary["passed_checks"] == 25
    assert summary["started_at"].endswith("Z") and summary["finished_at"].endswith("Z")
    assert set(summary["marts"]) == {"daily_revenue", "customer_revenue", "product_revenue",
                                     "country_revenue"}
    assert summary["marts"]["product_revenue"]["rows"] == 25
    release = sinks.Release(spark, out)
    assert release.current_run() == summary["run_id"]
    assert release.read("marts/daily_revenue").count() == summary["marts"]["daily_revenue"]["rows"]
    assert summary["raw_rows"]["order_items"] == raw_tables["order_items"].count()
    last = reads.latest_run(spark, rep).first()
    assert last.run_id == summary["run_id"] and last.status == "success"
    assert reads.latest_quality(spark, rep).count() == 25
    ready = reads.readiness(spark, out, rep).first()
    assert ready.status == "ok" and ready.artifacts_ready


@pytest.mark.parametrize("copies", [1, 2])
def test_date_layouts_of_the_rules_reach_the_fact(spark, raw_tables, tmp_path, copies):
    """Also with an order twice, where the rollup is built from the fact."""
    layout = F.date_format(F.col("order_date").cast("date"), "dd/MM/yyyy")
    orders = raw_tables["orders"].withColumn("order_date", layout)
    first = orders.orderBy("order_id").limit(copies - 1)
    raw = {**raw_tables, "orders": orders.union(first)}
    rules = replace(quality.DEFAULT_RULES, unique=(("customers", "customer_id"),),
                    date_formats=("dd/MM/yyyy", "yyyy-MM-dd"))
    summary = job.run_pipeline(spark, raw, str(tmp_path / "wh"), str(tmp_path / "rep"), rules=rules)
    fact = spark.read.parquet(summary["outputs"]["fact_order_items"])
    days = raw_tables["orders"].select("order_id", F.col("order_date").cast("date").alias("day"))
    assert fact.join(days, "order_id").where("order_date <> day").count() == 0
    assert fact.count() >= raw_tables["order_items"].count()
    assert dict(fact.dtypes)["order_date"] == "date"


def test_runs_are_idempotent(spark, raw_tables, tmp_path):
    out, rep = str(tmp_path / "wh"), str(tmp_path / "reports")
    first = job.run_pipeline(spark, raw_tables, out, rep)
    second = job.run_pipeline(spark, raw_tables, out, rep)
    assert first["run_id"] != second["run_id"]
    assert first["marts"] == second["marts"] and first["raw_rows"] == second["raw_rows"]
    daily = [sinks.Release(spark, out).table_path(r["run_id"], "marts/daily_revenue")
             for r in (first, second)]
    a, b = (sorted(tuple(x) for x in spark.read.parquet(p).collect()) for p in daily)
    assert a == b


def test_gate_failure_keeps_release_and_persists_report(spark, raw_tables, tmp_path):
    out, rep = str(tmp_path / "wh"), str(tmp_path / "reports")
    good = job.run_pipeline(spark, raw_tables, out, rep)
    broken = dict(raw_tables)
    broken["orders"] = raw_tables["orders"].drop("status")
    with pytest.raises(quality.QualityGateError):
        job.run_pipeline(spark, broken, out, rep)
    assert sinks.Release(spark, out).current_run() == good["run_id"]
    last = reads.latest_run(spark, rep).first()
    assert (last.status, last.failed_stage, last.error_type) == (
        "failed", "quality", "QualityGateError")
    assert last.failed_checks == 1 and last.raw_rows["orders"] > 0
    checks = reads.latest_quality(spark, rep).where(~F.col("passed")).collect()
    assert [c.name for c in checks] == ["orders.required_columns"]
    rollup = reads.latest_report(spark, rep).first()
    assert rollup.status == "failed" and rollup.critical_failures == ["orders.required_columns"]
    assert reads.readiness(spark, out, rep).first().status == "degraded"


def test_warehouse_failure_is_recorded(spark, raw_tables, tmp_path, monkeypatch):
    out, rep = str(tmp_path / "wh"), str(tmp_path / "reports")

    def boom(*args, **kwargs):
        raise RuntimeError("warehouse exploded")

    monkeypatch.setattr(job, "run_warehouse_stage", boom)
    with pytest.raises(RuntimeError, match="warehouse exploded"):
        job.run_pipeline(spark, raw_tables, out, rep)
    last = reads.latest_run(spark, rep).first()
    assert (last.status, last.failed_stage, last.error_type) == (
        "failed", "warehouse", "RuntimeError")
    assert last.total_checks == 25
    assert sinks.Release(spark, out).current_run() is None


def test_typed_load_failure_has_empty_counts(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "customers.csv").write_text("customer_id,country,segment,first_invoice_date\n"
                                       "1,X,export,2020-01-01\n")
    (raw / "orders.csv").write_text("order_id,customer_id,order_date,status\n1,1,2020-01-01,paid\n")
    (raw / "order_items.csv").write_text("order_id,product_id,description,quantity,unit_price\n"
                                         "1,P,d,x,1.0\n")
    with pytest.raises(Exception, match="declared types"):
        job.run_pipeline(spark, str(raw), str(tmp_path / "wh"), str(tmp_path / "rep"),
                         raw_format="csv")
    last = reads.latest_run(spark, str(tmp_path / "rep")).first()
    assert last.failed_stage == "quality" and last.raw_rows == {} and last.total_checks == 0


def test_failed_gate_discards_work_built_ahead(spark, raw_tables, tmp_path):
    import os

    out, rep = str(tmp_path / "wh"), str(tmp_path / "reports")
    good = job.run_pipeline(spark, raw_tables, out, rep)
    dirty = DriverTables(spark, SF_SMALL).dirty_tables()  # all columns present
    with pytest.raises(quality.QualityGateError):
        job.run_pipeline(spark, dirty, out, rep, run_id="dirty-run", overlap=True)
    release = sinks.Release(spark, out)
    assert release.current_run() == good["run_id"]
    assert not os.path.exists(release.run_dir("dirty-run"))
    assert not os.path.exists(job._rollup_path(spark, "dirty-run").rsplit("/", 1)[0])
    assert release.read("marts/daily_revenue").count() == good["marts"]["daily_revenue"]["rows"]


def test_overlap_and_sequential_runs_agree(spark, raw_tables, tmp_path):
    marts_of = {}
    for overlap in (True, False):
        out = str(tmp_path / f"wh-{overlap}")
        summary = job.run_pipeline(spark, raw_tables, out, str(tmp_path / f"rep-{overlap}"),
                                   overlap=overlap)
        release = sinks.Release(spark, out)
        marts_of[overlap] = {m: sorted(tuple(r) for r in release.read(f"marts/{m}").collect())
                             for m in summary["marts"]}
    assert marts_of[True] == marts_of[False]


def test_csv_options_reach_the_staged_load(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "customers.csv").write_text("customer_id,country,segment,first_invoice_date\n"
                                       "1,Chile,export,2020-01-01\n")
    (raw / "orders.csv").write_text("order_id,customer_id,order_date,status\n9,1,2020-01-01,paid\n")
    (raw / "order_items.csv").write_text("order_id,product_id,description,quantity,unit_price\n"
                                         '9,P,"two\nlines",2,1.25\n')
    out = str(tmp_path / "wh")
    job.run_pipeline(spark, str(raw), out, str(tmp_path / "rep"), raw_format="csv",
                     csv_options={"multiLine": "true"})
    fact = sinks.Release(spark, out).read("fact_order_items").first()
    assert (fact.description, fact.line_value) == ("two\nlines", 2.5)


def test_a_staged_run_is_resumed_in_another_session(spark, raw_tables, tmp_path, monkeypatch):
    out, rep = str(tmp_path / "wh"), str(tmp_path / "reports")
    release = sinks.Release(spark, out)
    job.run_quality_stage(spark, raw_tables, rep, "run-1", "2026-01-01T00:00:00.000Z", release=release)
    assert release.current_run() is None
    other = spark.newSession()
    monkeypatch.setattr(job, "build_base", lambda *a, **k: (_ for _ in ()).throw(OSError("disk gone")))
    with pytest.raises(OSError):
        job.resume_run(other, out, rep, "run-1")
    last = reads.latest_run(spark, rep).first()
    assert (last.status, last.failed_stage, last.total_checks) == ("failed", "warehouse", 25)
    monkeypatch.undo()
    summary = job.resume_run(other, out, rep, "run-1")  # the staged tables are still there
    whole = job.run_pipeline(spark, raw_tables, str(tmp_path / "wh2"), str(tmp_path / "rep2"))
    assert (summary["marts"], summary["raw_rows"]) == (whole["marts"], whole["raw_rows"])
    assert release.current_run() == "run-1"
    with pytest.raises(ValueError):
        job.resume_run(other, out, rep, "run-1")
    with pytest.raises(FileNotFoundError):
        job.resume_run(other, out, rep, "run-2")


def test_marts_are_written_once_in_order(spark, raw_tables, tmp_path):
    import os

    out = str(tmp_path / "wh")
    summary = job.run_pipeline(spark, raw_tables, out, str(tmp_path / "rep"))
    release = sinks.Release(spark, out)
    folders = set(os.listdir(release.run_dir(summary["run_id"])))
    assert folders == {"raw_customers", "raw_orders", "raw_order_items", "fact_order_items", "marts",
                       "_manifest.json", "._manifest.json.crc"} & folders
    placed = release.read_placed("marts/customer_revenue").orderBy(*sinks.PLACES).collect()
    keys = [(-r.gross_revenue, r.customer_id) for r in placed]
    assert keys == sorted(keys) and len(keys) == summary["marts"]["customer_revenue"]["rows"]
    assert "_place" not in release.read("marts/customer_revenue").columns
