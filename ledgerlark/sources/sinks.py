"""Sinks: tables, CSV exports, staged releases and report tables.

Staged release
--------------
Every run writes all of its tables under ``<root>/runs/<run_id>/``.  Only when
every table is written does the run flip ``<root>/_CURRENT`` (a one-line
pointer) to its id.  Readers resolve the pointer first, so they see either the
previous complete release or the new one, never a mix.  This holds on object
stores without atomic directory renames, and a failed run leaves the current
release untouched.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.sources import fs
from ledgerlark.sources.files import CSV_OPTIONS

POINTER = "_CURRENT"
# Columns that tell where a row stands in a table written in its published order.
PLACES = ("_part", "_place")
# A run folder without publication is left alone while its lease lasts.
LEASE_HOURS = 24


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: Sequence[str] = (), count_rows: bool = False) -> int | None:
    """Write Parquet; with ``count_rows`` the row count is observed during the
    write itself instead of a second pass (P6).

    The observation sits in the writing (result) stage, where Spark merges the
    metrics of each partition once even when tasks are retried after an
    executor loss, so the count stays exact."""
    obs = None
    if count_rows:
        obs = Observation()
        df = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return int(obs.get["rows"]) if obs is not None else None


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV export with a header and doubled quotes, as common CSV readers expect.

    The export stays a directory of part files: funnelling a large mart into
    one file would put it through a single task.
    """
    opts = {k: v for k, v in CSV_OPTIONS.items() if k in ("header", "quote", "escape")}
    # Values are written as they are: no trimming; null is an empty cell, an empty
    # text a quoted one.
    opts |= {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    df.write.mode(mode).options(**opts).csv(path)


@dataclass(frozen=True)
class Release:
    """A folder of versioned runs plus a pointer to the published one."""

    spark: SparkSession
    root: str
    pointer: str = POINTER
    folder: str = "runs"

    def run_dir(self, run_id: str) -> str:
        return f"{self.root.rstrip('/')}/{self.folder}/{run_id}"

    def table_path(self, run_id: str, name: str) -> str:
        return f"{self.run_dir(run_id)}/{name}"

    def current_run(self) -> str | None:
        text = fs.read_text(self.spark, f"{self.root.rstrip('/')}/{self.pointer}")
        return text.strip() if text else None

    def current_path(self, name: str) -> str | None:
        run_id = self.current_run()
        return self.table_path(run_id, name) if run_id else None

    def _note(self, kind: str, run_id: str) -> str:
        return f"{self.root.rstrip('/')}/_{kind}-{self.folder}/{run_id}"

    def publish(self, run_id: str) -> None:
        """Make ``run_id`` the visible release in one pointer write; its time is recorded
        before, so that every published run has one."""
        fs.write_text_atomic(self.spark, self._note("published", run_id), iso_micros(utc_now()))
        fs.write_text_atomic(self.spark, f"{self.root.rstrip('/')}/{self.pointer}", run_id + "\n")

    def lease(self, run_id: str, hours: float = LEASE_HOURS) -> None:
        """Keep ``prune`` from the folder of a running job; taken anew, it lasts anew."""
        until = utc_now() + timedelta(hours=hours)
        fs.write_text_atomic(self.spark, self._note("leases", run_id), iso_micros(until))

    def end_lease(self, run_id: str) -> None:
        fs.delete(self.spark, self._note("leases", run_id))

    def prune(self, keep: int = 2) -> list[str]:
        """Delete all but the ``keep`` runs published last, by their recorded times, whatever
        their names.  The visible run always stays; runs never published go unless their
        lease lasts.  Returns the removed run ids."""
        runs = fs.list_dirs(self.spark, f"{self.root.rstrip('/')}/{self.folder}")
        times = {r: fs.read_text(self.spark, self._note("published", r)) for r in runs}
        now = iso_micros(utc_now())
        held = {r for r in runs if (fs.read_text(self.spark, self._note("leases", r)) or "") > now}
        by_time = sorted((r for r in runs if times[r]), key=lambda r: (times[r], r))
        kept = {*by_time[len(by_time) - max(keep, 0):], self.current_run(), *held}
        removed = [r for r in runs if r not in kept]
        for run_id in removed:
            fs.delete(self.spark, self.run_dir(run_id))
            for kind in ("published", "leases"):
                fs.delete(self.spark, self._note(kind, run_id))
        return removed

    def read(self, name: str) -> DataFrame:
        path = self.current_path(name)
        if path is None:
            raise FileNotFoundError(f"no published release under {self.root}")
        return self.spark.read.parquet(path).drop(*PLACES)

    def read_placed(self, name: str) -> DataFrame:
        """A table written in its published order, with the places of its rows."""
        path = self.current_path(name)
        if path is None:
            raise FileNotFoundError(f"no published release under {self.root}")
        return self.spark.read.parquet(path)


# ------------------------------------------------------------ report tables
QUALITY_RESULTS_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("generated_at", T.StringType(), False),
    T.StructField("check_no", T.IntegerType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("passed", T.BooleanType(), False),
    T.StructField("severity", T.StringType(), False),
    T.StructField("failed_rows", T.LongType(), False),
    T.StructField("details", T.StringType(), True),
    T.StructField("run_date", T.StringType(), False),
])

PIPELINE_RUNS_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("started_at", T.StringType(), False),
    T.StructField("finished_at", T.StringType(), False),
    T.StructField("duration_seconds", T.DoubleType(), False),
    T.StructField("failed_stage", T.StringType(), True),
    T.StructField("raw_rows", T.MapType(T.StringType(), T.LongType()), False),
    T.StructField("total_checks", T.IntegerType(), False),
    T.StructField("passed_checks", T.IntegerType(), False),
    T.StructField("failed_checks", T.IntegerType(), False),
    T.StructField("marts", T.MapType(T.StringType(), T.StructType([
        T.StructField("rows", T.LongType(), False),
        T.StructField("columns", T.ArrayType(T.StringType()), False),
    ])), False),
    T.StructField("outputs", T.MapType(T.StringType(), T.StringType()), False),
    T.StructField("error_type", T.StringType(), True),
    T.StructField("error_message", T.StringType(), True),
    T.StructField("run_date", T.StringType(), False),
])

PREPARATION_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("generated_at", T.StringType(), False),
    T.StructField("source", T.StringType(), True),
    T.StructField("rows_requested", T.StringType(), False),
    T.StructField("dataset_scope", T.StringType(), False),
    T.StructField("source_rows", T.LongType(), False),
    T.StructField("normalized_rows", T.LongType(), False),
    T.StructField("dropped_rows", T.LongType(), False),
    T.StructField("drop_reasons_before_overlap", T.MapType(T.StringType(), T.LongType()), False),
    T.StructField("output_rows", T.MapType(T.StringType(), T.LongType()), False),
    T.StructField("outputs", T.MapType(T.StringType(), T.StringType()), False),
    T.StructField("attribution", T.MapType(T.StringType(), T.StringType()), False),
    T.StructField("run_date", T.StringType(), False),
])


def report_paths(reports_root: str) -> dict[str, str]:
    root = reports_root.rstrip("/")
    return {name: f"{root}/{name}"
            for name in ("quality_results", "pipeline_runs", "invalid_values",
                         "preparation_reports")}


def append_quality_results(spark: SparkSession, reports_root: str, run_id: str,
                           generated_at: str, checks: Sequence) -> str:
    """Append one row per check (S7); details travel as JSON text."""
    run_date = generated_at[:10]
    rows = [
        (run_id, generated_at, c.check_no, c.name, c.passed, c.severity, c.failed_rows,
         json.dumps(c.details, ensure_ascii=False, sort_keys=True), run_date)
        for c in checks
    ]
    path = report_paths(reports_root)["quality_results"]
    spark.createDataFrame(rows, QUALITY_RESULTS_SCHEMA).coalesce(1).write.mode("append") \
        .partitionBy("run_date").parquet(path)
    return path


def append_run_summary(spark: SparkSession, reports_root: str, summary: Mapping) -> str:
    """Append one row per run."""
    row = dict(summary)
    row["run_date"] = row["started_at"][:10]
    path = report_paths(reports_root)["pipeline_runs"]
    values = [tuple(row[f.name] for f in PIPELINE_RUNS_SCHEMA.fields)]
    spark.createDataFrame(values, PIPELINE_RUNS_SCHEMA).coalesce(1).write.mode("append") \
        .partitionBy("run_date").parquet(path)
    return path


def append_preparation_report(spark: SparkSession, reports_root: str, report: Mapping) -> str:
    """Append one row per preparation."""
    row = {**report, "rows_requested": str(report["rows_requested"]),
           "run_date": report["generated_at"][:10]}
    path = report_paths(reports_root)["preparation_reports"]
    values = [tuple(row[f.name] for f in PREPARATION_SCHEMA.fields)]
    spark.createDataFrame(values, PREPARATION_SCHEMA).coalesce(1).write.mode("append") \
        .partitionBy("run_date").parquet(path)
    return path


def utc_now() -> datetime:
    return datetime.now(UTC)


def iso_millis(value: datetime) -> str:
    """UTC time with three decimals and a final Z (fixed format)."""
    utc = value.astimezone(UTC)
    return f"{utc:%Y-%m-%dT%H:%M:%S}.{utc.microsecond // 1000:03d}Z"


def iso_micros(value: datetime) -> str:
    """UTC time with six decimals; texts sort as the times do."""
    return f"{value.astimezone(UTC):%Y-%m-%dT%H:%M:%S.%f}Z"


def new_run_id(value: datetime) -> str:
    """Compact UTC time with microseconds, so that ids sort by time (fixed format)."""
    utc = value.astimezone(UTC)
    return f"{utc:%Y%m%dT%H%M%S}{utc.microsecond:06d}Z"
