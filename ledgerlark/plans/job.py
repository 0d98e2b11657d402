"""The gated batch run: quality -> warehouse -> publish.

Job layout (actions per run)
----------------------------
1. quality: one job for every check row (+ one bounded sample job only when
   checks failed); the report rows are appended *before* the gate can raise.  A run that
   passed leaves a manifest in its folder: schemas, counts, measured bytes, the proof of
   the gate and the date layouts, which is all that the warehouse stage starts from, in
   this session or another (``resume_run``);
2. warehouse: raw copies and the fact are written concurrently; the fact is
   read back from storage (lineage cut, an executor loss re-reads files
   instead of recomputing joins); the order rollup is written to the
   shared work folder (``spark.checkpoint.dir``) and read back; the four marts are written
   concurrently, each once, in its published order with every row's place, which serves
   readers and pages alike, and counted through an ``Observation`` during the write;
3. publish: one pointer write makes the run visible; a summary row is
   appended to ``pipeline_runs``.

A running job holds a lease on its run folder, so that ``Release.prune`` of another job
leaves it alone.

A failure at any stage appends a failure summary and re-raises the original
error; a failing report write never masks it.
"""

from __future__ import annotations

import json
import logging
from datetime import datetime
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import Future, ThreadPoolExecutor, wait
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.functions.columns import DEFAULT_DATE_FORMATS
from ledgerlark.operators import joins, money
from ledgerlark.operators import marts as mart_ops
from ledgerlark.operators.reads import write_positions
from ledgerlark.operators.quality import (
    CRITICAL,
    DEFAULT_RULES,
    CheckResult,
    QualityEngine,
    QualityGateError,
    QualityRules,
    tallies,
)
from ledgerlark.session import shared_dir
from ledgerlark.sources import files, fs, sinks
from ledgerlark.sources.sinks import Release, iso_millis, new_run_id, utc_now, write_csv

logger = logging.getLogger(__name__)

# A raw table whose measured size (see ``measured_bytes``) is at most this is
# broadcast into the warehouse joins.
MEASURED_BROADCAST_BYTES = 64 * 1024 * 1024

# Checks whose success proves each fact line maps to one order and one
# customer, which lets the marts count orders without a distinct step.
_KEY_CHECKS = (
    "customers.customer_id.unique",
    "orders.order_id.unique",
    "orders.customer_id.fk_customers.customer_id",
    "order_items.order_id.fk_orders.order_id",
)


@dataclass
class Validation:
    run_id: str
    started_at: str
    raw_rows: dict[str, int]
    checks: list[CheckResult]
    quality: dict[str, int]
    outputs: dict[str, str]
    tables: dict[str, DataFrame] = field(repr=False, default_factory=dict)
    # Measured bytes per staged table (empty when tables were not staged).
    raw_bytes: dict[str, int] = field(default_factory=dict)
    # Layouts in which the checked dates are written.
    date_formats: tuple[str, ...] = DEFAULT_DATE_FORMATS
    # Whether prices need the sum by limbs; None: not counted.
    wide_prices: bool | None = None
    # By key column ("orders.customer_id"), the rows of its largest key and of all keys.
    key_rows: dict[str, tuple[int, int]] = field(default_factory=dict)


@dataclass(frozen=True)
class Staged:
    """Typed raw tables of a run folder and what was observed while they were written."""

    tables: dict[str, DataFrame]
    rows: dict[str, int]
    bytes: dict[str, int]
    wide_prices: bool | None


@dataclass
class Warehouse:
    marts: dict[str, dict[str, Any]]
    outputs: dict[str, str]


@dataclass
class RunRecord:
    """One row of ``pipeline_runs`` in the making: each stage adds what it knows, and
    closing the record, with or without an error, gives the row (P3, P4)."""

    run_id: str
    started: datetime
    stage: str = "quality"
    raw_rows: dict[str, int] = field(default_factory=dict)
    tallies: dict[str, int] = field(
        default_factory=lambda: tallies(()))
    marts: dict[str, dict[str, Any]] = field(default_factory=dict)
    outputs: dict[str, str] = field(default_factory=dict)

    def checked(self, checks: list[CheckResult], raw_rows: Mapping[str, int],
                reports_root: str) -> None:
        self.raw_rows, self.tallies = dict(raw_rows), tallies(checks)
        self.outputs["quality_report"] = sinks.report_paths(reports_root)["quality_results"]

    def close(self, error: BaseException | None = None) -> dict[str, Any]:
        end = utc_now()
        return self.tallies | {
            "run_id": self.run_id,
            "status": "success" if error is None else "failed",
            "started_at": iso_millis(self.started),
            "finished_at": iso_millis(end),
            "duration_seconds": round((end - self.started).total_seconds(), 3),
            "failed_stage": None if error is None else self.stage,
            "raw_rows": self.raw_rows,
            "marts": self.marts,
            "outputs": dict(self.outputs),
            "error_type": None if error is None else type(error).__name__,
            "error_message": None if error is None else str(error),
        }


def stage_raw_tables(spark: SparkSession, raw: Mapping[str, DataFrame] | str, release: Release,
                     run_id: str, raw_format: str = "parquet",
                     csv_options: Mapping[str, str] | None = None,
                     ) -> Staged:
    """Type the raw tables once and write them as Parquet copies in the run
    folder (S2, S3).  Row counts, measured bytes and type violations are
    observed during the writes; later stages scan the columnar copies instead
    of re-parsing text."""
    # Text files are typed by name on the way in; frames handed over in memory
    # are copied as they are (their checks see the values as given).
    typing = isinstance(raw, str) and raw_format == "csv"
    text = (files.read_raw_text(spark, raw, raw_format, csv_options=csv_options)
            if isinstance(raw, str) else dict(raw))
    observations: dict[str, Observation] = {}
    prices: Observation | None = None
    tasks: dict[str, Callable[[], Any]] = {}
    paths: dict[str, str] = {}
    schemas: dict[str, T.StructType] = {}
    for name, frame in text.items():
        obs = Observation()
        observations[name] = obs
        counters = files.violation_counters(frame, name) if typing else []
        priced = name == "order_items" and dict(frame.dtypes).get("unit_price") in ("double", "float")
        if priced and not typing:
            counters.append(money.wide_prices().alias("wide"))
        # Measured during the same write: rows and the bytes of every value,
        # a size bound for the later join decisions (no estimate involved).
        observed = frame.observe(obs, F.count(F.lit(1)).alias("rows"),
                                 measured_bytes(frame).alias("bytes"), *counters)
        typed = observed.select(*files.typed_columns(observed, name)) if typing else observed
        if typing and name == "order_items" and dict(typed.dtypes).get("unit_price") in ("double", "float"):
            prices = Observation()
            typed = typed.observe(prices, money.wide_prices().alias("wide"))
        schemas[name] = typed.schema
        paths[name] = release.table_path(run_id, f"raw_{name}")
        tasks[name] = (lambda df=typed, p=paths[name]: sinks.write_table(df, p))
    _parallel(tasks)
    metrics = {name: obs.get for name, obs in observations.items()}
    if prices is not None:
        metrics["order_items"]["wide"] = prices.get["wide"]
    violations = {k: int(v) for m in metrics.values() for k, v in m.items()
                  if k not in ("rows", "bytes", "wide") and v}
    if violations:
        raise files.RawTypeError(violations)
    raw_rows = {name: int(m["rows"]) for name, m in metrics.items()}
    raw_bytes = {name: int(m["bytes"] or 0) for name, m in metrics.items()}
    staged = {name: spark.read.schema(schemas[name]).parquet(p) for name, p in paths.items()}
    wide = metrics.get("order_items", {}).get("wide")
    return Staged(staged, raw_rows, raw_bytes, None if wide is None else wide > 0)


def measured_bytes(frame: DataFrame) -> Column:
    """Bytes of all values: UTF-8 length of text, 8 per other value, plus a
    16-byte row header; an aggregate that rides along a write."""
    parts: list[Column] = [F.lit(16)]
    for field in frame.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(F.col(field.name)), F.lit(0)))
        else:
            parts.append(F.lit(8))
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return F.sum(total.cast("bigint"))


def load_unstaged(spark: SparkSession, raw: Mapping[str, DataFrame] | str,
                  raw_format: str = "parquet",
                  csv_options: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    """Raw tables used in place, without staged copies."""
    if isinstance(raw, str):
        loaded = files.load_raw_tables(spark, raw, raw_format, csv_options=csv_options)
        loaded.verify()
        return loaded.frames
    return dict(raw)


def check_and_report(spark: SparkSession, tables: Mapping[str, DataFrame], reports_root: str,
                     run_id: str, started_at: str, rules: QualityRules = DEFAULT_RULES,
                     staged: Staged | None = None) -> Validation:
    """Run every check, always persist the report rows, then gate."""
    engine = QualityEngine(tables, rules)
    work = f"{shared_dir(spark)}/ledgerlark/{run_id}/gate"
    try:
        checks = engine.run(work=work)
    finally:
        fs.delete(spark, work)
    domain_checks = {s.name for s in engine.specs if s.kind == "accepted_values"}
    rows = dict(staged.rows) if staged else {c.name.split(".")[0]: int(c.details.get("rows", 0))
                                    for c in checks if c.name.endswith(".not_empty")}
    path = sinks.append_quality_results(spark, reports_root, run_id, iso_millis(utc_now()), checks)
    validation = Validation(run_id, started_at, rows, checks, tallies(checks),
                            {"quality_report": path}, dict(tables),
                            dict(staged.bytes) if staged else {}, tuple(rules.date_formats),
                            staged.wide_prices if staged else None, engine.key_rows)
    gate = QualityGateError(checks, rows)
    if any(not c.passed and c.name in domain_checks for c in checks):
        whole = engine.invalid_domain_values().withColumns(
            {"run_id": F.lit(run_id), "run_date": F.lit(started_at[:10])})
        whole.write.mode("append").partitionBy("run_date").parquet(
            sinks.report_paths(reports_root)["invalid_values"])
    if gate.blocking:
        raise gate
    return validation


def run_quality_stage(spark: SparkSession, raw: Mapping[str, DataFrame] | str, reports_root: str,
                      run_id: str, started_at: str, rules: QualityRules = DEFAULT_RULES,
                      raw_format: str = "parquet", release: Release | None = None,
                      csv_options: Mapping[str, str] | None = None) -> Validation:
    """Load, check, always persist the report rows, then gate.

    With a ``release`` the typed raw tables are first staged in its run folder
    (see ``stage_raw_tables``) and a passed gate leaves the run's manifest there; without
    one the given frames are checked as they are."""
    if release is not None:
        staged = stage_raw_tables(spark, raw, release, run_id, raw_format, csv_options)
        validation = check_and_report(spark, staged.tables, reports_root, run_id, started_at, rules,
                                      staged)
        write_manifest(release, validation)
        return validation
    return check_and_report(spark, load_unstaged(spark, raw, raw_format, csv_options), reports_root,
                            run_id, started_at, rules)


MANIFEST = "_manifest.json"


def write_manifest(release: Release, validation: Validation) -> None:
    """What the warehouse stage has to know of a run whose gate passed."""
    v = validation
    text = json.dumps({
        "run_id": v.run_id, "started_at": v.started_at,
        "tables": {name: {"schema": frame.schema.jsonValue(), "rows": v.raw_rows[name],
                          "bytes": v.raw_bytes[name]} for name, frame in v.tables.items()},
        "wide_prices": v.wide_prices, "date_formats": list(v.date_formats), "outputs": v.outputs,
        "key_rows": v.key_rows,
        "checks": [[c.check_no, c.name, c.passed, c.severity, c.failed_rows] for c in v.checks],
    })
    fs.write_text_atomic(release.spark, release.table_path(v.run_id, MANIFEST), text)


def read_manifest(release: Release, run_id: str) -> Validation:
    """The validation of a staged run, with its tables as they were written."""
    text = fs.read_text(release.spark, release.table_path(run_id, MANIFEST))
    if text is None:
        raise FileNotFoundError(f"run {run_id} left no manifest: its gate did not pass here")
    m = json.loads(text)
    checks = [CheckResult(*row) for row in m["checks"]]
    tables = {name: release.spark.read.schema(T.StructType.fromJson(t["schema"])).parquet(
        release.table_path(run_id, f"raw_{name}")) for name, t in m["tables"].items()}
    return Validation(
        run_id, m["started_at"], {n: t["rows"] for n, t in m["tables"].items()}, checks,
        tallies(checks), m["outputs"], tables, {n: t["bytes"] for n, t in m["tables"].items()},
        tuple(m["date_formats"]), m["wide_prices"],
        {column: tuple(counts) for column, counts in m.get("key_rows", {}).items()})


def keys_proven_by(rules: QualityRules) -> bool:
    """Whether passing ``rules`` proves every fact line has exactly one order
    and one customer (unique keys, resolvable foreign keys, all critical)."""
    fks = {(fk.child_table, fk.child_column, fk.parent_table, fk.parent_column)
           for fk in rules.foreign_keys}
    return (rules.severity == CRITICAL
            and {("customers", "customer_id"), ("orders", "order_id")} <= set(rules.unique)
            and {("orders", "customer_id", "customers", "customer_id"),
                 ("order_items", "order_id", "orders", "order_id")} <= fks)


def _parallel(tasks: Mapping[str, Callable[[], Any]], workers: int = 4) -> dict[str, Any]:
    """Run independent Spark actions as concurrent jobs on the same session."""
    with ThreadPoolExecutor(max_workers=max(1, min(workers, len(tasks)))) as pool:
        futures = {name: pool.submit(task) for name, task in tasks.items()}
        return {name: f.result() for name, f in futures.items()}


@dataclass
class WarehouseBase:
    """Fact and order rollup written for one run (not yet published)."""

    fact_path: str
    rollup_path: str
    unique_orders: bool
    split: bool


def build_base(spark: SparkSession, tables: Mapping[str, DataFrame], raw_bytes: Mapping[str, int],
               release: Release, run_id: str, unique_orders: bool,
               broadcast_bytes: int = MEASURED_BROADCAST_BYTES,
               date_formats: Sequence[str] = DEFAULT_DATE_FORMATS,
               wide_prices: bool | None = None,
               key_rows: Mapping[str, tuple[int, int]] | None = None) -> WarehouseBase:
    """Write the fact (S4) and the order rollup for ``run_id``.  ``key_rows``: the counts of the
    gate; they tell without a scan where no key is hot.

    Dimensions whose *measured* size is small are broadcast; anything else (or
    anything unmeasured) is shuffled, with the rows of hot keys dealt out by a salt,
    and AQE may still convert it; without hot keys, the header side is hashed where its
    measured share of a partition is small.  With
    ``unique_orders`` and broadcast orders the rollup is built from items pre-aggregated per
    order, next to the fact.  A shuffled fact join has brought the lines of an order
    together, so the rollup is then read from the stored fact: its map-side sums leave one row
    an order, and the lines are not shuffled again."""
    t = tables
    split = mart_ops.has_wide_prices(t["order_items"]) if wide_prices is None else wide_prices
    fact_path = release.table_path(run_id, "fact_order_items")
    small = {name for name, size in raw_bytes.items()
             if name in ("customers", "orders") and size <= broadcast_bytes}
    dims = {name: (F.broadcast(t[name]) if name in small else t[name])
            for name in ("customers", "orders")}
    # Which keys are hot matters only where a join shuffles.
    counted = key_rows or {}
    hot = {key: None if joins.none_hot(spark, counted.get(f"{many}.{key}")) else joins.hot_keys(t[many], key)
           for one, many, key in (("customers", "orders", "customer_id"),
                                  ("orders", "order_items", "order_id")) if one not in small}
    # Keys that the gate has proven unique, and none of them hot, make a bounded hash map.
    hashed = [one for one, key in (("customers", "customer_id"), ("orders", "order_id"))
              if unique_orders and one not in small and hot[key] is None
              and joins.fits_hash_map(spark, raw_bytes.get(one))]
    fact = mart_ops.fact_order_items(dims["customers"], dims["orders"], t["order_items"],
                                     date_formats, hot, hashed)
    # Intermediate, not published: lives in the cluster's shared work folder.
    rollup_path = _rollup_path(spark, run_id)
    if unique_orders and "orders" in small:
        rollup_df = mart_ops.order_rollup_from_raw(dims["customers"], dims["orders"],
                                                   t["order_items"], date_formats, split, hot)
        _parallel({"fact": lambda: sinks.write_table(fact, fact_path),
                   "rollup": lambda: sinks.write_table(rollup_df, rollup_path)})
    else:
        sinks.write_table(fact, fact_path)
        sinks.write_table(mart_ops.order_rollup(spark.read.parquet(fact_path), split), rollup_path)
    return WarehouseBase(fact_path, rollup_path, unique_orders, split)


def _rollup_path(spark: SparkSession, run_id: str) -> str:
    return f"{shared_dir(spark)}/ledgerlark/{run_id}/order_rollup"


def run_warehouse_stage(spark: SparkSession, validation: Validation, out_root: str,
                        export_csv: bool = False, copy_raw: bool = True,
                        broadcast_bytes: int = MEASURED_BROADCAST_BYTES,
                        base: WarehouseBase | None = None) -> Warehouse:
    """Build fact and marts into the run folder, then publish the run.

    The raw copies (S3) were staged by the quality stage when ``copy_raw``.  A
    ``base`` built ahead of the gate is used only when the gate proved what it
    assumed."""
    release = Release(spark, out_root)
    run_id = validation.run_id
    outputs: dict[str, str] = {}
    if copy_raw:
        for name in validation.tables:
            outputs[f"raw_{name}"] = release.table_path(run_id, f"raw_{name}")
    passed = {c.name for c in validation.checks if c.passed and c.severity == CRITICAL}
    unique_orders = all(name in passed for name in _KEY_CHECKS)
    if base is None or (base.unique_orders and not unique_orders):
        base = build_base(spark, validation.tables, validation.raw_bytes, release, run_id,
                          unique_orders, broadcast_bytes, validation.date_formats,
                          validation.wide_prices, validation.key_rows)
    outputs["fact_order_items"] = base.fact_path
    fact_stored = spark.read.parquet(base.fact_path)
    rollup = spark.read.parquet(base.rollup_path)

    def build(per_customer: DataFrame | None = None) -> dict[str, DataFrame]:
        return mart_ops.build_marts(fact_stored, unique_orders=base.unique_orders, rollup=rollup,
                                    ordered=False, split=base.split, per_customer=per_customer)

    def write_mart(name: str, frame: DataFrame) -> dict[str, Any]:
        path = release.table_path(run_id, f"marts/{name}")
        rows = write_positions(frame, name, path)
        if export_csv:
            ordered = spark.read.parquet(path).orderBy(*sinks.PLACES).drop(*sinks.PLACES)
            write_csv(ordered, release.table_path(run_id, f"export/{name}.csv"))
        return {"rows": int(rows), "columns": list(frame.columns), "path": path}

    work = base.rollup_path.rsplit("/", 1)[0]

    def write_customer_marts() -> dict[str, dict[str, Any]]:
        # One reduction by customer serves both.
        sinks.write_table(mart_ops.customer_rollup(rollup, base.unique_orders), f"{work}/customer_rollup")
        made = build(spark.read.parquet(f"{work}/customer_rollup"))
        return {n: write_mart(n, made[n]) for n in by_customer}

    by_customer = ("customer_revenue", "country_revenue")
    tasks = {name: (lambda n=name, f=frame: {n: write_mart(n, f)})
             for name, frame in build().items() if name not in by_customer}
    parts = _parallel({"by_customer": write_customer_marts, **tasks})
    written = {n: part[n] for n in mart_ops.MART_NAMES for part in parts.values() if n in part}
    for name, info in written.items():
        outputs[name] = info.pop("path")
    release.publish(run_id)
    fs.delete(spark, work)
    outputs["release"] = release.run_dir(run_id)
    return Warehouse(marts=written, outputs=outputs)


def run_pipeline(spark: SparkSession, raw: Mapping[str, DataFrame] | str, out_root: str,
                 reports_root: str, *, rules: QualityRules = DEFAULT_RULES,
                 raw_format: str = "parquet", export_csv: bool = False, copy_raw: bool = True,
                 overlap: bool = False, run_id: str | None = None,
                 keep_releases: int = 0,
                 csv_options: Mapping[str, str] | None = None) -> dict[str, Any]:
    """Gated run (P5).  Returns the success summary or re-raises the failure.

    ``overlap`` (off by default) writes the fact and rollup while the checks
    run; both depend only on the staged copies.  They become visible only
    through the release pointer after the gate passed, and a failed gate waits
    for them and deletes them with the unpublished run folder.  It is off by
    default because it builds on keys the gate has not yet proven: badly
    duplicated keys would start a fan-out join that the sequential order
    prevents.  On 8 local cores it saved little (the cores were saturated).

    With ``keep_releases`` above 0, all but the newest that many run folders are
    deleted after a successful run; by default every run stays.  ``csv_options``
    override the CSV reader's defaults (``{"multiLine": "true"}``)."""
    started = utc_now()
    record = RunRecord(run_id or new_run_id(started), started)
    run_id, started_at = record.run_id, iso_millis(started)
    release = Release(spark, out_root)
    if release.current_run() == run_id:
        raise ValueError(f"run {run_id} is published already")
    ahead: Future | None = None
    pool = ThreadPoolExecutor(max_workers=1)
    try:
        release.lease(run_id)
        if copy_raw:
            staged = stage_raw_tables(spark, raw, release, run_id, raw_format, csv_options)
            if overlap and keys_proven_by(rules) and _has_warehouse_inputs(staged.tables):
                ahead = pool.submit(build_base, spark, staged.tables, staged.bytes, release, run_id,
                                    True, date_formats=rules.date_formats,
                                    wide_prices=staged.wide_prices)
            validation = check_and_report(spark, staged.tables, reports_root, run_id, started_at,
                                          rules, staged)
            write_manifest(release, validation)
        else:
            validation = check_and_report(
                spark, load_unstaged(spark, raw, raw_format, csv_options), reports_root, run_id,
                started_at, rules)
        record.checked(validation.checks, validation.raw_rows, reports_root)
        base = ahead.result() if ahead is not None else None
        summary = _finish(spark, validation, record, out_root, reports_root, export_csv, copy_raw, base)
    except Exception as error:
        if isinstance(error, QualityGateError):
            logger.warning("run %s stopped by the quality gate: %s", run_id, error)
            record.checked(error.checks, error.raw_rows, reports_root)
        else:
            logger.exception("run %s failed in stage %s", run_id, record.stage)
        if ahead is not None:
            wait([ahead])  # its outcome is irrelevant once the run failed
        try:
            sinks.append_run_summary(spark, reports_root, record.close(error))
        except Exception:  # noqa: BLE001 - never mask the original error
            logger.exception("could not record the failure summary of run %s", run_id)
        if release.current_run() != run_id:
            # Unpublished output of a failed run; the release is intact.
            for folder in (release.run_dir(run_id), _rollup_path(spark, run_id).rsplit("/", 1)[0]):
                try:
                    fs.delete(spark, folder)
                except Exception:  # noqa: BLE001
                    logger.exception("could not remove %s of run %s", folder, run_id)
        raise
    finally:
        pool.shutdown(wait=True)
        release.end_lease(run_id)
    if keep_releases > 0:
        release.prune(keep_releases)  # the run is over: what fails here fails alone
    return summary


def _finish(spark: SparkSession, validation: Validation, record: RunRecord, out_root: str,
            reports_root: str, export_csv: bool, copy_raw: bool,
            base: WarehouseBase | None = None) -> dict[str, Any]:
    """Warehouse and publication of a run whose gate passed."""
    record.stage = "warehouse"
    warehouse = run_warehouse_stage(spark, validation, out_root, export_csv, copy_raw, base=base)
    record.marts = {name: {"rows": int(m["rows"]), "columns": list(m["columns"])}
                    for name, m in warehouse.marts.items()}
    record.outputs.update(warehouse.outputs)
    record.stage = "publish_summary"
    summary = record.close()
    summary["outputs"]["run_summary"] = sinks.append_run_summary(spark, reports_root, summary)
    return summary


def resume_run(spark: SparkSession, out_root: str, reports_root: str, run_id: str, *,
               export_csv: bool = False) -> dict[str, Any]:
    """The warehouse stage of a staged run, from its manifest alone (P2): in another
    session than its checks, or again after a failure there.  The staged tables stay where
    a failure leaves them, so that it can be tried again."""
    release = Release(spark, out_root)
    if release.current_run() == run_id:
        raise ValueError(f"run {run_id} is published already")
    validation = read_manifest(release, run_id)
    record = RunRecord(run_id, datetime.fromisoformat(validation.started_at))
    record.checked(validation.checks, validation.raw_rows, reports_root)
    release.lease(run_id)
    try:
        return _finish(spark, validation, record, out_root, reports_root, export_csv, True)
    except Exception as error:
        logger.exception("run %s failed in stage %s", run_id, record.stage)
        sinks.append_run_summary(spark, reports_root, record.close(error))
        raise
    finally:
        release.end_lease(run_id)


def _has_warehouse_inputs(tables: Mapping[str, DataFrame]) -> bool:
    need = {"customers": {"customer_id", "country", "segment"},
            "orders": {"order_id", "customer_id", "order_date", "status"},
            "order_items": {"order_id", "product_id", "description", "quantity", "unit_price"}}
    return all(name in tables and cols <= set(tables[name].columns) for name, cols in need.items())
