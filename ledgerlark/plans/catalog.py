"""Catalogue of runnable queries and their SQL twins.

Every entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole tables in ``sf_dir``.  ``ORACLE`` maps the same names to DuckDB SQL.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlark.functions.columns import finite
from ledgerlark.operators import marts, normalize, quality, reads
from ledgerlark.plans import job, prepare
from ledgerlark.plans import oracle_sql as sql
from ledgerlark.session import shared_dir
from ledgerlark.sources import files, sinks
from ledgerlark.sources.driver_tables import DriverTables

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def wrap(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return wrap


# --------------------------------------------------------------------- marts
def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = DriverTables(spark, sf_dir).raw_tables()
    return marts.fact_order_items(raw["customers"], raw["orders"], raw["order_items"])


@register("fact_order_items", sql.RAW + sql.FACT_SELECT)
def q_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact(spark, sf_dir)


@register("daily_revenue", sql.MART_SQL["daily_revenue"])
def q_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.daily_revenue(marts.order_rollup(_fact(spark, sf_dir)))


@register("customer_revenue", sql.MART_SQL["customer_revenue"])
def q_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.customer_revenue(marts.order_rollup(_fact(spark, sf_dir)))


@register("product_revenue_top25", sql.MART_SQL["product_revenue"])
def q_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.product_revenue(_fact(spark, sf_dir))


@register("country_revenue", sql.MART_SQL["country_revenue"])
def q_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.country_revenue(marts.order_rollup(_fact(spark, sf_dir)))


# ------------------------------------------------------------ normalisation
def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = DriverTables(spark, sf_dir)
    return normalize.parsed_lines(tables.retail_source(), home_country=tables.home_country)


def _finite_or_null(c: str):
    return F.when(finite(c), F.col(c))


@register("clean_text", sql.NORMALIZE_SQL["clean_text"])
def q_clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).select(*normalize.TEXT_COLUMNS)


@register("clean_numbers", sql.NORMALIZE_SQL["clean_numbers"])
def q_clean_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = DriverTables(spark, sf_dir)
    lines = normalize.parsed_lines(tables.retail_source(), tables.home_country,
                                   passthrough=[("Quantity", "quantity_text")])
    return lines.select(
        F.col("quantity_text"),
        _finite_or_null("quantity_value").alias("quantity_value"),
        _finite_or_null("unit_price").alias("unit_price"),
        "ok_quantity",
        "ok_unit_price",
    )


@register("clean_timestamps", sql.NORMALIZE_SQL["clean_timestamps"])
def q_clean_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = DriverTables(spark, sf_dir)
    lines = normalize.parsed_lines(tables.retail_source(), tables.home_country,
                                   passthrough=[("InvoiceDate", "order_date_text")])
    return lines.select("order_date_text", "order_ts", "order_date", "ok_order_date")


@register("valid_rows", sql.NORMALIZE_SQL["valid_rows"])
def q_valid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.clean_lines(_lines(spark, sf_dir))


@register("line_status_segment", sql.NORMALIZE_SQL["line_status_segment"])
def q_line_status_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_order = (
        normalize.clean_lines(_lines(spark, sf_dir))
        .groupBy("status", "segment", "order_id")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("q"))
    )
    return per_order.groupBy("status", "segment").agg(
        F.sum("n").alias("lines"),
        F.sum("q").cast("bigint").alias("units"),
        F.count("order_id").alias("orders"),
    )


@register("normalize_customers", sql.NORMALIZE_SQL["normalize_customers"])
def q_norm_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.customers_from(normalize.clean_lines(_lines(spark, sf_dir)))


@register("normalize_orders", sql.NORMALIZE_SQL["normalize_orders"])
def q_norm_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.orders_from(normalize.clean_lines(_lines(spark, sf_dir)))


@register("normalize_items", sql.NORMALIZE_SQL["normalize_items"])
def q_norm_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.items_from(normalize.clean_lines(_lines(spark, sf_dir)))


@register("drop_reasons", sql.NORMALIZE_SQL["drop_reasons"])
def q_drop_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.drop_reasons(_lines(spark, sf_dir))


@register("preparation_counts", sql.NORMALIZE_SQL["preparation_counts"])
def q_prep_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.preparation_counts(_lines(spark, sf_dir))


# ------------------------------------------------------------------ quality
_CHECK_COLUMNS = ("check_no", "name", "passed", "severity", "failed_rows")


def _engine(spark: SparkSession, sf_dir: str, dirty: bool = True) -> quality.QualityEngine:
    tables = DriverTables(spark, sf_dir)
    return quality.QualityEngine(tables.dirty_tables() if dirty else tables.raw_tables())


def _checks(kinds: set[str], dirty: bool = True) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        engine = _engine(spark, sf_dir, dirty)
        engine.specs = [s for s in engine.specs if s.kind in kinds]
        return engine.results().select(*_CHECK_COLUMNS)

    return run


_KIND_QUERIES = {
    "structural_checks": {"table_present", "required_columns", "not_empty"},
    "check_table_present": {"table_present"},
    "check_required_columns": {"required_columns"},
    "check_not_empty": {"not_empty"},
    "check_not_null": {"not_null"},
    "check_not_blank": {"not_blank"},
    "check_unique": {"unique"},
    "check_accepted_values": {"accepted_values"},
    "check_positive_finite": {"positive_finite"},
    "check_parseable_date": {"parseable_date"},
    "check_foreign_keys": {"foreign_key"},
}
for _name, _kinds in _KIND_QUERIES.items():
    register(_name, sql.quality_sql(quality.DEFAULT_RULES, _kinds))(_checks(_kinds))

_ALL_KINDS = set().union(*_KIND_QUERIES.values())
register("quality_checks", sql.quality_sql(quality.DEFAULT_RULES))(_checks(_ALL_KINDS))
register("quality_checks_clean", sql.quality_sql(quality.DEFAULT_RULES, dirty=False))(
    _checks(_ALL_KINDS, dirty=False))


@register("quality_report", sql.report_sql(quality.DEFAULT_RULES))
def q_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report_frame(_engine(spark, sf_dir).results())


def _samples(kinds: set[str]) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        engine = _engine(spark, sf_dir)
        names = [s.name for s in engine.specs if s.kind in kinds]
        return engine.samples(names)

    return run


_BAD_VALUE_KINDS = {"accepted_values", "positive_finite", "parseable_date"}
register("bad_value_samples", sql.sample_sql(quality.DEFAULT_RULES, _BAD_VALUE_KINDS))(
    _samples(_BAD_VALUE_KINDS))
register("missing_key_samples", sql.sample_sql(quality.DEFAULT_RULES, {"foreign_key"}))(
    _samples({"foreign_key"}))


@register("table_row_counts", sql.row_counts_sql())
def q_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _engine(spark, sf_dir).row_counts()


# ------------------------------------------------------ sources, sinks, job
SOURCE_CAP = 1000
PAGE_OFFSET, PAGE_LIMIT = 100, 50


def _scratch(spark: SparkSession, tag: str) -> str:
    """A fresh folder under the session's shared work folder."""
    return f"{shared_dir(spark)}/ledgerlark-queries/{tag}-{uuid.uuid4().hex}"


@register("source_capped_scan", sql.source_cap_sql(SOURCE_CAP))
def q_source_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = DriverTables(spark, sf_dir).retail_source()
    return files.cap_rows(source, SOURCE_CAP, order_by=normalize.SOURCE_COLUMNS)


def _relation_marts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return marts.build_marts(_fact(spark, sf_dir))


@register("mart_summaries", sql.mart_summaries_sql())
def q_mart_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = None
    for name, frame in _relation_marts(spark, sf_dir).items():
        part = frame.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("mart"), "rows",
            F.lit(",".join(frame.columns)).alias("columns"))
        out = part if out is None else out.unionByName(part)
    return out


@register("mart_page", sql.page_sql("daily_revenue", PAGE_LIMIT, PAGE_OFFSET))
def q_mart_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = marts.daily_revenue(marts.order_rollup(_fact(spark, sf_dir)), ordered=False)
    return reads.page(daily, "daily_revenue", PAGE_LIMIT, PAGE_OFFSET)


@register("mart_page_deep", sql.deep_page_sql("customer_revenue", PAGE_LIMIT))
def q_mart_page_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page that begins at two thirds of the mart, and the mart's size."""
    frame = marts.customer_revenue(marts.order_rollup(_fact(spark, sf_dir)), ordered=False)
    path = _scratch(spark, "deep-page")
    reads.write_positions(frame.repartition(8), "customer_revenue", path)
    stored = spark.read.parquet(path)
    rows, total = reads.stored_page(stored, "customer_revenue", PAGE_LIMIT,
                                    2 * stored.count() // 3)
    return rows.withColumn("total", F.lit(total).cast("long"))


@register("invalid_domain_values", sql.invalid_domain_sql(quality.DEFAULT_RULES))
def q_invalid_domain_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _engine(spark, sf_dir).invalid_domain_values().drop("check_no")


@register("csv_round_trip_dirty", sql.DIRTY + "SELECT * FROM dirty_order_items")
def q_csv_round_trip_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty items through a CSV and back, every cell as text."""
    frame = DriverTables(spark, sf_dir).dirty_tables()["order_items"]
    path = _scratch(spark, "csv-dirty")
    sinks.write_csv(frame, path)
    return files.read_csv_text(spark, path, {"multiLine": "true"}).select(
        *(F.col(c).cast(t) for c, t in frame.dtypes))


@register("mart_page_customers", sql.page_sql("customer_revenue", PAGE_LIMIT, PAGE_OFFSET))
def q_mart_page_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = marts.customer_revenue(marts.order_rollup(_fact(spark, sf_dir)), ordered=False)
    return reads.page(frame, "customer_revenue", PAGE_LIMIT, PAGE_OFFSET)


@register("csv_round_trip", sql.RAW + "SELECT * FROM raw_order_items")
def q_csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _scratch(spark, "csv")
    raw = DriverTables(spark, sf_dir).raw_tables()
    job._parallel({n: (lambda n=n, df=df: sinks.write_csv(df, f"{root}/{files.RAW_FILES[n]}"))
                   for n, df in raw.items()})
    loaded = files.load_raw_tables(spark, root, fmt="csv")
    loaded.verify()
    return loaded.frames["order_items"]


@register("report_table_round_trip", sql.quality_sql(quality.DEFAULT_RULES))
def q_report_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _scratch(spark, "reports")
    checks = _engine(spark, sf_dir).run()
    path = sinks.append_quality_results(spark, root, "query", sinks.iso_millis(sinks.utc_now()),
                                        checks)
    return spark.read.parquet(path).select(*_CHECK_COLUMNS)


@register("staged_publish", sql.MART_SQL["daily_revenue"])
def q_staged_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    release = sinks.Release(spark, _scratch(spark, "release"))
    run_id = sinks.new_run_id(sinks.utc_now())
    frame = marts.daily_revenue(marts.order_rollup(_fact(spark, sf_dir)))
    sinks.write_table(frame, release.table_path(run_id, "marts/daily_revenue"))
    release.publish(run_id)
    return release.read("marts/daily_revenue")


@register("prepared_customers", sql.NORMALIZE_SQL["normalize_customers"])
def q_prepared_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = DriverTables(spark, sf_dir)
    out = _scratch(spark, "prepare")
    prepare.prepare_source(spark, tables.retail_source(), out, home_country=tables.home_country)
    return files.load_raw_tables(spark, out).frames["customers"]


@register("preparation_report", sql.NORMALIZE_SQL["preparation_counts"])
def q_preparation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored report of a preparation run, as (metric, value) rows."""
    tables = DriverTables(spark, sf_dir)
    out = _scratch(spark, "prepare-report")
    prepare.prepare_source(spark, tables.retail_source(), out, home_country=tables.home_country)
    stored = spark.read.parquet(sinks.report_paths(out)["preparation_reports"])
    counts = F.create_map(*(x for c in ("source_rows", "normalized_rows", "dropped_rows")
                            for x in (F.lit(c), F.col(c))))
    return stored.select(F.explode(F.map_concat(counts, "output_rows")).alias("metric", "value"))


def _gated(spark: SparkSession, sf_dir: str, dirty: bool) -> tuple[str, str]:
    root = _scratch(spark, "run")
    tables = DriverTables(spark, sf_dir)
    raw = tables.dirty_tables() if dirty else tables.raw_tables()
    try:
        job.run_pipeline(spark, raw, f"{root}/warehouse", f"{root}/reports")
    except quality.QualityGateError:
        if not dirty:
            raise
    return f"{root}/warehouse", f"{root}/reports"


_RUN_COLUMNS = ("status", "failed_stage", "total_checks", "passed_checks", "failed_checks")


@register("gated_run_summary", sql.run_summary_sql(dirty=False))
def q_gated_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, reports_root = _gated(spark, sf_dir, dirty=False)
    return reads.latest_run(spark, reports_root).select(
        *_RUN_COLUMNS,
        *[F.col("marts")[m]["rows"].alias(f"{m}_rows") for m in marts.MART_NAMES],
    )


@register("gated_run_failure", sql.run_summary_sql(dirty=True))
def q_gated_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, reports_root = _gated(spark, sf_dir, dirty=True)
    return reads.latest_run(spark, reports_root).select(*_RUN_COLUMNS)


@register("latest_run", sql.run_summary_sql(dirty=True))
def q_latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs into one report table (a clean one, then a failing one): the
    latest row must be the failure."""
    root = _scratch(spark, "runs")
    tables = DriverTables(spark, sf_dir)
    job.run_pipeline(spark, tables.raw_tables(), f"{root}/warehouse", f"{root}/reports")
    try:
        job.run_pipeline(spark, tables.dirty_tables(), f"{root}/warehouse", f"{root}/reports")
    except quality.QualityGateError:
        pass
    return reads.latest_run(spark, f"{root}/reports").select(*_RUN_COLUMNS)


@register("latest_quality", sql.quality_sql(quality.DEFAULT_RULES, dirty=False))
def q_latest_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, reports_root = _gated(spark, sf_dir, dirty=False)
    return reads.latest_quality(spark, reports_root).select(*_CHECK_COLUMNS)


@register("readiness", sql.readiness_sql(quality.DEFAULT_RULES))
def q_readiness(spark: SparkSession, sf_dir: str) -> DataFrame:
    out_root, reports_root = _gated(spark, sf_dir, dirty=False)
    return reads.readiness(spark, out_root, reports_root).select(
        "status", "pipeline_status", "artifacts_ready")


@register("published_mart_page", sql.page_sql("daily_revenue", PAGE_LIMIT, PAGE_OFFSET))
def q_published_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    out_root, _ = _gated(spark, sf_dir, dirty=False)
    return reads.read_mart_page(spark, out_root, "daily-revenue", PAGE_LIMIT, PAGE_OFFSET).rows


# ------------------------------------------------- feeds, views, reports, reruns
@register("feed_csv_scan", sql.feed_scan_sql(files.NA_TOKENS))
def q_feed_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed written as CSV files of two column orders and read by name."""
    feed = DriverTables(spark, sf_dir).retail_source()
    root = _scratch(spark, "feed")
    later = F.pmod(F.xxhash64("StockCode", "InvoiceDate"), F.lit(2)) == 1
    sinks.write_csv(feed.where(~later), f"{root}/first")
    sinks.write_csv(feed.where(later).select(*reversed(feed.columns)), f"{root}/later")
    return files.read_source(spark, f"{root}/*").select(*feed.columns)


@register("number_classes", sql.NUMBER_CLASSES)
def q_number_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by what the lenient parse makes of a number, infinite and NaN told apart."""
    pairs = _lines(spark, sf_dir).select(F.explode(F.array(
        F.struct(F.lit("quantity").alias("field"), F.col("quantity_value").alias("v")),
        F.struct(F.lit("unit_price").alias("field"), F.col("unit_price").alias("v")))).alias("x"))
    v = F.col("x.v")
    kind = (F.when(v.isNull(), "none").when(F.isnan(v), "nan").when(F.abs(v) == float("inf"), "infinite")
            .when(v < 0, "negative").when(v == 0, "zero").otherwise("positive"))
    return pairs.groupBy(F.col("x.field").alias("field"), kind.alias("kind")).agg(
        F.count(F.lit(1)).alias("rows"))


@register("sql_views", sql.RAW + sql.VIEW_QUERY)
def q_sql_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over the raw tables as registered views (S5), in a session of their own."""
    own = spark.newSession()
    files.register_views(DriverTables(own, sf_dir).raw_tables())
    return own.sql(sql.VIEW_QUERY)


@register("page_records", sql.records_sql())
def q_page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer mart as JSON records, taken apart again."""
    mart = marts.customer_revenue(marts.order_rollup(_fact(spark, sf_dir)), ordered=False)
    cell = {c: F.get_json_object("item", f"$.{c}")
            for c in ("customer_id", "gross_revenue", "last_paid_order_date")}
    return reads.page_records(mart).select(
        cell["customer_id"].alias("customer_id"),
        cell["gross_revenue"].cast("double").alias("gross_revenue"),
        cell["last_paid_order_date"].alias("last_paid"),
        F.col("item").contains('"last_paid_order_date":null').alias("null_kept"))


@register("ordered_export", sql.EXPORTS)
def q_ordered_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each prepared CSV that stand behind a greater key (O1): within a file by its
    lines, between files by their names."""
    tables = DriverTables(spark, sf_dir)
    out = _scratch(spark, "export")
    paths = prepare.prepare_source(spark, tables.retail_source(), out, fmt="csv",
                                   home_country=tables.home_country)["outputs"]
    parts = []
    for name, keys in prepare._SORT_KEYS.items():
        lines = files.read_csv_text(spark, paths[name]).select(
            F.struct(*keys).alias("key"), F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"))
        before = F.lag("key").over(Window.partitionBy("file").orderBy("block", "line"))
        by_file = lines.withColumn("late", before > F.col("key")).groupBy("file").agg(
            F.count(F.lit(1)).alias("rows"), F.count_if("late").alias("late"),
            F.min("key").alias("least"), F.max("key").alias("most"))
        # One row a file.
        ahead = F.lag("most").over(Window.partitionBy(F.lit(0)).orderBy("file"))
        parts.append(by_file.withColumn("overlap", ahead > F.col("least")).agg(
            F.sum("rows").alias("rows"),
            (F.sum("late") + F.count_if("overlap")).alias("misplaced")).select(
            F.lit(name).alias("table"), "rows", "misplaced"))
    return functools.reduce(DataFrame.unionByName, parts)


@register("rerun_counts", sql.rerun_sql())
def q_rerun_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each mart and the runs that gave them, over two runs of one input."""
    root = _scratch(spark, "rerun")
    raw = DriverTables(spark, sf_dir).raw_tables()
    for _ in range(2):
        job.run_pipeline(spark, raw, f"{root}/warehouse", f"{root}/reports")
    runs = spark.read.parquet(sinks.report_paths(f"{root}/reports")["pipeline_runs"])
    return runs.where("status = 'success'").select("run_id", F.explode("marts").alias("mart", "m")).groupBy(
        "mart", F.col("m.rows").alias("rows")).agg(F.count_distinct("run_id").alias("runs"))


def _gaps(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The dirty tables without customers, and orders without their status."""
    tables = DriverTables(spark, sf_dir).dirty_tables()
    return {"orders": tables["orders"].drop("status"), "order_items": tables["order_items"]}


@register("skipped_checks", sql.skipped_sql(quality.DEFAULT_RULES, "customers", "orders", "status"))
def q_skipped_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate over tables with gaps: gaps fail (Q1, Q2), what reads them is skipped."""
    return quality.QualityEngine(_gaps(spark, sf_dir)).results().select("name", "passed", "failed_rows")


@register("empty_table_checks", sql.empty_table_sql(quality.DEFAULT_RULES, "orders"))
def q_empty_table_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate where no order is left: not_empty fails (Q3), and each item is an orphan."""
    tables = DriverTables(spark, sf_dir).raw_tables()
    tables["orders"] = tables["orders"].where("order_id IS NULL")
    return quality.QualityEngine(tables).results().select("name", "passed", "failed_rows")


@register("check_details", sql.details_sql(quality.DEFAULT_RULES))
def q_check_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored details of the failed value and key checks."""
    root = _scratch(spark, "details")
    path = sinks.append_quality_results(spark, root, "query", sinks.iso_millis(sinks.utc_now()),
                                        _engine(spark, sf_dir).run())
    lists = [F.from_json(F.get_json_object("details", f"$.{k}"), "array<string>")
             for k in ("invalid_values", "missing_values")]
    return spark.read.parquet(path).withColumn("list", F.coalesce(*lists)).where("list IS NOT NULL").select(
        "name", F.get_json_object("details", "$.null_rows").cast("long").alias("null_rows"),
        F.size("list").cast("long").alias("n_values"), F.array_min("list").alias("first_value"),
        F.array_max("list").alias("last_value"))


@register("resumed_run_summary", sql.run_summary_sql(dirty=False))
def q_resumed_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks in one session, warehouse and publication in another, from the manifest."""
    root = _scratch(spark, "resumed")
    release = sinks.Release(spark, f"{root}/warehouse")
    run_id, now = sinks.new_run_id(sinks.utc_now()), sinks.iso_millis(sinks.utc_now())
    job.run_quality_stage(spark, DriverTables(spark, sf_dir).raw_tables(), f"{root}/reports", run_id,
                          now, release=release)
    other = spark.newSession()
    job.resume_run(other, f"{root}/warehouse", f"{root}/reports", run_id)
    return reads.latest_run(spark, f"{root}/reports").select(
        *_RUN_COLUMNS, *[F.col("marts")[m]["rows"].alias(f"{m}_rows") for m in marts.MART_NAMES])
