"""Reads over published marts and report tables.

Marts are published once, in their published order with each row's place.  A page of any
depth is a filter on stored places.  Latest-run lookups use ``max_by`` (one partial
aggregate), never a sort of the run history.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlark.operators.marts import MART_NAMES, sort_keys
from ledgerlark.sources import fs
from ledgerlark.sources.sinks import PLACES, Release, report_paths

DEFAULT_LIMIT = 100
MAX_LIMIT = 1000

# Public mart names and their table names.
PUBLIC_MARTS: dict[str, str] = {
    "daily-revenue": "daily_revenue",
    "customer-revenue": "customer_revenue",
    "product-revenue": "product_revenue",
    "country-revenue": "country_revenue",
}


@dataclass(frozen=True)
class MartPage:
    mart: str
    total: int
    limit: int
    offset: int
    rows: DataFrame


def check_bounds(limit: int, offset: int) -> None:
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be between 1 and {MAX_LIMIT}")
    if offset < 0:
        raise ValueError("offset must be zero or positive")


def write_positions(mart_df: DataFrame, mart: str, path: str) -> int:
    """Store a mart in its published order, each row with its place (O3, O5); its rows.

    One range sort; partition and place in it are written by the tasks that sorted
    them, so every later read sees the same places."""
    rows = Observation()
    placed = mart_df.orderBy(*sort_keys(mart)).select(
        "*", F.spark_partition_id().alias(PLACES[0]),
        F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias(PLACES[1]))
    placed.observe(rows, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return int(rows.get["rows"])


def stored_page(stored: DataFrame, mart: str, limit: int = DEFAULT_LIMIT,
                offset: int = 0) -> tuple[DataFrame, int]:
    """Rows ``[offset, offset + limit)`` of a mart stored with positions, and its size.

    The driver sees one count a partition; the page is a pushed-down filter on the
    partitions and places it covers, whatever the offset."""
    check_bounds(limit, offset)
    counts = stored.groupBy("_part").agg(F.count("*").alias("n")).orderBy("_part").collect()
    total, wanted = 0, F.lit(False)
    for part in counts:
        first, last = max(offset - total, 0), min(offset + limit - total, part["n"]) - 1
        if first <= last:
            wanted |= (F.col("_part") == part["_part"]) & F.col("_place").between(first, last)
        total += part["n"]
    rows = stored.where(wanted).orderBy("_part", "_place").drop("_part", "_place")
    return rows, total


def page(mart_df: DataFrame, mart: str, limit: int = DEFAULT_LIMIT, offset: int = 0) -> DataFrame:
    """A page of a mart that is not published: an ordered top-k of offset + limit rows.
    For deep pages publish the mart, or store it with ``write_positions``."""
    check_bounds(limit, offset)
    return mart_df.orderBy(*sort_keys(mart)).offset(offset).limit(limit)


def page_records(rows: DataFrame) -> DataFrame:
    """Each row as one JSON object with nulls written as ``null`` (F23);
    NaN values are mapped to null first, as JSON has no NaN."""
    cleaned = [
        (F.when(~F.isnan(F.col(f.name)), F.col(f.name)).alias(f.name)
         if f.dataType.typeName() in ("double", "float") else F.col(f.name))
        for f in rows.schema.fields
    ]
    return rows.select(F.to_json(F.struct(*cleaned), {"ignoreNullFields": "false"})
                       .alias("item"))


def read_mart_page(spark: SparkSession, out_root: str, mart: str, limit: int = DEFAULT_LIMIT,
                   offset: int = 0) -> MartPage:
    """Page of a published mart plus its total row count."""
    table = PUBLIC_MARTS.get(mart, mart)
    if table not in MART_NAMES:
        raise KeyError(f"Unknown mart: {mart}")
    check_bounds(limit, offset)
    rows, total = stored_page(Release(spark, out_root).read_placed(f"marts/{table}"),
                             table, limit, offset)
    return MartPage(mart, total, limit, offset, rows)


def latest_run(spark: SparkSession, reports_root: str) -> DataFrame:
    """The most recent ``pipeline_runs`` row (R2)."""
    runs = spark.read.parquet(report_paths(reports_root)["pipeline_runs"])
    cols = [c for c in runs.columns]
    best = runs.agg(F.max_by(F.struct(*cols), F.struct("started_at", "finished_at", "run_id")).alias("r"))
    return best.select("r.*")


def latest_quality(spark: SparkSession, reports_root: str) -> DataFrame:
    """Check rows of the most recent run (R2)."""
    results = spark.read.parquet(report_paths(reports_root)["quality_results"])
    run = latest_run(spark, reports_root).select("run_id")
    return results.join(run, "run_id", "left_semi")


def latest_report(spark: SparkSession, reports_root: str) -> DataFrame:
    """Status, totals and critical failures of the latest run's checks (R2, Q15)."""
    from ledgerlark.operators.quality import report_frame

    return report_frame(latest_quality(spark, reports_root))


def readiness(spark: SparkSession, out_root: str, reports_root: str) -> DataFrame:
    """``ok`` iff a run summary exists, all marts are published and the last run
    succeeded; otherwise ``degraded`` (R3)."""
    release = Release(spark, out_root)
    run_dir = release.current_run()
    marts_ready = run_dir is not None and all(
        fs.exists(spark, release.table_path(run_dir, f"marts/{m}")) for m in MART_NAMES)
    runs_path = report_paths(reports_root)["pipeline_runs"]
    if not fs.exists(spark, runs_path):
        return spark.range(1).select(
            F.lit("degraded").alias("status"), F.lit(None).cast("string").alias("pipeline_status"),
            F.lit(False).alias("artifacts_ready"), F.lit(None).cast("string").alias("run_id"))
    last = latest_run(spark, reports_root)
    ready = F.lit(bool(marts_ready))
    return last.select(
        F.when(ready & (F.col("status") == "success"), F.lit("ok"))
        .otherwise(F.lit("degraded")).alias("status"),
        F.col("status").alias("pipeline_status"),
        ready.alias("artifacts_ready"),
        "run_id",
    )
