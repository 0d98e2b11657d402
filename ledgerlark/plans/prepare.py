"""Preparation job: invoice feed -> customers, orders, order_items.

The feed is parsed exactly once.  The drop-reason counters ride along that
pass as an ``Observation``; the surviving lines are written to the shared
work folder (lineage cut) and the three outputs are derived from that copy
concurrently, each counting its rows while it is written.  They go to a folder of
their own, and one pointer write makes all three visible: a failed preparation
leaves the earlier set as it was.  The report is a row of ``preparation_reports``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlark.functions.columns import DEFAULT_DATE_FORMATS
from ledgerlark.operators import normalize
from ledgerlark.plans.job import _parallel
from ledgerlark.session import shared_dir
from ledgerlark.sources import files, fs, sinks
from ledgerlark.sources.files import cap_rows, read_source

# Output sort keys: Parquet files are sorted within partitions (cheap, no global
# shuffle), a CSV as a whole.
_SORT_KEYS = {
    "customers": ("customer_id",),
    "orders": ("order_id",),
    "order_items": ("order_id", "product_id"),
}


def prepare_source(
    spark: SparkSession,
    source: DataFrame | str,
    raw_out: str,
    *,
    max_rows: int = 0,
    home_country: str = normalize.DEFAULT_HOME_COUNTRY,
    date_formats: Sequence[str] = DEFAULT_DATE_FORMATS,
    order_by: Sequence[str] | None = None,
    run_id: str | None = None,
    fmt: str = "parquet",
    csv_options: Mapping[str, str] | None = None,
    reports_root: str | None = None,
    attribution: Mapping[str, str] | None = None,
) -> dict[str, Any]:
    """Normalise the feed into three tables under ``raw_out``; return the report.

    ``fmt="parquet"`` writes folders ``<table>``; ``fmt="csv"`` header-first CSV
    folders ``<table>.csv``.  The raw-table loaders find the published set from
    ``raw_out``; ``outputs`` of the report names its paths.  The report is also
    appended under ``reports_root`` (``raw_out`` if none is given), together with
    ``attribution``: where the data come from, their license, how to cite them."""
    if fmt not in ("parquet", "csv"):
        raise ValueError("fmt must be 'parquet' or 'csv'")
    if max_rows < 0:
        raise ValueError("max_rows must be zero or a positive integer")
    if isinstance(source, str):
        frame = read_source(spark, source, max_rows, order_by, csv_options)
    else:
        frame = cap_rows(source, max_rows, order_by)
    run_id = run_id or sinks.new_run_id(sinks.utc_now())

    lines = normalize.parsed_lines(frame, home_country, date_formats)
    obs = Observation()
    observed = lines.observe(
        obs,
        F.count(F.lit(1)).alias("source_rows"),
        F.count_if(F.col("is_valid")).alias("normalized_rows"),
        *normalize.drop_reason_counters(),
    )
    release = sinks.Release(spark, raw_out, files.PREPARED_POINTER, files.PREPARED_FOLDER)
    if release.current_run() == run_id:
        raise ValueError(f"preparation {run_id} is published already")
    clean_path = f"{shared_dir(spark)}/ledgerlark/prepare-{run_id}/clean_lines"
    sinks.write_table(normalize.clean_lines(observed), clean_path)
    counts = obs.get
    clean = spark.read.parquet(clean_path)

    outputs = {
        "customers": normalize.customers_from(clean),
        "orders": normalize.orders_from(clean),
        "order_items": normalize.items_from(clean),
    }
    suffix = ".csv" if fmt == "csv" else ""
    paths = {name: release.table_path(run_id, f"{name}{suffix}") for name in outputs}

    def write(name: str, df: DataFrame) -> int:
        if fmt == "parquet":
            df = df.sortWithinPartitions(*_SORT_KEYS[name])
            return int(sinks.write_table(df, paths[name], count_rows=True))
        # A CSV is read in order of its part files: sorted as a whole (O1).
        df = df.orderBy(*_SORT_KEYS[name])
        obs = Observation()
        sinks.write_csv(df.observe(obs, F.count(F.lit(1)).alias("rows")), paths[name])
        return int(obs.get["rows"])

    try:
        rows = _parallel({name: (lambda n=name, df=df: write(n, df))
                          for name, df in outputs.items()})
    except Exception:
        fs.delete(spark, release.run_dir(run_id))  # never published
        raise
    finally:
        fs.delete(spark, clean_path.rsplit("/", 1)[0])
    release.publish(run_id)
    source_rows = int(counts["source_rows"])
    normalized_rows = int(counts["normalized_rows"])
    report = {
        "run_id": run_id,
        "generated_at": sinks.iso_millis(sinks.utc_now()),
        "source": source if isinstance(source, str) else None,
        "source_rows": source_rows,
        "normalized_rows": normalized_rows,
        "dropped_rows": source_rows - normalized_rows,
        "drop_reasons_before_overlap": {
            name: int(counts[name]) for name, _ in normalize.DROP_REASONS
        },
        "output_rows": {name: int(v) for name, v in rows.items()},
        "rows_requested": max_rows if max_rows else "all",
        "dataset_scope": "sample" if max_rows else "full",
        "outputs": paths,
        "attribution": dict(attribution or {}),
    }
    sinks.append_preparation_report(spark, reports_root or raw_out, report)
    return report
