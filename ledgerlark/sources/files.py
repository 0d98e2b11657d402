"""Scans of the invoice feed and of the three raw tables.

CSV is read with its header and every column as text, then columns are
selected *by name* and cast.  An explicit Spark schema would bind CSV columns
by position, so a dropped or reordered column would silently shift data.
"""

from __future__ import annotations

import csv
import functools
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.functions.columns import (
    WHOLE_NUMBER_PATTERN,
    Sql,
    lenient_double_sql,
    lit,
    ref,
)
from ledgerlark.sources import fs

# Where the preparation job names and keeps its published set of raw tables.
PREPARED_POINTER, PREPARED_FOLDER = "_PREPARED", "prepared"

# Raw file names and column types.
RAW_FILES: dict[str, str] = {
    "customers": "customers.csv",
    "orders": "orders.csv",
    "order_items": "order_items.csv",
}
RAW_TYPES: dict[str, dict[str, str]] = {
    "customers": {"customer_id": "string", "country": "string", "segment": "string",
                  "first_invoice_date": "string"},
    "orders": {"order_id": "string", "customer_id": "string", "order_date": "string",
               "status": "string"},
    "order_items": {"order_id": "string", "product_id": "string", "description": "string",
                    "quantity": "bigint", "unit_price": "double"},
}

# Cell texts that the usual CSV tooling reads as missing.
NA_TOKENS: tuple[str, ...] = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

CSV_OPTIONS: dict[str, str] = {
    "header": "true",
    "inferSchema": "false",
    "quote": '"',
    "escape": '"',
    "multiLine": "false",
    # A file whose header names other columns, and a row with more or fewer cells
    # than the header, fail the read: nothing is shifted, cut or filled in silently.
    "enforceSchema": "false",
    "mode": "FAILFAST",
    "columnPruning": "false",
}


class RawTypeError(ValueError):
    """A raw cell cannot take its declared type (e.g. quantity ``1.5``)."""

    def __init__(self, violations: Mapping[str, int]) -> None:
        self.violations = dict(violations)
        detail = ", ".join(f"{k}: {v} rows" for k, v in sorted(self.violations.items()))
        super().__init__(f"Raw values do not fit their declared types ({detail})")


def read_csv_text(spark: SparkSession, path: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """Header-first CSV, every column a string (splittable, no inference pass)."""
    return spark.read.options(**{**CSV_OPTIONS, **(options or {})}).csv(path)


def read_feed_text(spark: SparkSession, path: str, options: Mapping[str, str] | None = None
                   ) -> DataFrame:
    """CSV files of one feed, bound by column name: each group of files with one header is
    scanned with its own, and the groups are united by the names that all of them have.

    Only headers pass through the driver: the first line of each file."""
    merged = {**CSV_OPTIONS, **(options or {})}
    paths = fs.list_files(spark, path)
    if merged["header"] != "true" or len(paths) < 2:
        return read_csv_text(spark, path, options)
    with ThreadPoolExecutor(max_workers=16) as pool:
        lines = list(pool.map(lambda p: fs.first_line(spark, p), paths))
    sep, quote = merged.get("sep", merged.get("delimiter", ",")), merged["quote"]
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, line in zip(paths, lines):
        names = next(csv.reader([line.lstrip("\ufeff")], delimiter=sep, quotechar=quote))
        groups.setdefault(tuple(names), []).append(file)
    if len(groups) == 1:
        return read_csv_text(spark, path, options)
    common = [c for c in next(iter(groups)) if all(c in names for names in groups)]
    scans = [spark.read.options(**merged).csv(files).select(*(f"`{c}`" for c in common))
             for files in groups.values()]
    return functools.reduce(DataFrame.unionByName, scans)


def _missing_to_null(c: str, tokens: Sequence[str]) -> Sql:
    tokens_sql = ", ".join(lit(t) for t in tokens)
    return Sql(f"CASE WHEN {ref(c)} IN ({tokens_sql}) THEN NULL ELSE {ref(c)} END")


def read_source(spark: SparkSession, path: str, max_rows: int = 0,
                order_by: Sequence[str] | None = None,
                csv_options: Mapping[str, str] | None = None) -> DataFrame:
    """Source feed scan with an optional row cap (S1): 0 reads all, <0 is an error.

    A cap is the feature here (a sample run); it takes the first rows of the
    explicit ``order_by`` when given, else of the scan.  ``csv_options`` override
    the defaults; ``{"multiLine": "true"}`` reads line breaks inside quotes.  Files whose
    headers name the columns in another order are read by name (``read_feed_text``).
    """
    if max_rows < 0:
        raise ValueError("max_rows must be zero or a positive integer")
    return cap_rows(na_to_null(read_feed_text(spark, path, csv_options)), max_rows, order_by)


def na_to_null(df: DataFrame, tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """Text cells holding a missing-value token become null (before any trim)."""
    return df.select(*[F.expr(_missing_to_null(c, tokens)).alias(c) if t == "string"
                       else F.col(c) for c, t in df.dtypes])


def cap_rows(df: DataFrame, max_rows: int, order_by: Sequence[str] | None = None) -> DataFrame:
    if max_rows < 0:
        raise ValueError("max_rows must be zero or a positive integer")
    if max_rows == 0:
        return df
    if order_by:
        df = df.orderBy(*[F.col(c).asc_nulls_last() for c in order_by])
    return df.limit(max_rows)


@dataclass(frozen=True)
class RawTables:
    """Typed raw tables plus a lazy count of cells that failed their type."""

    frames: dict[str, DataFrame]
    violations: DataFrame | None = None

    def verify(self) -> None:
        """Raise ``RawTypeError`` if any cell failed its cast (one small job)."""
        if self.violations is None:
            return
        row = self.violations.first()
        bad = {k: int(v) for k, v in row.asDict().items() if v}
        if bad:
            raise RawTypeError(bad)


def whole_number_sql(text: Sql) -> Sql:
    """BIGINT of whole-number text such as ``2`` or ``2.0``; null if it is none or
    out of range."""
    digits = f"regexp_replace(trim({ref(text)}), {lit(r'\.0*$')}, '')"
    return Sql(f"CASE WHEN {ref(text)} RLIKE {lit(WHOLE_NUMBER_PATTERN)} "
               f"THEN try_cast({digits} AS BIGINT) END")


def typed_columns(frame: DataFrame, table: str,
                  na_tokens: Sequence[str] = NA_TOKENS) -> list[Column]:
    """Declared columns cast by name from text; other columns pass through."""
    types = RAW_TYPES.get(table, {})
    cols: list[Column] = []
    for c, dtype in frame.dtypes:
        want = types.get(c)
        if want is None or dtype != "string":
            cols.append(F.col(c))
            continue
        text = _missing_to_null(c, na_tokens)
        if want == "string":
            cols.append(F.expr(text).alias(c))
        elif want == "bigint":
            cols.append(F.expr(whole_number_sql(text)).alias(c))
        else:
            cols.append(F.expr(f"CAST({lenient_double_sql(text)} AS {want})").alias(c))
    return cols


def violation_counters(frame: DataFrame, table: str,
                       na_tokens: Sequence[str] = NA_TOKENS) -> list[Column]:
    """Per typed column: rows whose text cannot take the declared type."""
    types = RAW_TYPES.get(table, {})
    out: list[Column] = []
    for c, dtype in frame.dtypes:
        want = types.get(c)
        if want in (None, "string") or dtype != "string":
            continue
        text = ref(_missing_to_null(c, na_tokens))
        if want == "bigint":
            bad = f"{ref(whole_number_sql(Sql(text)))} IS NULL"
        else:
            bad = f"{ref(lenient_double_sql(Sql(text)))} IS NULL"
        out.append(F.expr(f"count_if({text} IS NOT NULL AND {bad})").alias(f"{table}.{c}"))
    return out


def type_raw(frames: Mapping[str, DataFrame], na_tokens: Sequence[str] = NA_TOKENS) -> RawTables:
    """Select declared columns by name and cast them; extra columns are kept."""
    typed = {name: frame.select(*typed_columns(frame, name, na_tokens))
             for name, frame in frames.items()}
    counters = [(frame, violation_counters(frame, name, na_tokens))
                for name, frame in frames.items()]
    parts = [frame.agg(*cols) for frame, cols in counters if cols]
    return RawTables(typed, parts[0] if parts else None)


def read_raw_text(spark: SparkSession, raw_dir: str, fmt: str = "csv",
                  names: Sequence[str] = tuple(RAW_FILES),
                  csv_options: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    """The raw tables as scanned, before typing (CSV: all text)."""
    raw_dir = fs.follow_pointer(spark, raw_dir, PREPARED_POINTER, PREPARED_FOLDER)
    if fmt == "parquet":
        return {n: spark.read.parquet(f"{raw_dir}/{n}") for n in names}
    # Reading a CSV header is a small job per table; resolve them concurrently.
    with ThreadPoolExecutor(max_workers=max(1, len(names))) as pool:
        frames = pool.map(lambda n: read_csv_text(
            spark, f"{raw_dir}/{RAW_FILES[n]}", csv_options), names)
        return dict(zip(names, frames))


def load_raw_tables(spark: SparkSession, raw_dir: str, fmt: str = "parquet",
                    names: Sequence[str] = tuple(RAW_FILES),
                    csv_options: Mapping[str, str] | None = None) -> RawTables:
    """Load the raw tables (S2); Parquet keeps its types, CSV is typed by name."""
    raw_dir = fs.follow_pointer(spark, raw_dir, PREPARED_POINTER, PREPARED_FOLDER)
    if fmt == "parquet":
        return RawTables({n: spark.read.parquet(f"{raw_dir}/{n}") for n in names})
    return type_raw(read_raw_text(spark, raw_dir, "csv", names, csv_options))


def register_views(tables: Mapping[str, DataFrame], prefix: str = "raw_") -> list[str]:
    """Expose tables to SQL as temporary views ``<prefix><name>``."""
    names = []
    for name, frame in tables.items():
        frame.createOrReplaceTempView(f"{prefix}{name}")
        names.append(f"{prefix}{name}")
    return names
