"""Join helpers: broadcast only behind a size check, hot keys dealt out by a salt."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A dimension is shipped to every executor only when the optimizer's size
# estimate for it is below this bound; otherwise the join shuffles and AQE
# may still switch to a broadcast from the *measured* shuffle size.  The
# estimate for a file scan is its on-disk (compressed) size, so the bound is
# kept well below executor memory to leave room for a 10x expansion.
DEFAULT_BROADCAST_BYTES = 8 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of ``df`` (file sizes for scans), if available."""
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        return int(str(stats.sizeInBytes()))  # a number here or there, as the gateway has it
    except Exception:  # Spark Connect or an unusual plan: no estimate
        return None


def broadcast_if_bounded(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast when its estimated size is within ``max_bytes``.

    Without an estimate, or above the bound, the frame is returned unchanged and
    the planner shuffles (AQE can still convert at run time from real sizes).
    """
    size = estimated_bytes(df)
    if size is not None and size <= max_bytes:
        return F.broadcast(df)
    return df


# How much larger than its compressed file a table is taken to be in memory.
EXPANSION = 10


def looked_up(df: DataFrame) -> DataFrame:
    """``df`` as the side of an equi-join that lines are looked up in, at most a few rows a
    key: broadcast when bounded, hashed where its share of a shuffle partition is, which spares
    sorting the lines, and sorted otherwise."""
    size = estimated_bytes(df)
    if size is None:
        return df
    if size <= DEFAULT_BROADCAST_BYTES:
        return F.broadcast(df)
    return df.hint("shuffle_hash") if fits_hash_map(df.sparkSession, size * EXPANSION) else df


# A key is hot from this share of a shuffle partition's fair load on, and is cut into
# pieces of the smaller share, so that pieces that meet in one partition stay small.
HOT_SHARE = 4
PIECE_SHARE = 16
# The share of a shuffle partition up to which a join side goes into a hash map.
MAX_HASHED_BYTES = 64 * 1024 * 1024
# Buckets of keys for each key that could be hot.
BUCKETS = 64


def hot_keys(lines: DataFrame, key: str, partitions: int | None = None) -> DataFrame | None:
    """The keys that hold more than 1 / (HOT_SHARE * ``partitions``) of ``lines``, with
    ``_parts``, the number of pieces to cut each into; None without any.

    Lines are first counted by bucket of the key's hash, which map-side partial sums bring
    down to a few rows a task.  A hot key makes its bucket at least as large, so only the keys
    of crowded buckets are counted one by one, and mostly there are none.  Fewer than
    HOT_SHARE * ``partitions`` keys can be hot, and their
    pieces number at most (HOT_SHARE + PIECE_SHARE) * ``partitions``.
    """
    spark = lines.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = lines.select(key).where(F.col(key).isNotNull())
    bucket = F.pmod(F.xxhash64(key), F.lit(BUCKETS * HOT_SHARE * partitions))
    crowded = crowded_buckets(keyed.select(bucket.alias("bucket")), partitions)
    if not crowded:
        return None
    total = next(iter(crowded.values()))
    counts = keyed.where(bucket.isin(*crowded)).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    pieces = F.ceil(F.col("n") * PIECE_SHARE * partitions / F.lit(total)).cast("long")
    hot = counts.where(F.col("n") * HOT_SHARE * partitions > total).select(
        key, F.least("n", pieces).alias("_parts"))
    rows = [r for r in hot.collect() if r["_parts"] > 1]
    return spark.createDataFrame(rows, hot.schema) if rows else None


def none_hot(spark: SparkSession, counts: tuple[int, int] | None) -> bool:
    """Whether ``hot_keys`` would find none, by the rows of the largest key and of all keys;
    without counts that is not known."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return counts is not None and counts[0] * HOT_SHARE * partitions <= counts[1]


def fits_hash_map(spark: SparkSession, size: int | None, max_bytes: int = MAX_HASHED_BYTES) -> bool:
    """Whether a join side of ``size`` measured bytes, of unique keys, may be looked up in a
    hash map, which spares sorting the lines: its share of a shuffle partition is bounded.  A
    hash map cannot spill, so without a measure, or above the bound, the join sorts."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return size is not None and size <= max_bytes * partitions


def crowded_buckets(buckets: DataFrame, partitions: int) -> dict[int, int]:
    """The buckets that hold more rows than a key has to have to be hot, fewer than HOT_SHARE *
    ``partitions``, and with each the number of all rows."""
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))  # one row a bucket
    counted = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).withColumn("total", total)
    return {r["bucket"]: r["total"] for r in counted.where(
        F.col("n") * HOT_SHARE * partitions > F.col("total")).collect()}


def join_dealt(lines: DataFrame, header: DataFrame, key: str, hot: DataFrame | None) -> DataFrame:
    """Inner join of ``lines`` with ``header`` on ``key``.  The lines of a key of ``hot`` (see
    ``hot_keys``) are dealt out over its pieces by their place in the scan, and its header
    rows are repeated for each piece; other keys, and null ones, are joined as they are.

    A task that is run again has to read its lines in the same order, as scans of stored
    files do."""
    if hot is None:
        return header.join(lines, key)
    parts = F.broadcast(hot)
    dealt = lines.join(parts, key, "left").withColumn(
        "_piece", F.expr("pmod(monotonically_increasing_id(), coalesce(_parts, 1L))")).drop("_parts")
    copies = header.join(parts, key, "left").withColumn(
        "_piece", F.expr("explode(sequence(0L, coalesce(_parts, 1L) - 1L))")).drop("_parts")
    return copies.join(dealt, [key, "_piece"]).drop("_piece")
