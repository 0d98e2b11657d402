"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.session import shared_dir

CHUNK_BYTES = 1 << 20
BROADCAST_IDS = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the folder all executors share and read it back.

    It cuts the lineage: a lost executor rereads files.  The files stay until the
    owner of ``spark.checkpoint.dir`` clears it, as with ``checkpoint()``.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_enough(ids: DataFrame) -> DataFrame:
    """A written table of long ids, marked for broadcast if its counted rows are at most
    BROADCAST_IDS (8 MB of ids); a longer one is joined by a shuffle.  A join of texts
    with few ids then moves no other texts."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def fold(column: Column | str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id falls in fold 0."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % folds, F.lit(0))


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES
           ) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Slices of a batch holding about ``limit`` bytes of ``column`` (one row at
    least), each with that column as bytes.  A row is never split."""
    texts = batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary())
    start = 0
    while start < len(texts):
        end, size = start, 0
        while end < len(texts) and (end == start or size < limit):
            scalar = texts[end]
            size += len(scalar.as_buffer()) if scalar.is_valid else 0
            end += 1
        yield batch.slice(start, end - start), texts.slice(start, end - start).to_pylist()
        start = end
    del texts
    pa.default_memory_pool().release_unused()  # idle workers share the executor's memory


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run``, after which its worker gives freed memory back to the system: workers
    wait for their next task beside those of other stages."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
            libc.malloc_trim(0)

    return wrapped


def replaced(batch: pa.RecordBatch, drop: str, name: str, values: pa.Array) -> pa.RecordBatch:
    """The batch without ``drop`` and any old ``name``, with ``values`` as ``name``."""
    keep = [i for i, n in enumerate(batch.schema.names) if n not in (drop, name)]
    return pa.RecordBatch.from_arrays(
        [*(batch.column(i) for i in keep), values],
        names=[*(batch.schema.names[i] for i in keep), name])


def schema_with(df: DataFrame, drop: tuple[str, ...], *new: str) -> str:
    """DDL of ``df`` without the columns in ``drop``, followed by ``new``."""
    names = {c.split(" ")[0].strip("`") for c in new} | set(drop)
    old = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name not in names]
    return ", ".join([*old, *new])
