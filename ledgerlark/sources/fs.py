"""Tiny driver-side file operations through Hadoop's FileSystem API.

Used only for metadata-sized work (a pointer file, existence checks), so the
same code runs against local disk, HDFS or an object store.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hpath.getFileSystem(conf), hpath, jvm


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs_and_path(spark, path)
    return bool(fs.exists(p))


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p, jvm = _fs_and_path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        lines = []
        line = reader.readLine()
        while line is not None:
            lines.append(line)
            line = reader.readLine()
        return "\n".join(lines)
    finally:
        stream.close()


def list_files(spark: SparkSession, path: str) -> list[str]:
    """The non-empty files that a path or glob names, those of a folder one by one; hidden
    names (_ or .) are left out, as by Spark's own readers."""
    fs, p, _ = _fs_and_path(spark, path)
    found: list[str] = []
    for top in fs.globStatus(p) or ():
        for status in fs.listStatus(top.getPath()) if top.isDirectory() else (top,):
            if not (status.isDirectory() or status.getPath().getName()[0] in "_.") and status.getLen():
                found.append(status.getPath().toString())
    return sorted(found)


def first_line(spark: SparkSession, path: str) -> str:
    """The first line of a text file, compressed or not."""
    fs, p, jvm = _fs_and_path(spark, path)
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(
        spark.sparkContext._jsc.hadoopConfiguration())
    codec = codecs.getCodec(p)
    stream = fs.open(p)
    try:
        stream = stream if codec is None else codec.createInputStream(stream)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        return reader.readLine() or ""
    finally:
        stream.close()


def write_text_atomic(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file next to ``path`` and move it into place.

    The move replaces the old file in one step, so a reader finds the old or the
    new pointer and never none.
    """
    fs, target, jvm = _fs_and_path(spark, path)
    tmp = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    try:
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        options = spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        context.rename(fs.makeQualified(tmp), fs.makeQualified(target), options)
    finally:
        if fs.exists(tmp):
            fs.delete(tmp, False)


def follow_pointer(spark: SparkSession, root: str, pointer: str, folder: str) -> str:
    """The folder that a pointer file under ``root`` names, or ``root`` without one."""
    root = root.rstrip("/")
    named = (read_text(spark, f"{root}/{pointer}") or "").strip()
    return f"{root}/{folder}/{named}" if named else root


def delete(spark: SparkSession, path: str) -> None:
    fs, p, _ = _fs_and_path(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders of ``path`` (empty if it does not exist)."""
    fs, p, _ = _fs_and_path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory())
