"""Listing folders on any Hadoop filesystem (local, HDFS, object stores)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, uri: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(uri)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, uri: str) -> bool:
    path, fs = _fs(spark, uri)
    return bool(fs.exists(path))


def list_dirs(spark: SparkSession, uri: str) -> list[str]:
    """Names of the sub-folders of ``uri`` (empty when it does not exist)."""
    path, fs = _fs(spark, uri)
    if not fs.exists(path):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(path) if st.isDirectory())


def delete(spark: SparkSession, uri: str) -> bool:
    path, fs = _fs(spark, uri)
    return bool(fs.delete(path, True))


def touch(spark: SparkSession, uri: str) -> None:
    """Create an empty file."""
    path, fs = _fs(spark, uri)
    fs.create(path, True).close()


def make_dir(spark: SparkSession, uri: str) -> None:
    path, fs = _fs(spark, uri)
    fs.mkdirs(path)


def write_text(spark: SparkSession, uri: str, text: str) -> None:
    """A small file written by the driver in one piece."""
    path, fs = _fs(spark, uri)
    out = fs.create(path, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, uri: str) -> str | None:
    """The text of a small file; ``None`` when there is none."""
    path, fs = _fs(spark, uri)
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def list_files(spark: SparkSession, pattern: str) -> list[tuple[str, int, int]]:
    """``(path, bytes, modification time)`` of all files a path or glob pattern names, folders in depth, sorted."""
    path, fs = _fs(spark, pattern)
    out = []
    for found in fs.globStatus(path) or []:
        if found.isDirectory():
            files = fs.listFiles(found.getPath(), True)
            while files.hasNext():
                f = files.next()
                out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
        else:
            out.append((found.getPath().toString(), found.getLen(), found.getModificationTime()))
    return sorted(out)
