"""Small file-system calls through Hadoop, so that they work on any store."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def _path(spark: SparkSession, path: str):
    handle = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return handle, handle.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """The path with scheme and without a final slash, as file listings show it."""
    handle, fs = _path(spark, path)
    return fs.makeQualified(handle).toString()


def exists(spark: SparkSession, path: str) -> bool:
    handle, fs = _path(spark, path)
    return fs.exists(handle)


def is_complete(spark: SparkSession, table: str) -> bool:
    """True if a Spark write to this folder has committed."""
    return exists(spark, f"{table}/_SUCCESS")


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; none if the folder is missing."""
    handle, fs = _path(spark, path)
    if not fs.exists(handle):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(handle))


def extent(spark: SparkSession, path: str) -> tuple[int, int] | None:
    """Number and bytes of all files below a folder; None if the folder is missing."""
    handle, fs = _path(spark, path)
    if not fs.exists(handle):
        return None
    found = fs.getContentSummary(handle)
    return found.getFileCount(), found.getLength()


def make_dir(spark: SparkSession, path: str) -> None:
    handle, fs = _path(spark, path)
    fs.mkdirs(handle)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder this library made for itself (staging data only)."""
    handle, fs = _path(spark, path)
    fs.delete(handle, True)


def write_table(df: DataFrame, path: str, mode: str = "errorifexists", **options: str) -> DataFrame:
    """Write a Parquet table and return it as stored; its known schema spares a look into the files."""
    df.write.mode(mode).options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def put_if_absent(spark: SparkSession, path: str, text: str) -> None:
    """Create a small file that must not exist yet.

    This is how everything is published: data lies under its final path before, and readers follow the file that names
    it.  Data is never renamed, so a store without cheap renames costs nothing extra.
    """
    handle, fs = _path(spark, path)
    fs.mkdirs(handle.getParent())
    try:
        out = fs.create(handle, False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName() or fs.exists(handle):
            raise FileExistsError(path) from None
        raise
    try:
        out.write(text.encode())
    finally:
        out.close()


def new_part(kind: str) -> str:
    """Name of a folder for one attempt's data; no two attempts share one."""
    return f"{kind}-{uuid.uuid4().hex[:16]}"


def discard(spark: SparkSession, part: str) -> None:
    """Delete an attempt's own data, and the folder around it if nothing else is there."""
    remove(spark, part)
    parent, fs = _path(spark, part.rstrip("/").rsplit("/", 1)[0])
    if fs.exists(parent) and not len(fs.listStatus(parent)):
        fs.delete(parent, False)
