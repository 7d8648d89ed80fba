"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import functools
import pickle
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaflow.session import shared_dir

PIECE_BYTES = 1 << 18  # text handled by one pass of array code inside a task


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: Column | str) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def ascii_lower(column: Column) -> Column:
    """A-Z to a-z; all other characters stay."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_count(column: Column | str) -> Column:
    """Number of runs of characters other than x20 and x09 to x0D; 0 for NULL."""
    return F.coalesce(F.regexp_count(F.col(column) if isinstance(column, str) else column, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame below the folder all executors share and read it back.

    Cuts the lineage with a table that outlives the executors; its schema is known, so reading starts no job.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 500) -> Iterator[None]:
    """Send fewer rows at once to Python stages that run inside, so that long texts need little memory there."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def pieces(sizes: list[int], limit: int = PIECE_BYTES) -> Iterator[slice]:
    """Slices of rows whose sizes add up to about ``limit``, one row at least."""
    begin, total = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > limit:
            yield slice(begin, i)
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield slice(begin, len(sizes))


def give_back() -> None:
    """Return what a Python worker has freed to the system; workers live on, and later stages start others beside them."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def lean(function: Callable) -> Callable:
    """A function of one batch that gives memory back when it is done."""
    @functools.wraps(function)
    def run(*args):
        try:
            return function(*args)
        finally:
            give_back()

    return run


def lean_stage(function: Callable) -> Callable:
    """A function from batches to batches that gives memory back after each."""
    @functools.wraps(function)
    def run(batches):
        for out in function(batches):
            yield out
            give_back()

    return run


def as_text(value: object) -> str:
    """A cell of a pandas string column: missing values are empty texts."""
    return value if isinstance(value, str) else ""


def share(spark: SparkSession, value: object) -> Broadcast:
    """Broadcast a model of bounded size; its classes travel with it, so executors need no installed package."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def shared_value(shared: Broadcast) -> object:
    return pickle.loads(shared.value)


HOT_SHARE = 1_000


def with_group_value(rows: DataFrame, groups: DataFrame, key: str, value: str) -> DataFrame:
    """Add a group's ``value`` to its rows; ``groups`` has one row of ``key, n, value`` for each key, NULL included.

    A key that fills a thousandth of the rows or more (there are at most a thousand of them) is looked up in a
    broadcast table, and its rows are dealt out one by one, not by the key; the others are joined by key.  ``rows``
    should be read straight from a table, so that a task made again numbers them alike.
    """
    def named(column: Column) -> Column:
        return F.coalesce(F.concat(F.lit("v"), column.cast("string")), F.lit("n"))

    held = stored(groups.select(F.col(key).alias("_k"), "n", F.col(value).alias("_v")), "groups")
    total = held.agg(F.sum("n")).first()[0] or 0
    common = F.col("n") * HOT_SHARE >= total
    hot = held.where(common).select("_k", F.col("_v").alias("_hot"), F.lit(True).alias("_is_hot"))
    cold = held.where(~common).select(named(F.col("_k")).alias("_cold"), "_v")
    marked = rows.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col("_k")), "left").drop("_k")
    # Rows found above meet nothing below: each has a key of its own.
    single = F.concat(F.lit("h"), F.monotonically_increasing_id().cast("string"))
    keyed = marked.withColumn("_cold", F.when(F.col("_is_hot"), single).otherwise(named(F.col(key))))
    joined = keyed.join(cold, "_cold", "left")
    return joined.withColumn(value, F.when(F.col("_is_hot"), F.col("_hot")).otherwise(F.col("_v"))).drop("_cold", "_hot", "_is_hot", "_v")
