"""Positions, shards and batches without a global sort.

A row's position is the number of rows in earlier input splits plus its place
in its own split.  Only the table of splits (one row per split) is summed up, in
two steps; the documents themselves are neither sorted nor moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A split is three numbers when broadcast, 24 bytes and some overhead, so this stays near 100 MB.
MAX_BROADCAST_SPLITS = 2_000_000


def split_key(split: list[str]) -> Column:
    """A number for a split's path and offset; whoever joins by it checks that no two splits share one."""
    return F.xxhash64(*split)


def split_offsets(df: DataFrame, split: list[str], seq: str = "seq") -> DataFrame:
    """One row per split: its columns and key, ``first_seq`` and ``offset`` (rows before it).

    Map-side combining leaves one row per split.  They are summed up inside each file, and over the files.
    """
    sizes = df.groupBy(*split).agg(F.count(F.lit(1)).alias("split_rows"), F.min(seq).alias("first_seq"))
    files = sizes.groupBy(split[0]).agg(F.sum("split_rows").alias("file_rows"))
    inside = Window.partitionBy(split[0]).orderBy(*split[1:]).rowsBetween(Window.unboundedPreceding, -1)
    offset = F.col("file_offset") + F.coalesce(F.sum("split_rows").over(inside), F.lit(0))
    return sizes.join(_file_offsets(files, split[0]), split[0]).select(
        *split, split_key(split).alias("split_key"), "first_seq", "split_rows", offset.cast("bigint").alias("offset")
    )


def _file_offsets(files: DataFrame, path: str) -> DataFrame:
    """Rows in earlier files; one row per file, summed up in one task."""
    earlier = Window.orderBy(path).rowsBetween(Window.unboundedPreceding, -1)
    return files.select(path, F.coalesce(F.sum("file_rows").over(earlier), F.lit(0)).cast("bigint").alias("file_offset"))


def with_position(df: DataFrame, offsets: DataFrame, split: list[str], seq: str = "seq", *, n_splits: int | None = None, distinct_keys: bool = False) -> DataFrame:
    """Add ``input_pos``.  ``seq`` must rise by one from row to row within a split.

    With ``distinct_keys`` (the caller counted them) rows find their split by a number, else by its columns.  The
    splits are broadcast only if their counted number is small enough; otherwise Spark picks the join.
    """
    by = ["split_key"] if distinct_keys else split
    table = offsets.select(*by, "first_seq", "offset")
    if n_splits is not None and n_splits <= MAX_BROADCAST_SPLITS:
        table = F.broadcast(table)
    keyed = df.withColumn("split_key", split_key(split)) if distinct_keys else df
    return (
        keyed.join(table, by)
        .withColumn("input_pos", F.col("offset") + F.col(seq) - F.col("first_seq"))
        .drop("offset", "first_seq", "split_key")
    )


def with_stored_place(stored: DataFrame, keep: Column) -> DataFrame:
    """Rows of a stored table that pass ``keep``, with their place among them (``k``) and the chunk they were read from.

    ``k`` rises by one from row to row of a task, and its upper bits are the task.
    """
    hidden = stored.metadataColumn("_metadata")
    chunk = F.struct(hidden["file_path"].alias("file"), hidden["file_block_start"].alias("block"))
    return stored.select("*", chunk.alias("chunk")).where(keep).withColumn("k", F.monotonically_increasing_id())


def with_dense_position(placed: DataFrame, split: list[str], run_rows: int, seq: str = "seq") -> DataFrame:
    """Add ``input_pos`` without holes to a table written from :func:`with_stored_place`.

    Rows of one input split that were read in one go are a segment: places and ``seq`` rise together in it.  A sum over
    the segments of each file and one over the files give a segment's first position.  A row finds its segment by the
    number of its task, among the few segments of that task; the join key is that number.
    """
    task = F.shiftright("k", 33)
    segments = placed.groupBy(task.alias("task"), *split, "chunk", F.floor(F.col(seq) / run_rows).alias("run")).agg(
        F.count(F.lit(1)).alias("n"), F.min("k").alias("first_k"), F.min(seq).alias("first_seq")
    )
    files = _file_offsets(segments.groupBy(split[0]).agg(F.sum("n").alias("file_rows")), split[0])
    inside = Window.partitionBy(split[0]).orderBy(*split[1:], "first_seq").rowsBetween(Window.unboundedPreceding, -1)
    offset = (F.col("file_offset") + F.coalesce(F.sum("n").over(inside), F.lit(0))).cast("bigint")
    located = segments.join(files, split[0]).select("task", F.struct("first_k", offset.alias("offset")).alias("segment"))
    by_task = located.groupBy("task").agg(F.sort_array(F.collect_list("segment")).alias("segments"))
    mine = F.element_at(F.filter("segments", lambda s: s["first_k"] <= F.col("k")), -1)
    joined = placed.withColumn("task", task).join(by_task, "task")
    return joined.withColumn("input_pos", mine["offset"] + F.col("k") - mine["first_k"]).drop("task", "segments", "chunk", "k")


def shard_index(position: Column, shard_rows: int) -> Column:
    return F.floor(position / F.lit(shard_rows)).cast("bigint")


def shard_id(index: Column) -> Column:
    """``shard-000000`` and so on; longer numbers are not cut."""
    return F.format_string("shard-%06d", index)


def shard_path(identifier: Column) -> Column:
    return F.concat(F.lit("inputs/"), identifier, F.lit(".jsonl"))


def batch_number(position_in_shard: Column, batch_size: int) -> Column:
    return F.floor(position_in_shard / F.lit(batch_size)).cast("bigint")


def forwards(rows: Column, batch_size: int) -> Column:
    """Model calls a shard takes."""
    return F.ceil(rows / F.lit(batch_size)).cast("bigint")


def worker(index: Column, workers: int) -> Column:
    """Round-robin bucket of a shard."""
    return F.pmod(index, F.lit(workers))
