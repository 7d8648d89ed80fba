"""ID uniqueness."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaflow.errors import DuplicateDocuments


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count.

    Counting combines on the map side, so a key that holds a third of all rows
    reaches the reducer as one row per map task.
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


# Doubled hashes up to this many (16 MB) are broadcast to the rows; more are joined by hash.
MAX_BROADCAST_HASHES = 1_000_000


def suspects(df: DataFrame, keys: list[str]) -> DataFrame | None:
    """The rows' keys whose hash occurs twice; None if there are none.  Other keys are not moved."""
    hashed = df.select(F.xxhash64(*keys).alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    doubled = hashed.count()
    if not doubled:
        return None
    marked = df.select(*keys, F.xxhash64(*keys).alias("h"))
    return marked.join(F.broadcast(hashed) if doubled <= MAX_BROADCAST_HASHES else hashed, "h", "left_semi").select(*keys)


def first_duplicates(df: DataFrame, keys: list[str], shown: int) -> list[tuple]:
    """Some keys that occur twice.  Shuffles 8-byte hashes, and the keys of rows that share one.

    Keys decide in the end, so a hash collision never counts as a duplicate.
    """
    found = suspects(df, keys)
    return [] if found is None else [tuple(r)[:-1] for r in duplicate_keys(found, keys).limit(shown).collect()]


def has_duplicates(df: DataFrame, keys: list[str]) -> bool:
    """True if any key occurs twice."""
    return bool(first_duplicates(df, keys, 1))


def require_unique(df: DataFrame, keys: list[str]) -> None:
    shown = first_duplicates(df, keys, 5)
    if shown:
        raise DuplicateDocuments("Duplicate IDs, for example " + ", ".join(map(str, shown)))


def repeated_ids(batch: DataFrame, committed: DataFrame, key: str = "sample_id", *, small_batch: bool = False) -> DataFrame:
    """IDs of a batch that occur twice in it or were committed before.

    With ``small_batch`` (the caller counted it) the batch is broadcast to the
    scan of the committed IDs, so the growing side is never shuffled.
    """
    inside = duplicate_keys(batch, [key]).select(key)
    arrived = batch.select(key)
    seen = committed.select(key).join(F.broadcast(arrived) if small_batch else arrived, key, "left_semi")
    return inside.union(seen).distinct()
