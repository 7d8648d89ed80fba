"""IDs of all committed batches, so that a new batch can be checked without reading them all.

Every batch leaves one *run*: a folder with its IDs, in buckets by hash.  A batch is compared with those buckets of the
earlier runs that its own IDs fall into.  Eight runs of one level are merged into one of the next, so there are few runs
however many batches there were, and an ID is rewritten a few times at most.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaflow.operators.duplicates import duplicate_keys
from taxaflow.sources import storage

BUCKETS = 64
MERGED = 8
SCHEMA = "h bigint, sample_id string, bucket int"
# Batches up to this many IDs are broadcast to the scan of the buckets; larger ones are joined by hash.
MAX_BROADCAST_IDS = 1_000_000


@dataclass(frozen=True, order=True)
class Run:
    """Batches ``first`` to ``last``, merged ``level`` times."""

    first: int
    last: int
    level: int

    @property
    def name(self) -> str:
        return f"run-{self.first:012d}-{self.last:012d}-{self.level:02d}"


def runs(spark: SparkSession, folder: str, before: int) -> list[Run]:
    """Finished runs of batches below ``before``, without those a larger run has taken up."""
    found = []
    for name in storage.children(spark, folder):
        if name.startswith("run-") and storage.is_complete(spark, f"{folder}/{name}"):
            run = Run(*map(int, name.split("-")[1:]))
            if run.last < before:
                found.append(run)
    return sorted(r for r in found if not any(o.first <= r.first and r.last <= o.last and o.level > r.level for o in found))


def _read(spark: SparkSession, folder: str, chosen: list[Run]) -> DataFrame:
    """IDs of some runs, fewer than ``MERGED`` for each level."""
    ids = [spark.read.schema(SCHEMA).parquet(f"{folder}/{r.name}") for r in chosen]
    return reduce(DataFrame.unionByName, ids)


def _write(ids: DataFrame, path: str) -> None:
    ids.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)


def bucketed(batch: DataFrame) -> DataFrame:
    h = F.xxhash64("sample_id")
    return batch.select(h.alias("h"), "sample_id", F.pmod(h, F.lit(BUCKETS)).cast("int").alias("bucket"))


def add_run(batch: DataFrame, folder: str, number: int) -> None:
    """Store a batch's IDs; done again after a crash, it replaces what was there."""
    _write(bucketed(batch), f"{folder}/{Run(number, number, 0).name}")


def merge_runs(spark: SparkSession, folder: str, before: int) -> None:
    """Merge while the last runs are ``MERGED`` of one level.  What was merged is deleted once the merged run is there."""
    while True:
        present = runs(spark, folder, before)
        tail = present[-MERGED:]
        if len(tail) < MERGED or len({r.level for r in tail}) > 1:
            return
        merged = Run(tail[0].first, tail[-1].last, tail[0].level + 1)
        _write(_read(spark, folder, tail), f"{folder}/{merged.name}")
        for run in tail:
            storage.remove(spark, f"{folder}/{run.name}")


def seen_before(batch: DataFrame, folder: str, number: int, *, small_batch: bool) -> DataFrame:
    """IDs that occur twice in a batch or in one before it.  Reads the buckets the batch falls into (64 numbers at most)."""
    spark = batch.sparkSession
    inside = duplicate_keys(batch, ["sample_id"]).select("sample_id")
    earlier = runs(spark, folder, number)
    if not earlier:
        return inside
    arrived = bucketed(batch)
    touched = [r[0] for r in arrived.select("bucket").distinct().collect()]
    known = _read(spark, folder, earlier).where(F.col("bucket").isin(touched))
    met = known.join(F.broadcast(arrived) if small_batch else arrived, ["bucket", "h", "sample_id"], "left_semi")
    return inside.union(met.select("sample_id")).distinct()
