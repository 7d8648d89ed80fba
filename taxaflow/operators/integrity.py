"""Digests, registries, receipts and reference checks as table operations."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaflow.errors import BindingMismatch, IntegrityError, InvalidInput
from taxaflow.sources.remote import can_open, open_file
from taxaflow.sources.storage import qualified

LANES = 4  # 32 bits each: sums of 2^31 rows still fit a BIGINT


def row_digest_lanes(sha256_hex: Column) -> list[Column]:
    """A row hash cut into BIGINT lanes."""
    return [
        F.conv(F.substring(sha256_hex, 1 + 8 * i, 8), 16, 10).cast("bigint").alias(f"lane{i}") for i in range(LANES)
    ]


def content_digest(df: DataFrame, by: list[str], row_sha256: str, row_bytes: str, extra: tuple[Column, ...] = ()) -> DataFrame:
    """Rows, bytes and an order-free digest per group; ``extra`` aggregates ride along.

    Summing row hashes instead of hashing sorted content needs no sort and
    combines on the map side: one row per group and task is shuffled.
    """
    sums = [F.sum(lane).alias(f"lane{i}") for i, lane in enumerate(row_digest_lanes(F.col(row_sha256)))]
    totals = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row_bytes), F.lit(0)).cast("bigint").alias("bytes"), *sums, *extra
    )
    lanes = [F.coalesce(F.col(f"lane{i}"), F.lit(0)).cast("string") for i in range(LANES)]
    digest = F.sha2(F.concat_ws(":", F.col("rows").cast("string"), *lanes), 256)
    computed = {*by, "rows", "bytes", *[f"lane{i}" for i in range(LANES)]}
    return totals.select(*by, "rows", "bytes", digest.alias("digest"), *[c for c in totals.columns if c not in computed])


BLOCK_BYTES = 8 << 20
HASHING_TASKS = 10_000  # most tasks that hash files
FILES_PER_TASK = 16  # once every core has a few tasks
EMPTY_SHA256 = hashlib.sha256().hexdigest()


def _hash_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size and SHA-256 of whole files of any size, read block by block."""
    for batch in batches:
        sizes, digests = [], []
        for path in batch.column(0).to_pylist():
            total, size = hashlib.sha256(), 0
            with open_file(path) as handle:
                while block := handle.read(BLOCK_BYTES):
                    total.update(block)
                    size += len(block)
            sizes.append(size)
            digests.append(total.hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.string())], ["path", "bytes", "sha256"])


def hashed_files(spark: SparkSession, paths: list[str], *, glob: str | None = None, content: bool = True) -> DataFrame:
    """``path, bytes, sha256`` of all files at or below some paths.

    Tasks read each file in blocks, so a file may have any size.  In a store that tasks can't open, Spark reads files as
    a whole, up to 2 GB each.  Without ``content`` only names and sizes are listed.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(paths)
    names = [re.sub("^file:/+", "file:/", unquote(f)) for f in files.inputFiles()]
    listed = spark.createDataFrame(pa.table({"path": pa.array(names, pa.string())}), "path string")
    if content and all(can_open(qualified(spark, p)) for p in paths):
        enough = max(4 * spark.sparkContext.defaultParallelism, -(-len(names) // FILES_PER_TASK))
        spread = listed.repartition(max(1, min(len(names), enough, HASHING_TASKS)))
        return spread.mapInArrow(_hash_files, "path string, bytes bigint, sha256 string")
    none = F.lit(None).cast("string")
    read = files.select("path", F.col("length").alias("bytes"), (F.sha2("content", 256) if content else none).alias("sha256"))
    # Spark's scan leaves empty files out.
    empty = listed.join(files.select("path"), "path", "left_anti")
    return read.unionAll(empty.select("path", F.lit(0).cast("bigint"), F.lit(EMPTY_SHA256) if content else none))


def file_inventory(spark: SparkSession, path: str, *, glob: str | None = None, content: bool = True) -> DataFrame:
    """:func:`hashed_files` of a folder, with paths relative to it."""
    prefix = len(qualified(spark, path)) + 2
    return hashed_files(spark, [path], glob=glob, content=content).withColumn("path", F.substring("path", prefix, 1 << 20))


def is_safe_path(path: Column) -> Column:
    """Relative, not empty, without a parent step or a backslash."""
    parts = F.filter(F.split(path, "/"), lambda p: (p != "") & (p != "."))
    bad = (
        path.startswith("/") | (F.size(parts) == 0) | F.array_contains(parts, "..") | path.contains("\\")
    )
    return F.coalesce(~bad, F.lit(False))


def registry_audit(registry: DataFrame, observed: DataFrame) -> DataFrame:
    """``path, status`` for every registered or found file.

    Status is ok, changed, missing, unregistered or unsafe_path.
    """
    r = registry.select("path", F.col("bytes").alias("r_bytes"), F.col("sha256").alias("r_sha"), F.lit(True).alias("r"))
    o = observed.select("path", F.col("bytes").alias("o_bytes"), F.col("sha256").alias("o_sha"), F.lit(True).alias("o"))
    same = (F.col("r_bytes") == F.col("o_bytes")) & (F.col("r_sha") == F.col("o_sha"))
    status = (
        F.when(F.col("r").isNull(), "unregistered")
        .when(~is_safe_path(F.col("path")), "unsafe_path")
        .when(F.col("o").isNull(), "missing")
        .when(F.coalesce(same, F.lit(False)), "ok")
        .otherwise("changed")
    )
    return r.join(o, "path", "full_outer").select("path", status.alias("status"))


def file_set_digest(files: DataFrame) -> DataFrame:
    """One digest for a set of files, whatever their order: all (path, hash) pairs."""
    pairs = files.select(F.sha2(F.concat_ws("\n", "path", "sha256"), 256).alias("h"), "bytes")
    return content_digest(pairs, [], "h", "bytes")


def missing_required(required: DataFrame, registry: DataFrame) -> DataFrame:
    """Required paths the registry lacks."""
    return required.select("path").join(registry, "path", "left_anti")


def dangling(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key has no parent row.

    The parent is reduced to distinct keys by its own join side; a key that
    fills a third of the child is split by the skew-join rule.
    """
    return child.join(parent.select(key), key, "left_anti")


def signed_counts(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` with the number of rows on either side; both tables are read once and meet in one shuffle.

    Counts combine on the map side, so a value that fills a third of the rows is one row of each task.  NULLs are equal.
    """
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    tagged = left.select(*columns, one.alias("in_left"), none.alias("in_right")).unionAll(
        right.select(*columns, none.alias("in_left"), one.alias("in_right"))
    )
    return tagged.groupBy(*columns).agg(F.sum("in_left").alias("in_left"), F.sum("in_right").alias("in_right"))


def surplus(counted: DataFrame, columns: list[str], left: Column, right: Column) -> DataFrame:
    """As many rows of ``columns, side`` as one side has more."""
    several = counted.select(
        *columns, F.when(left > 0, "left").otherwise("right").alias("side"), F.greatest(left, right).cast("int").alias("n")
    ).where("n > 0")
    return several.select(*columns, "side", F.explode(F.array_repeat(F.lit(0), F.col("n"))).alias("one")).drop("one")


def key_mismatch(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys only one of two tables has, with the side that has them, once for each row."""
    here, there = F.col("in_left"), F.col("in_right")
    return surplus(signed_counts(left, right, [key]), [key], F.when(there == 0, here).otherwise(0), F.when(here == 0, there).otherwise(0))


def receipt_audit(shards: DataFrame, receipts: DataFrame, observed: DataFrame | None = None) -> DataFrame:
    """``id, status`` per shard or receipt.

    ``shards`` carries id, rows, digest; ``receipts`` id, rows, input_digest and
    predictions_digest; ``observed`` id, rows and digest of the predictions now stored.
    """
    s = shards.select("id", F.col("rows").alias("s_rows"), F.col("digest").alias("s_digest"), F.lit(True).alias("s"))
    r = receipts.select("id", F.col("rows").alias("r_rows"), "input_digest", "predictions_digest", F.lit(True).alias("r"))
    joined = s.join(r, "id", "full_outer")
    status = (
        F.when(F.col("s").isNull(), "unknown_shard")
        .when(F.col("r").isNull(), "pending")
        .when(
            ~(F.col("s_rows").eqNullSafe(F.col("r_rows")) & F.col("s_digest").eqNullSafe(F.col("input_digest"))),
            "provenance_mismatch",
        )
    )
    if observed is not None:
        o = observed.select("id", F.col("rows").alias("o_rows"), F.col("digest").alias("o_digest"))
        joined = joined.join(o, "id", "left")
        status = status.when(
            ~(F.col("o_rows").eqNullSafe(F.col("r_rows")) & F.col("o_digest").eqNullSafe(F.col("predictions_digest"))),
            "corrupt",
        )
    return joined.select("id", status.otherwise("complete").alias("status"))


def pending_shards(shards: DataFrame, receipts: DataFrame) -> DataFrame:
    return shards.join(receipts.select("id"), "id", "left_anti")


def manifest_faults(shards: DataFrame, total_rows: int) -> DataFrame:
    """One row per broken rule of a job's shard table; empty if it is sound."""
    named = F.col("id").rlike("^shard-[0-9]{6,}$")
    placed = (F.col("path") == F.concat(F.lit("inputs/"), F.col("id"), F.lit(".jsonl"))) & is_safe_path(F.col("path"))
    bad = shards.select(
        "id",
        F.when(~F.coalesce(named, F.lit(False)), "invalid_id")
        .when(~F.coalesce(F.col("rows") >= 1, F.lit(False)), "invalid_rows")
        .when(~F.coalesce(placed, F.lit(False)), "unexpected_path")
        .alias("fault"),
    ).where("fault is not null")
    doubled = shards.groupBy("id").count().where("count > 1").select("id", F.lit("duplicate_id").alias("fault"))
    sums = shards.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("k"))
    total = sums.where((F.col("n") != total_rows) | (F.col("k") == 0)).select(
        F.lit(None).cast("string").alias("id"),
        F.when(F.col("k") == 0, "no_shards").otherwise("row_count_mismatch").alias("fault"),
    )
    return bad.unionByName(doubled).unionByName(total)


def require_empty(faults: DataFrame, message: str, error: type[Exception] = IntegrityError) -> None:
    """Raise with a few examples if the table has rows."""
    shown = faults.limit(5).collect()
    if shown:
        raise error(message + ": " + "; ".join(str(tuple(r)) for r in shown))


def require_same_binding(stored: dict, wanted: dict) -> None:
    if stored != wanted:
        changed = sorted(k for k in {*stored, *wanted} if stored.get(k) != wanted.get(k))
        raise BindingMismatch("This output was made with other settings; changed: " + ", ".join(changed))


def require_valid_manifest(shards: DataFrame, total_rows: int) -> None:
    require_empty(manifest_faults(shards, total_rows), "Invalid job manifest", InvalidInput)
