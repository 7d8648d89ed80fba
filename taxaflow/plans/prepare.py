"""Prepare job: input files -> checked, numbered documents and a manifest."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from taxaflow.errors import IntegrityError, InvalidInput
from taxaflow.functions.metadata import reprint_stored
from taxaflow.functions.text import INPUT_SCOPE, VISIBLE_TOKENS
from taxaflow.operators.duplicates import require_unique
from taxaflow.operators.integrity import content_digest, hashed_files
from taxaflow.operators.normalize import normalize_fields, record_line
from taxaflow.operators.sharding import (
    shard_id, shard_index, shard_path, split_offsets, with_dense_position, with_position, with_stored_place,
)
from taxaflow.schemas import DOCUMENT_FIELDS
from taxaflow.session import configure
from taxaflow.sources import storage
from taxaflow.sources.jobs import JOB_DOCUMENTS, JOB_FORMAT, MANIFEST, write_json_record
from taxaflow.sources.records import MAX_RECORD_CHARS, RUN_LINES, is_parquet, read_records

SPLIT = ["file_path", "block_start"]
PLACE = ["input_pos", "shard_index"]


def source_state(spark: SparkSession, paths: list[str], check: str) -> str:
    """Digest of the input files' names, sizes and times, or of their content."""
    if check == "digest":
        files = hashed_files(spark, paths).select("path", F.col("bytes").alias("length"), F.col("sha256").alias("mark"))
    else:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
        files = found.select("path", "length", F.col("modificationTime").cast("string").alias("mark"))
    rows = files.select(F.sha2(F.concat_ws("\n", "path", F.col("length").cast("string"), "mark"), 256).alias("h"), "length")
    return content_digest(rows, [], "h", "length").first()["digest"]


def with_content_hash(documents: DataFrame) -> DataFrame:
    """Size and hash of each document's content.

    The fields are hashed one after another, behind a line with their lengths:
    nothing is escaped, and no two documents have the same hashed text.
    """
    missing = F.lit("null")
    parts = [
        F.col("sample_id"), F.col("text_window"), F.col("metadata_compact"), F.col("source_family"),
        F.coalesce(F.col("source_locator"), missing), F.coalesce(F.col("raw_windowed").cast("string"), missing),
    ]
    sizes = [F.octet_length(p) for p in parts]
    head = F.concat_ws(",", *[s.cast("string") for s in sizes])
    total = sizes[0]
    for size in sizes[1:]:
        total = total + size
    return documents.withColumn("row_bytes", total.cast("bigint")).withColumn(
        "row_sha256", F.sha2(F.concat(head, F.lit("\n"), *parts), 256)
    )


def shard_table(documents: DataFrame) -> DataFrame:
    """Rows, bytes and digest per shard; reads three narrow columns."""
    totals = content_digest(documents, ["shard_index"], "row_sha256", "row_bytes")
    identifier = shard_id(F.col("shard_index"))
    return totals.select(
        "shard_index", identifier.alias("id"), shard_path(identifier).alias("path"), "rows", "bytes", "digest"
    )


def _table_splits(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Rows per Parquet file: no column is read, the footers say it."""
    return spark.read.schema("__none string").parquet(*paths).select(
        F.col("_metadata.file_path").alias("file_path"), F.lit(0).cast("bigint").alias("block_start"),
        F.lit(0).cast("bigint").alias("seq"),
    )


def numbered(rows: DataFrame, counted: DataFrame, staging: str, shard_rows: int, *, hashed: bool = True) -> DataFrame:
    """Give ``rows`` their position and shard, from the split sizes found in ``counted``."""
    offsets = storage.write_table(split_offsets(counted, SPLIT), f"{staging}/splits")
    counts = offsets.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("split_key").alias("keys")).first()
    placed = with_position(rows, offsets, SPLIT, n_splits=counts["n"], distinct_keys=counts["n"] == counts["keys"])
    placed = placed.withColumn("shard_index", shard_index(F.col("input_pos"), shard_rows))
    return with_content_hash(placed) if hashed else placed


def write_shard_lines(documents: DataFrame, path: str, files: int | None = None) -> None:
    """JSON lines, one folder and one ordered file per shard, for tools that want files.

    This moves every document once.  The default table layout does not.
    """
    lines = documents.select(shard_id(F.col("shard_index")).alias("shard_id"), "input_pos", record_line().alias("value"))
    spread = lines.repartition(files, "shard_id") if files else lines.repartition("shard_id")
    spread.sortWithinPartitions("shard_id", "input_pos").select("shard_id", "value").write.partitionBy("shard_id").text(path)


def prepare(
    spark: SparkSession,
    input_path: str | Iterable[str],
    output: str,
    *,
    shard_rows: int = 4096,
    id_field: str = "sample_id",
    text_field: str = "text_window",
    max_record_chars: int = MAX_RECORD_CHARS,
    on_error: str = "fail",
    source_check: str = "stat",
    line_files: bool = False,
    input_format: str = "auto",
    spread: int | None = None,
) -> dict:
    """Write documents and shards below ``output`` and publish them with a manifest, all or nothing.

    The input is parsed once, into a table that every later step reads by
    column.  Documents are never shuffled: numbering needs only the size of each
    input split, and a shard is a range of numbers in an ordered file.  Parquet
    input is numbered while it is read (its footers hold the sizes), so it is
    written once; JSON lines are numbered in a second, narrow write.
    ``spread`` parses the lines of large compressed files in more tasks.
    ``on_error="quarantine"`` writes bad records to ``rejects`` instead of failing; the others are then numbered
    without holes, in one more narrow write.

    Every attempt writes below a folder of its own.  The manifest names it and is written last; it is what readers
    follow, and the first one stays.  What a crash leaves behind is seen by nobody.
    """
    if shard_rows < 1 or max_record_chars < 1:
        raise InvalidInput("shard_rows and max_record_chars must be at least 1")
    if on_error not in ("fail", "quarantine") or source_check not in ("stat", "digest"):
        raise InvalidInput("Unknown on_error or source_check")
    configure(spark)
    output = output.rstrip("/")
    if storage.exists(spark, f"{output}/{MANIFEST}"):
        raise FileExistsError(f"{output} exists; a job is never overwritten")
    part = storage.new_part("data")
    data = f"{output}/{part}"
    paths = [input_path] if isinstance(input_path, str) else list(input_path)
    try:
        before = source_state(spark, paths, source_check)
        records = normalize_fields(
            read_records(
                spark, paths, id_field=id_field, text_field=text_field, max_record_chars=max_record_chars,
                input_format=input_format, spread=spread,
            ),
            max_record_chars,
        )
        direct = all(is_parquet(p, input_format) for p in paths)
        facts, documents = write_documents(
            spark, records, _table_splits(spark, paths) if direct else None, data, shard_rows, on_error == "quarantine"
        )
        written = spark.read.schema(JOB_DOCUMENTS).parquet(f"{data}/{documents}")
        shards = storage.write_table(shard_table(written), f"{data}/shards")
        if line_files:
            write_shard_lines(written, f"{data}/inputs")
        total = shards.agg(F.count(F.lit(1)).alias("n"), F.sum("rows").alias("rows")).first()
        if total["rows"] != facts["good"]:
            raise IntegrityError("The shards do not hold all documents")
        shard_rows_hash = shards.select(F.sha2(F.concat_ws("\n", "id", F.col("rows").cast("string"), "digest"), 256).alias("h"), "bytes")
        if source_state(spark, paths, source_check) != before:
            raise IntegrityError("Input files changed while they were read")
        manifest = dict(
            format=JOB_FORMAT, rows=total["rows"], shards=total["n"], shard_rows=shard_rows, data=part, documents=documents,
            shards_digest=content_digest(shard_rows_hash, [], "h", "bytes").first()["digest"],
            source=dict(paths=[p.rstrip("/").rsplit("/", 1)[-1] for p in paths], check=source_check, digest=before),
            id_field=id_field, text_field=text_field, max_length=VISIBLE_TOKENS, input_scope=INPUT_SCOPE,
            rejected=facts["bad"],
        )
        write_json_record(spark, manifest, f"{output}/{MANIFEST}")
    except Exception:
        storage.discard(spark, data)
        raise
    for work in ("scan", "clean", "splits"):
        if work != documents:
            storage.remove(spark, f"{data}/{work}")
    return dict(documents=total["rows"], shards=total["n"], rejected=facts["bad"], manifest=f"{output}/{MANIFEST}")


def write_documents(
    spark: SparkSession, records: DataFrame, counted: DataFrame | None, data: str, shard_rows: int, quarantine: bool
) -> tuple[Row, str]:
    """Check the records and write the numbered documents below ``data``; how many there are, and the folder's name.

    ``counted`` has the rows of each input split if they are known beforehand.
    """
    if counted is not None:
        records = numbered(records, counted, data, shard_rows)
    scanned = storage.write_table(records, f"{data}/scan")
    clean = F.size("violations") == 0
    facts = scanned.agg(
        F.count(F.when(clean, 1)).alias("good"),
        F.count(F.when(~clean, 1)).alias("bad"),
        F.count("exact_line").alias("inexact"),
    ).first()
    if facts["bad"]:
        if not quarantine:
            shown = scanned.where(~clean).select("file_path", "sample_id", "violations").limit(5).collect()
            raise InvalidInput(f"{facts['bad']} bad records, for example {[tuple(r) for r in shown]}")
        scanned.where(~clean).drop("exact_line", "exact_layers").write.parquet(f"{data}/rejects")
    if not facts["good"]:
        raise InvalidInput("The input has no documents")
    require_unique(scanned.where(clean), ["sample_id"])
    if counted is not None and not facts["bad"] and not facts["inexact"]:
        return facts, "scan"
    if facts["bad"]:
        kept = storage.write_table(with_stored_place(scanned.drop(*PLACE, "row_bytes", "row_sha256"), clean), f"{data}/clean")
        rows = with_dense_position(kept, SPLIT, RUN_LINES).withColumn("shard_index", shard_index(F.col("input_pos"), shard_rows))
    else:
        rows = scanned if counted is not None else numbered(scanned, scanned, data, shard_rows, hashed=False)
    rows = reprint_stored(rows, facts["inexact"])
    with_content_hash(rows.select(*DOCUMENT_FIELDS, *PLACE)).write.parquet(f"{data}/documents")
    return facts, "documents"
