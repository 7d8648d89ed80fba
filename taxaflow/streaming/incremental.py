"""Incremental scoring: new input files -> predictions, on Structured Streaming.

The checkpoint remembers which files were read; receipts remember which
batches are published.  A batch is written under its own number, so a replay
after a crash overwrites its half-done work or finds it already published.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from taxaflow.errors import DuplicateDocuments, IntegrityError, InvalidInput
from taxaflow.functions.metadata import reprint_stored
from taxaflow.operators.integrity import content_digest, require_empty
from taxaflow.operators.normalize import normalize_fields
from taxaflow.operators.sharding import shard_id
from taxaflow.operators.taxonomy import HeadContract
from taxaflow.plans.prepare import numbered, with_content_hash
from taxaflow.plans.run import bind, code_digest, identity_faults, label, stored_receipts
from taxaflow.schemas import DOCUMENT_FIELDS
from taxaflow.session import configure
from taxaflow.sources import storage
from taxaflow.sources.jobs import commits, read_receipts
from taxaflow.sources.records import MAX_RECORD_CHARS, RECORD_COLUMNS, fields_from_columns, fields_from_lines, with_scan_errors
from taxaflow.sources.tables import PLACE
from taxaflow.streaming.seen_ids import MAX_BROADCAST_IDS, add_run, merge_runs, seen_before

def batch_name(batch_id: int) -> str:
    return f"batch-{batch_id:012d}"


def process_batch(
    arrived: DataFrame, batch_id: int, output: str, factory: Callable, contract: HeadContract | None, *,
    batch_size: int, id_field: str, text_field: str, max_record_chars: int, own_tokens: bool, profile,
) -> dict | None:
    """Check, score and publish one batch; None if it is empty or already published."""
    spark = arrived.sparkSession
    name = batch_name(batch_id)
    if storage.is_complete(spark, f"{output}/receipts/{name}"):
        return None
    began = time.perf_counter()
    # Parsed once; every later step reads columns of this table.
    inbox = f"{output}/inbox/{storage.new_part(name)}"
    # A stream cannot number rows; a batch can.
    seq = F.monotonically_increasing_id()
    if PLACE in arrived.columns:
        fields = fields_from_columns(arrived.withColumn(PLACE, F.col(PLACE).withField("seq", seq)), id_field, text_field, place=PLACE)
    else:
        fields = fields_from_lines(arrived.withColumn("seq", seq), id_field, text_field)
    rows = storage.write_table(normalize_fields(fields, max_record_chars), f"{inbox}/rows")
    clean = F.size("violations") == 0
    facts = rows.agg(
        F.count(F.lit(1)).alias("rows"), F.count(F.when(~clean, 1)).alias("bad"), F.count("exact_line").alias("inexact")
    ).first()
    if facts["bad"]:
        shown = rows.where(~clean).select("file_path", "sample_id", "violations").limit(5).collect()
        raise InvalidInput(f"{facts['bad']} bad records, for example {[tuple(r) for r in shown]}")
    if not facts["rows"]:
        return None
    ids = f"{output}/ids"
    merge_runs(spark, ids, batch_id)
    repeated = seen_before(rows, ids, batch_id, small_batch=facts["rows"] <= MAX_BROADCAST_IDS)
    require_empty(repeated, "Documents arrived twice", DuplicateDocuments)
    # Positions go on where the batch before ended: the receipts are the log of it.
    earlier = read_receipts(spark, output).where(F.col("shard_index") < batch_id)
    first_pos = earlier.agg(F.coalesce(F.max(F.col("first_pos") + F.col("rows")), F.lit(0))).first()[0]
    placed = numbered(rows, rows, inbox, 1, hashed=False)
    place = reprint_stored(placed, facts["inexact"]).select(
        *DOCUMENT_FIELDS, F.lit(batch_id).cast("bigint").alias("shard_index"), (F.col("input_pos") + first_pos).alias("input_pos")
    )
    target = f"{output}/predictions/{name}"
    labelled = label(place, factory, contract, batch_size=batch_size, own_tokens=own_tokens, profile=profile)
    written = storage.write_table(labelled, target, "overwrite")
    require_empty(identity_faults(place, written), "Scorer output does not match its documents", IntegrityError)
    add_run(rows, ids, batch_id)
    inputs = content_digest(with_content_hash(place), ["shard_index"], "row_sha256", "row_bytes")
    shard = inputs.withColumn("id", shard_id(F.col("shard_index")))
    seconds = time.perf_counter() - began
    receipt = stored_receipts(shard, written, seconds).withColumn("first_pos", F.lit(first_pos).cast("bigint"))
    receipt.write.mode("overwrite").parquet(f"{output}/receipts/{name}")
    storage.remove(spark, inbox)
    return dict(batch=batch_id, rows=facts["rows"], seconds=seconds)


def score_new_files(
    spark: SparkSession,
    input_dir: str,
    output: str,
    factory: Callable,
    contract: HeadContract | None,
    *,
    model_sha256: str,
    batch_size: int = 32,
    id_field: str = "sample_id",
    text_field: str = "text_window",
    max_record_chars: int = MAX_RECORD_CHARS,
    max_files_per_trigger: int = 1000,
    table_schema: StructType | None = None,
    own_tokens: bool = False,
    profile=None,
    code_sha256: str | None = None,
    on_commit: Callable[[dict], None] | None = None,
) -> dict:
    """Score all files of a folder that were not scored before, then stop.

    Bad records and IDs seen before stop the query; nothing is dropped.  The
    binding beside the checkpoint refuses another model, code or batch size.
    Files are JSON lines (plain or compressed), or Parquet if ``table_schema``
    is given.
    """
    configure(spark)
    bind(spark, output, dict(
        manifest_sha256=hashlib.sha256(input_dir.rstrip("/").encode()).hexdigest(),
        model_sha256=model_sha256,
        contract_sha256=hashlib.sha256((contract.to_json() if contract else "").encode()).hexdigest(),
        code_sha256=code_sha256 or code_digest(),
        batch_size=batch_size,
    ))
    done: list[dict] = []

    def publish(arrived: DataFrame, batch_id: int) -> None:
        result = process_batch(
            arrived, batch_id, output, factory, contract, batch_size=batch_size, id_field=id_field,
            text_field=text_field, max_record_chars=max_record_chars, own_tokens=own_tokens, profile=profile,
        )
        if result is not None:
            done.append(result)
            if on_commit is not None:
                on_commit(result)

    reader = spark.readStream.option("maxFilesPerTrigger", str(max_files_per_trigger))
    files = reader.text(input_dir) if table_schema is None else reader.schema(table_schema).parquet(input_dir)
    hidden = files.metadataColumn("_metadata")
    where = [hidden["file_path"].alias("file_path"), hidden["file_block_start"].alias("block_start")]
    if table_schema is None:
        stream = with_scan_errors(files.select(*files.columns, *where), max_record_chars)
    else:
        used = [F.col(f"`{n}`") for n in files.columns if n in (id_field, text_field, *RECORD_COLUMNS)]
        stream = files.select(*used, F.struct(*where).alias(PLACE))
    running = (
        stream.writeStream.foreachBatch(publish)
        .option("checkpointLocation", f"{output}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()
    return dict(
        state="finished" if done else "nothing_to_do", batches=len(done), scored=sum(d["rows"] for d in done),
        committed=len(commits(spark, output)),
    )
