"""Scoring job: prepared documents -> predictions, resumable in committed waves."""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Callable, Iterator
from importlib import resources
from importlib.resources.abc import Traversable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxaflow.errors import IntegrityError, InvalidInput
from taxaflow.operators.decode import decode_logits
from taxaflow.operators.integrity import (
    content_digest, pending_shards, receipt_audit, require_empty, require_same_binding,
)
from taxaflow.operators.scoring import (
    MODEL_CALL, prediction_columns, predict_documents, score_documents, with_model_input,
)
from taxaflow.operators.sharding import shard_id
from taxaflow.operators.taxonomy import HeadContract
from taxaflow.plans.prepare import shard_table, with_content_hash
from taxaflow.schemas import PREDICTION
from taxaflow.session import configure
from taxaflow.sources import storage
from taxaflow.sources.jobs import (
    BINDING, Job, commits, read_job, read_json_record, read_predictions, read_receipts, write_json_record,
)

# Shards per commit: bounds the broadcast of pending shards.
WAVE_SHARDS = 65_536
# A finished task's files are put under their final path at once, not when the whole wave is done.
TASK_COMMIT = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}
PLACE = ["shard_index", "input_pos"]


def _sources(folder: Traversable, prefix: str = "") -> Iterator[tuple[str, bytes]]:
    for entry in folder.iterdir():
        name = f"{prefix}{entry.name}"
        if entry.is_dir():
            yield from _sources(entry, f"{name}/")
        elif name.endswith(".py"):
            yield name, entry.read_bytes()


def code_digest() -> str:
    """Digest of this package's sources, wherever it is installed: in a folder or in a zip file."""
    total, found = hashlib.sha256(), 0
    for name, content in sorted(_sources(resources.files("taxaflow"))):
        total.update(f"{name}:{len(content)}\n".encode() + content)
        found += 1
    if not found:
        raise InvalidInput("The sources of this package cannot be read, so a run cannot be bound to them")
    return total.hexdigest()


def bind(spark: SparkSession, output: str, binding: dict) -> None:
    """Write the binding once; afterwards only the same configuration may go on."""
    path = f"{output}/{BINDING}"
    try:
        write_json_record(spark, binding, path)
    except FileExistsError:
        require_same_binding(read_json_record(spark, path), binding)


def prediction_digests(predictions: DataFrame) -> DataFrame:
    """Rows and digest per shard, recomputed from the stored predictions."""
    names = PREDICTION.fieldNames()
    # Map entries have no order of their own.
    stable = [
        F.array_sort(F.map_entries(n)).alias(n) if n.endswith("_probabilities") else F.col(n) for n in names
    ]
    line = F.to_json(F.struct(*stable, "input_pos"))
    hashed = predictions.select("shard_index", F.sha2(line, 256).alias("h"), F.octet_length(line).alias("b"))
    return content_digest(hashed, ["shard_index"], "h", "b").select(
        "shard_index", shard_id(F.col("shard_index")).alias("id"), "rows", "digest"
    )


def _identity(df: DataFrame) -> DataFrame:
    """Which documents stand where, per shard; two narrow columns are read."""
    return df.groupBy("shard_index").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("sample_id", "input_pos")).alias("ids")
    )


def identity_faults(documents: DataFrame, predictions: DataFrame) -> DataFrame:
    """Shards whose predictions do not cover exactly their documents."""
    left = _identity(documents).withColumnsRenamed({"n": "in_rows", "ids": "in_ids"})
    right = _identity(predictions).withColumnsRenamed({"n": "out_rows", "ids": "out_ids"})
    joined = left.join(right, "shard_index", "full_outer")
    same = F.col("in_rows").eqNullSafe(F.col("out_rows")) & F.col("in_ids").eqNullSafe(F.col("out_ids"))
    return joined.where(~same)


def verify_inputs(job: Job) -> None:
    """Recompute every shard's digest from its content before any model is loaded."""
    recomputed = shard_table(with_content_hash(job.documents.drop("row_bytes", "row_sha256")))
    stored = job.shards.select("id", F.col("digest").alias("stored"))
    found = recomputed.select("id", F.col("digest").alias("found"))
    faults = stored.join(found, "id", "full_outer").where(~F.col("stored").eqNullSafe(F.col("found")))
    require_empty(faults.select("id"), "Shard content differs from the manifest")


def verify_receipts(spark: SparkSession, job: Job, output: str) -> None:
    """Completed shards must match their manifest entry and their stored predictions."""
    audit = receipt_audit(job.shards, read_receipts(spark, output), prediction_digests(read_predictions(spark, output)))
    require_empty(audit.where(~F.col("status").isin("complete", "pending")), "Stored predictions differ from their receipt")


def label(documents: DataFrame, factory: Callable, contract: HeadContract | None, *, batch_size: int,
          own_tokens: bool = False, profile=None, place: list[str] | None = None) -> DataFrame:
    """Documents -> predictions; narrow from end to end.

    Without a contract ``factory`` builds a plug-in that returns finished predictions.
    """
    place = PLACE if place is None else place
    if contract is None:
        return predict_documents(documents, factory, batch_size=batch_size, carry=tuple(place), profile=profile)
    ready = with_model_input(documents, tokenize=not own_tokens).drop("text_window", "metadata_compact")
    scored = score_documents(ready, factory, batch_size=batch_size, own_tokens=own_tokens, profile=profile)
    return prediction_columns(decode_logits(scored, contract), [*place, MODEL_CALL])


def stored_receipts(shards: DataFrame, written: DataFrame, seconds: float) -> DataFrame:
    """Receipts of shards from what now lies on disk: digests, and the model calls that were made for them."""
    found = prediction_digests(written).select("shard_index", F.col("digest").alias("predictions_digest"))
    calls = written.groupBy("shard_index").agg(F.count(F.when(F.col(MODEL_CALL), 1)).alias("model_calls"))
    return shards.join(found, "shard_index").join(calls, "shard_index").select(
        "shard_index", "id", "rows", F.col("digest").alias("input_digest"), "predictions_digest",
        F.lit(seconds * 1.0).alias("seconds"), "model_calls", F.lit(None).cast("bigint").alias("first_pos"),
    )


def commit(spark: SparkSession, output: str, name: str, shards: DataFrame, written: DataFrame, seconds: float) -> dict:
    """Publish finished predictions: receipts come last and are what readers follow."""
    receipts = storage.write_table(stored_receipts(shards, written, seconds), f"{output}/receipts/{name}")
    total = receipts.agg(F.count(F.lit(1)).alias("n"), F.sum("rows").alias("rows"), F.sum("model_calls").alias("calls")).first()
    return dict(commit=name, shards=total["n"], rows=total["rows"] or 0, model_calls=total["calls"] or 0, seconds=seconds)


def salvage(spark: SparkSession, job: Job, output: str) -> list[dict]:
    """Commit the whole shards that finished tasks of a broken-off wave have left.

    A task's files come under their final path as soon as the task is done, so after a crash they lie in a folder
    without receipts.  Shards that are there in full, document by document, are copied to a folder of their own and get
    receipts; the model is not called for them again.  The rest of the folder stays unseen, and nothing is deleted:
    another run may still be writing there.
    """
    schema = T.StructType([*PREDICTION.fields, *[T.StructField(n, T.LongType()) for n in PLACE], T.StructField(MODEL_CALL, T.BooleanType())])
    done = set(commits(spark, output))
    saved = []
    for name in storage.children(spark, f"{output}/predictions"):
        folder = f"{output}/predictions/{name}"
        if name in done or not any(f.endswith(".parquet") for f in storage.children(spark, folder)):
            continue
        begun = time.perf_counter()
        left = spark.read.schema(schema).parquet(folder)
        pending = pending_shards(job.shards, read_receipts(spark, output))
        ends = left.agg(F.min("shard_index").alias("a"), F.max("shard_index").alias("b")).first()
        if ends["a"] is None:
            continue
        inside = F.col("shard_index").between(ends["a"], ends["b"])
        faults = identity_faults(job.documents.where(inside), left).select("shard_index")
        whole = left.select("shard_index").distinct().join(faults, "shard_index", "left_anti")
        sound = storage.write_table(pending.where(inside).join(whole, "shard_index", "left_semi"), f"{output}/salvage/{uuid.uuid4().hex}")
        if sound.isEmpty():
            continue
        fresh = f"{ends['a']:012d}-{uuid.uuid4().hex[:12]}"
        written = storage.write_table(left.join(sound.select("shard_index"), "shard_index", "left_semi").select(left.columns), f"{output}/predictions/{fresh}")
        saved.append(commit(spark, output, fresh, sound, written, time.perf_counter() - begun))
    return saved


def remove_leftovers(spark: SparkSession, output: str) -> list[str]:
    """Delete predictions without receipts; only for when no run is under way."""
    done = set(commits(spark, output))
    gone = [n for n in storage.children(spark, f"{output}/predictions") if n not in done]
    for name in gone:
        storage.remove(spark, f"{output}/predictions/{name}")
    storage.remove(spark, f"{output}/salvage")
    return gone


def rounds(waves: list[Row]) -> list[list[Row]]:
    """Waves that are scored and committed together: one, then two, four and so on, as far as WAVE_SHARDS allows.

    A commit takes some Spark jobs however few shards it has, so the number of commits must not grow with the job.
    """
    found, size, begin = [], 1, 0
    while begin < len(waves):
        end, shards = begin + 1, waves[begin]["n"]
        while end < min(begin + size, len(waves)) and shards + waves[end]["n"] <= WAVE_SHARDS:
            shards += waves[end]["n"]
            end += 1
        found.append(waves[begin:end])
        begin, size = end, 2 * size
    return found


def run(
    spark: SparkSession,
    job_path: str,
    output: str,
    factory: Callable,
    contract: HeadContract | None,
    *,
    model_sha256: str,
    batch_size: int = 32,
    wave_shards: int = WAVE_SHARDS,
    own_tokens: bool = False,
    check_inputs: bool = True,
    profile=None,
    code_sha256: str | None = None,
    on_commit: Callable[[dict], None] | None = None,
) -> dict:
    """Score all shards without a receipt.  A rerun repeats no committed shard.

    A wave is a range of ``wave_shards`` shards.  The first is committed alone, then
    ever more of them at once (see :func:`rounds`).  Predictions are written first and
    receipts last; data without receipts is invisible to every reader.  If a commit
    breaks off, the next run commits the shards that its finished tasks hold in
    full (see :func:`salvage`), so a crash loses what was under way in a task.
    ``on_commit`` gets one progress record per commit.
    """
    if batch_size < 1 or wave_shards < 1:
        raise InvalidInput("batch_size and wave_shards must be at least 1")
    started = time.perf_counter()
    configure(spark)
    job = read_job(spark, job_path)
    binding = dict(
        manifest_sha256=job.manifest_sha256,
        model_sha256=model_sha256,
        contract_sha256=hashlib.sha256((contract.to_json() if contract else "").encode()).hexdigest(),
        code_sha256=code_sha256 or code_digest(),
        batch_size=batch_size,
    )
    bind(spark, output, binding)
    if check_inputs:
        verify_inputs(job)
    if commits(spark, output):
        verify_receipts(spark, job, output)
    saved = salvage(spark, job, output)
    if on_commit is not None:
        for record in saved:
            on_commit(record)

    pending = pending_shards(job.shards, read_receipts(spark, output))
    waves = (
        pending.groupBy(F.floor(F.col("shard_index") / wave_shards).alias("wave"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("rows").alias("rows"))
        .orderBy("wave")
        .collect()
    )
    scored = sum(w["rows"] for w in waves)
    outcome = dict(
        scored=scored, kept=job.manifest["rows"] - scored, salvaged=sum(r["rows"] for r in saved), model_calls=0, commits=0
    )
    for together in rounds(waves):
        begun = time.perf_counter()
        first, last = together[0]["wave"] * wave_shards, (together[-1]["wave"] + 1) * wave_shards - 1
        inside = F.col("shard_index").between(first, last)
        documents = job.documents.where(inside)
        shards = job.shards.where(inside)
        if shards.count() != sum(w["n"] for w in together):
            # At most WAVE_SHARDS numbers, or one wave's, so the broadcast is bounded.
            todo = pending.where(inside).select("shard_index")
            documents = documents.join(F.broadcast(todo), "shard_index", "left_semi")
            shards = shards.join(F.broadcast(todo), "shard_index", "left_semi")
        name = f"{first:012d}-{uuid.uuid4().hex[:12]}"
        plain = documents.drop("row_bytes", "row_sha256")
        labelled = label(plain, factory, contract, batch_size=batch_size, own_tokens=own_tokens, profile=profile)
        written = storage.write_table(labelled, f"{output}/predictions/{name}", **TASK_COMMIT)
        require_empty(identity_faults(documents, written), "Scorer output does not match its documents")
        record = commit(spark, output, name, shards, written, time.perf_counter() - begun)
        outcome["model_calls"] += record["model_calls"]
        outcome["commits"] += 1
        if on_commit is not None:
            on_commit(record)

    if not pending_shards(job.shards, read_receipts(spark, output)).isEmpty():
        raise IntegrityError("Shards are left without a receipt")
    outcome["seconds"] = time.perf_counter() - started
    if waves or saved:
        write_json_record(spark, dict(job=job.manifest_sha256, binding=binding, **outcome), f"{output}/sessions/{time.time_ns()}.json")
    return dict(state="finished" if waves or saved else "nothing_to_do", **outcome)
