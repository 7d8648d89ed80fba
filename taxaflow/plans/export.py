"""Export job: verified predictions -> four Parquet tables and a receipt."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaflow.errors import IntegrityError
from taxaflow.operators.integrity import (
    dangling, file_inventory, missing_required, pending_shards, receipt_audit, registry_audit, require_empty,
)
from taxaflow.operators.memberships import EXPORTS
from taxaflow.plans.run import prediction_digests, verify_receipts
from taxaflow.session import configure
from taxaflow.sources import storage
from taxaflow.sources.jobs import (
    BINDING, EXPORT_RECEIPT, commits, read_job, read_json_record, read_predictions, read_receipts, write_json_record,
)


def write_exports(predictions: DataFrame, output: str) -> dict[str, int]:
    """Write the four tables; each write reads only its own columns.

    Row counts come back from the footers of the written files.
    """
    counts = {}
    for name, project in EXPORTS.items():
        counts[name] = storage.write_table(project(predictions), f"{output}/{name}", compression="zstd").count()
    return counts


def write_prediction_lines(predictions: DataFrame, path: str) -> None:
    """Predictions as JSON lines, one record per document."""
    # The locator is JSON text already: it goes into the record as it is.
    others = F.struct(*[c for c in predictions.columns if c != "source_locator"])
    locator = F.coalesce("source_locator", F.lit("null"))
    predictions.select(F.concat(F.regexp_replace(F.to_json(others, {"ignoreNullFields": "false"}), r"\}$", ""), F.lit(',"source_locator":'), locator, F.lit("}"))).write.text(path)


def dangling_memberships(memberships: DataFrame, documents: DataFrame) -> DataFrame:
    """Membership rows that point at no document."""
    return dangling(memberships, documents, "sample_id")


def publish_tables(
    spark: SparkSession, predictions: DataFrame, output: str, binding: dict, rows: int, check: Callable[[], None],
    *, check_references: bool = False,
) -> dict:
    """Write the tables and their file registry below a folder of this attempt; the receipt names it and comes last."""
    output = output.rstrip("/")
    if storage.exists(spark, f"{output}/{EXPORT_RECEIPT}"):
        raise FileExistsError(output)
    part = storage.new_part("tables")
    data = f"{output}/{part}"
    try:
        counts = write_exports(predictions, data)
        if counts["documents"] != rows:
            raise IntegrityError("Exported documents differ in number from the job")
        if check_references:
            documents = spark.read.parquet(f"{data}/documents")
            for kind in ("exact_membership", "root_membership", "review_queue"):
                require_empty(dangling_memberships(spark.read.parquet(f"{data}/{kind}"), documents), f"{kind} points nowhere")
        check()  # after the reading, so that it also holds for what was read
        file_inventory(spark, data, glob="*.parquet").write.parquet(f"{data}/files")
        write_json_record(spark, dict(binding=binding, counts=counts, tables=part), f"{output}/{EXPORT_RECEIPT}")
    except Exception:
        storage.discard(spark, data)
        raise
    return dict(counts=counts, tables=data)


def export(spark: SparkSession, job_path: str, predictions_path: str, output: str, *, check_references: bool = False) -> dict:
    """Publish the tables once every shard is complete and sound."""
    configure(spark)
    job = read_job(spark, job_path)
    binding = read_json_record(spark, f"{predictions_path}/{BINDING}")
    if binding["manifest_sha256"] != job.manifest_sha256:
        raise IntegrityError("These predictions were made from another job")
    require_empty(
        pending_shards(job.shards, read_receipts(spark, predictions_path)).select("id"), "Shards are not complete"
    )

    def check() -> None:
        verify_receipts(spark, job, predictions_path)

    predictions = read_predictions(spark, predictions_path)
    return publish_tables(spark, predictions, output, binding, job.manifest["rows"], check, check_references=check_references)


def export_increments(spark: SparkSession, predictions_path: str, output: str, *, check_references: bool = False) -> dict:
    """Publish the tables of all batches an incremental run has committed so far."""
    configure(spark)
    binding = read_json_record(spark, f"{predictions_path}/{BINDING}")
    batches = read_receipts(spark, predictions_path)
    names = commits(spark, predictions_path)
    facts = batches.agg(F.count(F.lit(1)).alias("n"), F.sum("rows").alias("rows")).first()
    if not facts["n"]:
        raise IntegrityError("Nothing was committed")

    def check() -> None:
        if commits(spark, predictions_path)[:len(names)] != names:
            raise IntegrityError("Committed batches changed")
        expected = batches.select("id", "rows", F.col("input_digest").alias("digest"))
        audit = receipt_audit(expected, batches, prediction_digests(predictions))
        require_empty(audit.where("status <> 'complete'"), "Stored predictions differ from their receipt")
        require_empty(position_faults(batches, predictions), "Positions do not follow the batches")

    predictions = read_predictions(spark, predictions_path)
    return publish_tables(spark, predictions, output, binding, facts["rows"], check, check_references=check_references)


def position_faults(batches: DataFrame, predictions: DataFrame) -> DataFrame:
    """Batches whose documents do not fill the positions their receipt gives them."""
    found = predictions.groupBy("shard_index").agg(
        F.min("input_pos").alias("low"), F.max("input_pos").alias("high"), F.sum("input_pos").alias("total")
    )
    last = F.col("first_pos") + F.col("rows") - 1
    right = (F.col("low") == F.col("first_pos")) & (F.col("high") == last) & (F.col("total") == (F.col("low") + F.col("high")) * F.col("rows") / 2)
    return batches.join(found, "shard_index", "left").where(~F.coalesce(right, F.lit(False))).select("id")


def verify(
    spark: SparkSession, path: str, registry: DataFrame | None = None, required: DataFrame | None = None
) -> dict:
    """Audit a folder against its file registry; raise on any difference.

    A published export brings its own registry of Parquet files.  With a given
    ``registry`` every file below the folder must be in it, and ``required``
    names paths it must not lack.
    """
    if registry is None:
        path = f"{path}/{read_json_record(spark, f'{path}/{EXPORT_RECEIPT}')['tables']}"
        registry = spark.read.parquet(f"{path}/files")
        found = file_inventory(spark, path, glob="*.parquet").where(~F.col("path").startswith("files/"))
    else:
        found = file_inventory(spark, path)
    if required is not None:
        require_empty(missing_required(required, registry), "Required files are not registered")
    require_empty(registry_audit(registry, found).where("status <> 'ok'"), "Files differ from their registry")
    return dict(status="passed", files=registry.count())
