"""Readers for what the jobs leave behind: manifests, shards, receipts, predictions."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from taxaflow.errors import InvalidInput
from taxaflow.functions.json_text import strict_json, variant_type
from taxaflow.functions.locators import locator_parts, walked_locator
from taxaflow.operators.integrity import require_valid_manifest
from taxaflow.schemas import DOCUMENT, PREDICTION, SHARDS
from taxaflow.sources import storage
from taxaflow.session import configure

JOB_FORMAT = "taxaflow-job-v2"

JOB_DOCUMENTS = T.StructType([
    *DOCUMENT.fields,
    T.StructField("input_pos", T.LongType()),
    T.StructField("shard_index", T.LongType()),
    T.StructField("row_bytes", T.LongType()),
    T.StructField("row_sha256", T.StringType()),
])

RECEIPTS = T.StructType([
    T.StructField("shard_index", T.LongType()),
    T.StructField("id", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("input_digest", T.StringType()),
    T.StructField("predictions_digest", T.StringType()),
    T.StructField("seconds", T.DoubleType()),
    T.StructField("model_calls", T.LongType()),
    T.StructField("first_pos", T.LongType()),
])

MANIFEST = "manifest.json"
BINDING = "run_binding.json"
EXPORT_RECEIPT = "export_receipt.json"


@dataclass
class Job:
    """A prepared job: its manifest record, shard table and documents."""

    path: str
    manifest: dict
    manifest_sha256: str
    data: str
    shards: DataFrame
    documents: DataFrame


def write_json_record(spark: SparkSession, record: dict, path: str) -> None:
    """One JSON record in a file of its own; an existing one is never replaced."""
    storage.put_if_absent(spark, path, json.dumps(record, ensure_ascii=False, sort_keys=True, allow_nan=False) + "\n")


def _read_line(spark: SparkSession, path: str) -> str:
    lines = [r[0] for r in spark.read.text(path, wholetext=True).collect()]
    if len(lines) != 1 or not lines[0].endswith("}\n"):
        raise InvalidInput(f"Not a finished record: {path}")
    return lines[0]


def read_json_record(spark: SparkSession, path: str) -> dict:
    return json.loads(_read_line(spark, path))


def read_job(spark: SparkSession, path: str) -> Job:
    """Open a prepared job: the manifest says where its data is.  The shard table is checked against it."""
    configure(spark)
    line = _read_line(spark, f"{path}/{MANIFEST}")
    manifest = json.loads(line)
    if manifest.get("format") != JOB_FORMAT:
        raise InvalidInput("Not a job manifest of this library")
    data = f"{path}/{manifest['data']}"
    shards = spark.read.schema(SHARDS).parquet(f"{data}/shards")
    require_valid_manifest(shards, manifest["rows"])
    documents = spark.read.schema(JOB_DOCUMENTS).parquet(f"{data}/{manifest['documents']}")
    return Job(path, manifest, hashlib.sha256(line.encode()).hexdigest(), data, shards, documents)


def read_exports(spark: SparkSession, path: str) -> tuple[dict, dict[str, DataFrame]]:
    """Receipt and tables of a finished export."""
    receipt = read_json_record(spark, f"{path}/{EXPORT_RECEIPT}")
    return receipt, {name: spark.read.parquet(f"{path}/{receipt['tables']}/{name}") for name in receipt["counts"]}


def read_manifest_file(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """A manifest that is one JSON document: its record and its exploded shard list."""
    shard = "struct<id: string, path: string, rows: bigint, bytes: bigint, sha256: string>"
    schema = f"format string, rows bigint, shard_rows bigint, input_scope string, shards array<{shard}>"
    record = spark.read.schema(schema).json(path, multiLine=True)
    return record.drop("shards"), record.select(F.inline("shards"))


def commits(spark: SparkSession, output: str) -> list[str]:
    """Names of the committed parts of a run, i.e. those with a finished receipt table."""
    names = storage.children(spark, f"{output}/receipts")
    return [n for n in names if storage.is_complete(spark, f"{output}/receipts/{n}")]


def _empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty local table; unlike an empty list, Spark knows its size."""
    return spark.createDataFrame(to_arrow_schema(schema).empty_table(), schema)


def read_receipts(spark: SparkSession, output: str) -> DataFrame:
    paths = [f"{output}/receipts/{n}" for n in commits(spark, output)]
    if not paths:
        return _empty(spark, RECEIPTS)
    return spark.read.schema(RECEIPTS).parquet(*paths)


def read_predictions(spark: SparkSession, output: str) -> DataFrame:
    """Committed predictions only; parts without a receipt are not seen."""
    schema = T.StructType([*PREDICTION.fields, T.StructField("shard_index", T.LongType()), T.StructField("input_pos", T.LongType())])
    paths = [f"{output}/predictions/{n}" for n in commits(spark, output)]
    if not paths:
        return _empty(spark, schema)
    return spark.read.schema(schema).parquet(*paths)


def read_prediction_lines(spark: SparkSession, path: str) -> DataFrame:
    """Predictions stored as JSON lines.  Absent fields become NULL; a broken line stops the query."""
    configure(spark)
    fields = [f for f in PREDICTION.fields if f.name != "source_locator"]
    value = F.col("value")
    # FAILFAST would name no line; a NULL record is reported with its text.
    record = F.from_json(value, T.StructType(fields), {"mode": "PERMISSIVE"})
    lines = spark.read.text(path).where(F.length(F.trim(value)) > 0)
    parsed = lines.withColumn("v", strict_json(value)).withColumn("r", record)
    parts = locator_parts(value, F.try_variant_get(F.col("v"), "$.source_locator", "variant"))
    parsed = parsed.withColumn("l", parts)
    # Only lines that need it are sent to Python; all others go there as NULL.
    walked = walked_locator(F.when(F.col("l.reprint"), value))
    printed = F.when(F.col("l.reprint"), walked).otherwise(F.col("l.text"))
    sound = F.coalesce(variant_type(F.col("v")).startswith("OBJECT"), F.lit(False)) & F.col("r.sample_id").isNotNull()
    checked = F.when(sound, F.col("r.sample_id")).otherwise(
        F.raise_error(F.concat(F.lit("Malformed prediction record: "), F.substring(value, 1, 200)))
    )
    columns = [checked.alias("sample_id")] + [
        printed.alias(f.name) if f.name == "source_locator" else F.col(f"r.{f.name}").alias(f.name)
        for f in PREDICTION.fields[1:]
    ]
    return parsed.select(*columns)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """``files`` map of a JSON registry as rows ``path, bytes, sha256``.  A malformed registry stops the query."""
    entry = "struct<bytes: bigint, sha256: string>"
    files = F.from_json("value", f"struct<files: map<string, {entry}>>")["files"]
    listed = F.when(files.isNotNull(), files).otherwise(F.raise_error(F.lit(f"Not a registry: {path}")))
    return (
        spark.read.text(path, wholetext=True)
        .select(F.explode(listed).alias("path", "entry"))
        .select("path", "entry.bytes", "entry.sha256")
    )
