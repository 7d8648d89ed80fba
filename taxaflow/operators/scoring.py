"""Scoring plug-in: the one stage that runs in Python, fed by Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxaflow.functions.metadata import exact_fields, with_canonical_metadata
from taxaflow.functions.json_text import strict_json
from taxaflow.functions.text import (
    INPUT_SCOPE, VISIBLE_TOKENS, document_text, hashed_token_ids, is_nonblank, reread_metadata, token_ids_sha256, words,
)
from taxaflow.schemas import PREDICTION


@dataclass
class ScoredBatch:
    """What a scorer returns for one batch, in the order it was given.

    A scorer with its own tokenizer also returns full token counts and the IDs
    of the visible tokens.
    """

    sample_ids: list[str]
    logits: np.ndarray
    input_tokens: list[int] | None = None
    token_ids: list[list[int]] | None = None


class Scorer(Protocol):
    def score(self, sample_ids: list[str], texts: list[str]) -> ScoredBatch: ...


class Predictor(Protocol):
    """A scorer that does the decoding itself: records in, prediction records out."""

    def predict(self, rows: list[dict]) -> list[dict]: ...


def with_model_input(df: DataFrame, *, tokenize: bool = True) -> DataFrame:
    """Add model input, its hashes and token columns to prepared documents.

    Upstream labels, locators and flags never enter the text: it is made from
    ``text_window`` and the cleaned ``metadata_compact`` alone.
    """
    df = df.withColumn(
        "model_input", document_text(F.col("text_window"), reread_metadata(F.col("metadata_compact")))
    )
    df = df.withColumn("stored_text_sha256", F.sha2("text_window", 256)).withColumn(
        "model_input_sha256", F.sha2("model_input", 256)
    )
    if not tokenize:
        return df
    df = df.withColumn("_tokens", words(F.col("model_input")))
    return with_token_window(
        df.withColumn("input_tokens", F.size("_tokens").cast("bigint")).withColumn(
            "token_ids_sha256", token_ids_sha256(hashed_token_ids(F.col("_tokens")))
        )
    ).drop("_tokens")


def with_token_window(df: DataFrame) -> DataFrame:
    """Visible tokens, truncation and scope from ``input_tokens``."""
    count = F.col("input_tokens")
    return (
        df.withColumn("visible_tokens", F.least(count, F.lit(VISIBLE_TOKENS)).cast("bigint"))
        .withColumn("truncated", count > VISIBLE_TOKENS)
        .withColumn("input_scope", F.lit(INPUT_SCOPE))
    )


def prepare_inputs(df: DataFrame, *, text: str = "text", metadata: str | None = "metadata") -> DataFrame:
    """Model input from raw text and raw metadata JSON, without a prepared job.

    Rows without usable text stop the query.
    """
    usable = F.coalesce(is_nonblank(F.col(text)), F.lit(False))
    checked = F.when(usable, F.col(text)).otherwise(F.raise_error(F.lit("Every row needs text that is not blank")))
    df = df.withColumn(text, checked)
    if metadata is None:
        return df.withColumn("model_input", document_text(F.col(text), F.lit("")))
    df = with_canonical_metadata(df.withColumn("_metadata", strict_json(F.col(metadata))), "_metadata")
    line = F.concat(F.lit('{"metadata_compact": '), F.col(metadata), F.lit("}"))
    marked = df.withColumn("exact_line", F.when(F.col("metadata_inexact"), line)).withColumn(
        "source_locator", F.lit(None).cast("string")
    ).withColumnRenamed("metadata_layers", "exact_layers")
    exact = exact_fields(marked)
    return exact.withColumn("model_input", document_text(F.col(text), F.col("metadata_compact"))).drop(
        "metadata_compact", "metadata_inexact", "exact_line", "exact_layers", "source_locator"
    )


def _with_fields(schema: T.StructType, drop: set[str], added: list[tuple[str, T.DataType]]) -> T.StructType:
    names = {name for name, _ in added}
    kept = [f for f in schema.fields if f.name not in drop | names]
    return T.StructType(kept + [T.StructField(name, kind) for name, kind in added])


MODEL_CALL = "model_call"


def _first_of(rows: int) -> pa.Array:
    return pa.array([True] + [False] * (rows - 1))


def score_documents(
    df: DataFrame,
    factory: Callable[[], Scorer],
    *,
    batch_size: int = 32,
    key: str = "sample_id",
    text: str = "model_input",
    own_tokens: bool = False,
    profile=None,
) -> DataFrame:
    """Replace ``text`` by ``logits``.  All other columns pass through untouched.

    The scorer is built once per task, and only when the task has a row.  The
    text crosses to Python once and does not come back.  ``profile`` is a
    ResourceProfile, for instance one GPU per task.  Column ``model_call`` is
    true in the first row of every call, so its trues are the calls made.
    """
    added: list[tuple[str, T.DataType]] = [("logits", T.ArrayType(T.FloatType())), (MODEL_CALL, T.BooleanType())]
    if own_tokens:
        added += [("input_tokens", T.LongType()), ("token_ids", T.ArrayType(T.LongType()))]
    schema = _with_fields(df.schema, {text}, added)
    passed = [f.name for f in schema.fields if f.name not in {name for name, _ in added}]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = None
        for arrow in batches:
            for start in range(0, arrow.num_rows, batch_size):
                part = arrow.slice(start, batch_size)
                if scorer is None:
                    scorer = factory()
                ids = part.column(key).to_pylist()
                result = scorer.score(ids, part.column(text).to_pylist())
                logits = np.ascontiguousarray(result.logits, dtype=np.float32)
                if list(result.sample_ids) != ids or logits.ndim != 2 or len(logits) != len(ids):
                    raise ValueError("Scorer output does not match its documents")
                offsets = np.arange(len(ids) + 1, dtype=np.int32) * logits.shape[1]
                columns = [part.column(name) for name in passed]
                columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(logits.ravel())))
                columns.append(_first_of(len(ids)))
                if own_tokens:
                    columns.append(pa.array(result.input_tokens, pa.int64()))
                    columns.append(pa.array(result.token_ids, pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema.fields])

    scored = df.mapInArrow(run, schema, profile=profile)
    if own_tokens:
        visible = F.slice("token_ids", 1, VISIBLE_TOKENS)
        scored = with_token_window(scored.withColumn("token_ids_sha256", token_ids_sha256(visible))).drop("token_ids")
    return scored


def predict_documents(
    df: DataFrame,
    factory: Callable[[], Predictor],
    *,
    batch_size: int = 32,
    carry: tuple[str, ...] = (),
    profile=None,
) -> DataFrame:
    """Predictions from a plug-in that returns finished prediction records.

    ``carry`` names columns (such as shard and position) copied from the input.
    Missing prediction fields become NULL.
    """
    carried = [f for f in df.schema.fields if f.name in carry]
    schema = T.StructType(PREDICTION.fields + carried + [T.StructField(MODEL_CALL, T.BooleanType())])
    prediction_type = T.StructType(PREDICTION.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(prediction_type)
        predictor = None
        for arrow in batches:
            for start in range(0, arrow.num_rows, batch_size):
                part = arrow.slice(start, batch_size)
                if predictor is None:
                    predictor = factory()
                rows = part.to_pylist()
                results = predictor.predict(rows)
                if [r["sample_id"] for r in results] != [r["sample_id"] for r in rows]:
                    raise ValueError("Scorer output does not match its documents")
                columns = []
                for field in target:
                    values = [r.get(field.name) for r in results]
                    if pa.types.is_map(field.type):
                        values = [None if v is None else list(v.items()) for v in values]
                    columns.append(pa.array(values, field.type))
                columns += [part.column(f.name) for f in carried] + [_first_of(len(rows))]
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema.fields])

    return df.mapInArrow(run, schema, profile=profile)


def prediction_columns(df: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Bring decoded documents into prediction column order; missing ones become NULL."""
    have = set(df.columns)

    def column(field: T.StructField) -> Column:
        if field.name == "empty_exact":
            return (F.size("exact") == 0).alias("empty_exact")
        value = F.col(field.name) if field.name in have else F.lit(None)
        return value.cast(field.dataType).alias(field.name)

    return df.select(*[column(f) for f in PREDICTION.fields], *(extra or []))
