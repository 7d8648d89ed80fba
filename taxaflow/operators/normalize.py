"""Normalize records into documents and report what is wrong with each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaflow.functions.json_text import json_string
from taxaflow.functions.metadata import exact_fields
from taxaflow.functions.text import is_nonblank
from taxaflow.schemas import DOCUMENT_FIELDS
from taxaflow.session import configure
from taxaflow.sources.records import MAX_RECORD_CHARS, fields_from_columns, may_be_inexact

UNSPECIFIED = "unspecified"


def violations(max_record_chars: int = MAX_RECORD_CHARS) -> Column:
    """Everything wrong with a record, as an array of names; empty if it is fine."""
    read = F.col("scan_error").isNull()
    text = F.col("text_window")
    checks = [
        F.col("scan_error"),
        F.when(read & (F.coalesce(F.col("sample_id"), F.lit("")) == ""), "bad_sample_id"),
        F.when(read & ~is_nonblank(F.coalesce(text, F.lit(""))), "bad_text"),
        F.when(F.length(text) > max_record_chars, "text_too_long"),
        F.when(F.col("flag_error"), "bad_raw_windowed"),
        F.when(F.col("family_error"), "bad_source_family"),
        F.when(F.col("locator_error"), "bad_source_locator"),
    ]
    return F.array_compact(F.array(*checks))


def normalize_fields(fields: DataFrame, max_record_chars: int = MAX_RECORD_CHARS) -> DataFrame:
    """Field columns -> document columns plus ``violations``; other columns pass through."""
    used = {"scan_error", "family_error", "locator_error", "flag_error"}
    extra = [c for c in fields.columns if c not in used and c not in DOCUMENT_FIELDS]
    return fields.select(
        *extra,
        "sample_id", "text_window", "metadata_compact",
        F.coalesce(F.nullif(F.col("source_family"), F.lit("")), F.lit(UNSPECIFIED)).alias("source_family"),
        "source_locator", "raw_windowed",
        violations(max_record_chars).alias("violations"),
    )


def normalize(
    df: DataFrame,
    *,
    id_field: str = "sample_id",
    text_field: str = "text_window",
    max_record_chars: int = MAX_RECORD_CHARS,
    keep: list[str] | None = None,
) -> DataFrame:
    """Normalize any DataFrame of records; narrow, no shuffle.

    A Python stage is added only if the column types allow values that Spark
    and Python print differently.
    """
    configure(df.sparkSession)
    rows = normalize_fields(fields_from_columns(df, id_field, text_field, keep or []), max_record_chars)
    return exact_fields(rows) if may_be_inexact(df.schema) else rows


def record_line() -> Column:
    """A document as one JSON line, spaced like Python prints it."""
    flag = F.coalesce(F.col("raw_windowed").cast("string"), F.lit("null"))
    return F.concat(
        F.lit('{"sample_id": '), json_string(F.col("sample_id")),
        F.lit(', "text_window": '), json_string(F.col("text_window")),
        F.lit(', "metadata_compact": '), json_string(F.col("metadata_compact")),
        F.lit(', "source_family": '), json_string(F.col("source_family")),
        F.lit(', "source_locator": '), F.coalesce(F.col("source_locator"), F.lit("null")),
        F.lit(', "raw_windowed": '), flag, F.lit("}"),
    )
