"""Table schemas of the jobs."""

from __future__ import annotations

from pyspark.sql import types as T

_STRINGS = T.ArrayType(T.StringType())
_SCORES = T.MapType(T.StringType(), T.DoubleType())


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


DOCUMENT_FIELDS = [
    "sample_id", "text_window", "metadata_compact", "source_family", "source_locator", "raw_windowed",
]

# source_locator is JSON text, NULL when the record had none.
DOCUMENT = _schema(
    ("sample_id", T.StringType()),
    ("text_window", T.StringType()),
    ("metadata_compact", T.StringType()),
    ("source_family", T.StringType()),
    ("source_locator", T.StringType()),
    ("raw_windowed", T.BooleanType()),
)

DOCUMENT_STATE = _schema(
    ("document_integrity", T.StringType()),
    ("topic_structure", T.StringType()),
    ("labelability", T.StringType()),
)

PREDICTION = _schema(
    ("sample_id", T.StringType()),
    ("roots", _STRINGS),
    ("exact", _STRINGS),
    ("auxiliary_primary", T.StringType()),
    ("document_state", DOCUMENT_STATE),
    ("root_probabilities", _SCORES),
    ("exact_probabilities", _SCORES),
    ("input_tokens", T.LongType()),
    ("visible_tokens", T.LongType()),
    ("truncated", T.BooleanType()),
    ("empty_exact", T.BooleanType()),
    ("input_scope", T.StringType()),
    ("source_family", T.StringType()),
    ("source_locator", T.StringType()),
    ("stored_text_sha256", T.StringType()),
    ("model_input_sha256", T.StringType()),
    ("token_ids_sha256", T.StringType()),
    ("raw_windowed", T.BooleanType()),
)

EXPORT_DOCUMENTS = _schema(
    ("sample_id", T.StringType()),
    ("roots", _STRINGS),
    ("exact", _STRINGS),
    ("source_family", T.StringType()),
    ("source_locator_json", T.StringType()),
    ("document_state_json", T.StringType()),
    ("auxiliary_primary", T.StringType()),
    ("input_scope", T.StringType()),
    ("input_tokens", T.LongType()),
    ("visible_tokens", T.LongType()),
    ("truncated", T.BooleanType()),
    ("empty_exact", T.BooleanType()),
    ("raw_windowed", T.BooleanType()),
    ("stored_text_sha256", T.StringType()),
    ("model_input_sha256", T.StringType()),
    ("token_ids_sha256", T.StringType()),
)

MEMBERSHIP = _schema(("sample_id", T.StringType()), ("code", T.StringType()), ("score", T.DoubleType()))

REVIEW_QUEUE = _schema(("sample_id", T.StringType()), ("reasons", _STRINGS))

SHARDS = _schema(
    ("shard_index", T.LongType()),
    ("id", T.StringType()),
    ("path", T.StringType()),
    ("rows", T.LongType()),
    ("bytes", T.LongType()),
    ("digest", T.StringType()),
)

FILES = _schema(("path", T.StringType()), ("bytes", T.LongType()), ("sha256", T.StringType()))

TAXONOMY = _schema(
    ("head", T.StringType()),
    ("idx", T.IntegerType()),
    ("code", T.StringType()),
    ("root_code", T.StringType()),
    ("parent", T.StringType()),
    ("label", T.StringType()),
    ("definition", T.StringType()),
)
