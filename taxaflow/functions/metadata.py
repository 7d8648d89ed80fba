"""Canonical metadata text: five allowed keys, sorted, falsy values left out."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxaflow.functions.json_text import json_string, strict_json, variant_type
from taxaflow.functions.locators import print_locator
from taxaflow.functions.text import METADATA_CHARS

# The metadata keys a model may see, and the overlay key.
ALLOWED_KEYS = ["date", "format_family", "language", "publisher", "title"]
OVERLAY_KEY = "metadata_subset"

# Where a key's value was taken from: the overlay, the record itself, or nowhere.
_OVERLAY, _TOP, _NONE = "o", "t", "-"

_REPRINTED = T.StructType([
    T.StructField("pieces", T.ArrayType(T.StringType())),
    T.StructField("locator", T.StringType()),
])


def _truthy(value: Column) -> Column:
    kind = variant_type(value)
    is_set = (
        F.when(kind == "VOID", F.lit(False))
        .when(kind == "STRING", F.try_variant_get(value, "$", "string") != "")
        .when(kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean"))
        .when(
            (kind == "BIGINT") | (kind == "DOUBLE") | kind.startswith("DECIMAL"),
            F.try_variant_get(value, "$", "double") != 0,
        )
        .when(kind == "OBJECT<>", F.lit(False))
        .when(kind.startswith("ARRAY"), F.try_variant_get(value, "$[0]", "variant").isNotNull())
        .otherwise(F.lit(True))
    )
    return value.isNotNull() & F.coalesce(is_set, F.lit(False))


def _printed(value: Column) -> Column:
    kind = variant_type(value)
    # Escaping never shortens, so characters beyond the clip cannot show up.
    text = F.substring(F.try_variant_get(value, "$", "string"), 1, METADATA_CHARS)
    return F.when(kind == "STRING", json_string(text)).when(kind.isin("BOOLEAN", "BIGINT"), text)


def _join_pieces(pieces: dict[str, Column]) -> Column:
    named = [F.concat(F.lit(f'"{key}": '), piece) for key, piece in sorted(pieces.items())]
    return F.concat(F.lit("{"), F.concat_ws(", ", *named), F.lit("}"))


def canonical_strings(values: dict[str, Column]) -> Column:
    """Canonical metadata from plain string columns, without any JSON parsing."""
    pieces = {
        key: F.when(value != "", json_string(F.substring(value, 1, METADATA_CHARS)))
        for key, value in values.items() if key in ALLOWED_KEYS
    }
    return F.substring(_join_pieces(pieces), 1, METADATA_CHARS)


def with_canonical_metadata(df: DataFrame, source: str) -> DataFrame:
    """Replace VARIANT column ``source`` by ``metadata_compact``, ``metadata_inexact`` and ``metadata_layers``.

    Strings, booleans and integers are printed natively.  ``metadata_inexact``
    marks rows with other values (fractions, nested values): those need
    :func:`exact_fields`.  ``metadata_layers`` says for each allowed key where
    its value comes from; it is empty if the metadata is no object.
    """
    kept = [c for c in df.columns if c != source]
    value = F.col(source)
    kind = variant_type(value)
    df = df.withColumn(
        source, F.when(kind == "STRING", strict_json(F.try_variant_get(value, "$", "string"))).otherwise(value)
    )
    # One lambda per step over the five keys keeps the generated code small.
    pairs = F.array(*[
        F.struct(
            F.try_variant_get(value, f"$.{k}", "variant").alias("top"),
            F.try_variant_get(value, f"$.{OVERLAY_KEY}.{k}", "variant").alias("overlay"),
        )
        for k in ALLOWED_KEYS
    ])
    df = df.select(
        *kept, F.coalesce(variant_type(value).startswith("OBJECT"), F.lit(False)).alias("_is_object"), pairs.alias("_pairs")
    )
    def choice(pair: Column) -> Column:
        def one(layer: str, value: Column) -> Column:
            return F.struct(F.lit(layer).alias("layer"), value.alias("value"))

        return (
            F.when(_truthy(pair["overlay"]), one(_OVERLAY, pair["overlay"]))
            .when(_truthy(pair["top"]), one(_TOP, pair["top"]))
            .otherwise(one(_NONE, F.lit(None).cast("variant")))
        )

    df = df.select(*kept, "_is_object", F.transform("_pairs", choice).alias("_chosen"))
    keys = F.split(F.lit(",".join(ALLOWED_KEYS)), ",")
    pieces = F.zip_with(keys, "_chosen", lambda k, c: F.concat(F.lit('"'), k, F.lit('": '), _printed(c["value"])))
    inexact = F.exists(
        "_chosen", lambda c: F.coalesce(~variant_type(c["value"]).isin("STRING", "BOOLEAN", "BIGINT"), F.lit(False))
    )
    layers = F.array_join(F.transform("_chosen", lambda c: c["layer"]), "")
    return df.select(
        *kept,
        F.when(F.col("_is_object"), _object_text(pieces)).otherwise(F.lit("")).alias("metadata_compact"),
        (F.col("_is_object") & inexact).alias("metadata_inexact"),
        F.when(F.col("_is_object"), layers).otherwise(F.lit("")).alias("metadata_layers"),
    )


def _object_text(pieces: Column) -> Column:
    """Named values as one object, clipped; NULL pieces are left out."""
    text = F.concat(F.lit("{"), F.array_join(pieces, ", "), F.lit("}"))
    return F.substring(text, 1, METADATA_CHARS)


def _printed_values(metadata: object, layers: str) -> list[str]:
    """The values that ``layers`` points at, as Python prints them."""
    holder = json.loads(metadata) if isinstance(metadata, str) else metadata
    found = []
    for key, layer in zip(ALLOWED_KEYS, layers):
        if layer != _NONE:
            value = (holder[OVERLAY_KEY] if layer == _OVERLAY else holder)[key]
            found.append(f'"{key}": {json.dumps(value, ensure_ascii=False, sort_keys=True)}')
    return found


@F.pandas_udf(_REPRINTED)
def _reprinted(lines: pd.Series, layers: pd.Series) -> pd.DataFrame:
    def one(line, layer):
        if line is None:
            return (None, None)
        record = json.loads(line)
        pieces = _printed_values(record.get("metadata_compact"), layer) if layer else None
        return (pieces, print_locator(record))

    return pd.DataFrame([one(*pair) for pair in zip(lines, layers)], columns=["pieces", "locator"])


def exact_fields(df: DataFrame) -> DataFrame:
    """Reprint the rows that kept their raw line: Python spells out the values, what is kept was decided before."""
    marked = F.col("exact_line").isNotNull()
    return (
        df.withColumn("_exact", _reprinted("exact_line", "exact_layers"))
        .withColumn("metadata_compact", F.coalesce(_object_text(F.col("_exact.pieces")), F.col("metadata_compact")))
        .withColumn("source_locator", F.when(marked, F.col("_exact.locator")).otherwise(F.col("source_locator")))
        .drop("_exact")
    )


def reprint_stored(rows: DataFrame, inexact: int) -> DataFrame:
    """:func:`exact_fields` for a stored table, given how many rows need it.

    Without such rows there is no Python stage.  Else only they pass through
    Python: the other rows are read in a branch of their own, and the branch
    with Python skips row groups that hold no raw line.
    """
    if not inexact:
        return rows
    marked = F.col("exact_line").isNotNull()
    return rows.where(~marked).unionByName(exact_fields(rows.where(marked)))
