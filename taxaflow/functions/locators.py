"""Source locators as JSON text: any value, keys in the order of the input, the last of equal keys, Python's spelling."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxaflow.functions.arrays import once
from taxaflow.functions.json_text import colons, has_fraction, json_string, negative_zero, python_spacing, strict_json, variant_type

FIELD = "source_locator"


def locator_parts(line: Column, locator: Column) -> Column:
    """Struct ``text, reprint`` for VARIANT ``locator``, which was parsed out of ``line``.

    VARIANT sorts object keys and keeps the last of equal ones; the line has them in order, but may repeat them, also the
    locator as a whole.  The text cut out of the line is taken only if it holds the same value and no key twice at any
    depth.  ``reprint`` marks all else, and numbers that Python spells in its own way: those need :func:`walked_locator`.
    """
    kind = variant_type(locator)
    nested = kind.startswith("OBJECT") | kind.startswith("ARRAY")
    # The line is searched once for each of these, however often they are used.
    found = F.struct(
        F.when(nested, F.get_json_object(line, f"$.{FIELD}")).alias("cut"), F.to_json(locator).alias("sorted_text"),
        F.when(~kind.isin("STRING", "VOID"), negative_zero(line)).alias("negative_zero"), kind.alias("kind"), locator.alias("locator"),
    )
    return once(found, _parts)


def _parts(found: Column) -> Column:
    """Locator text and mark from what was found in the line."""
    cut, sorted_text, kind, locator = found["cut"], found["sorted_text"], found["kind"], found["locator"]
    nested = kind.startswith("OBJECT") | kind.startswith("ARRAY")
    faithful = (F.to_json(strict_json(cut)) == sorted_text) & (colons(cut) == colons(sorted_text))
    text = F.when(kind == "STRING", json_string(F.try_variant_get(locator, "$", "string"))).when(
        kind != "VOID", python_spacing(F.coalesce(cut, sorted_text))
    )
    # VARIANT may hold 1.0 as the whole number 1, so a number with decimals is spelled again wherever it stands alone.
    alone = (kind == "DOUBLE") | kind.startswith("DECIMAL")
    own_spelling = alone | (~kind.isin("STRING", "VOID") & (has_fraction(F.coalesce(cut, sorted_text)) | found["negative_zero"]))
    reprint = (nested & ~F.coalesce(faithful, F.lit(False))) | own_spelling
    return F.struct(text.alias("text"), F.coalesce(reprint, F.lit(False)).alias("reprint"))


def print_locator(record: dict) -> str | None:
    """The locator of a parsed record; Python keeps the last of equal keys, each at its first place."""
    value = record.get(FIELD)
    # A locator that is not JSON (NaN in it) stops the job.
    return None if value is None else json.dumps(value, ensure_ascii=False, allow_nan=False)


@F.pandas_udf(T.StringType())
def walked_locator(lines: pd.Series) -> pd.Series:
    """Locator text of the given lines; NULL lines have none."""
    return pd.Series([None if line is None else print_locator(json.loads(line)) for line in lines], dtype=object)
