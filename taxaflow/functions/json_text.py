"""JSON text as column expressions: strict parsing and Python-style printing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from taxaflow.functions.arrays import once

# A run of strings and other text, then one separator.  Each match starts where
# the last one ended, so none starts inside a string.  All quantifiers are
# possessive, so long values cannot overflow the matcher's stack.
_SEPARATOR_PATTERN = r'\G((?:"(?:[^"\\]++|\\.)*+"|[^,:"]++)*+)([,:])'
# Control characters whose escape has a letter; Java prints it in upper case.
_UPPER_ESCAPES = ["0B", "0E", "0F", "1A", "1B", "1C", "1D", "1E", "1F"]
_STRING_PATTERN = r'"(?:[^"\\]++|\\.)*+"'

_HIGH = r"\\u[dD][89abAB][0-9a-fA-F]{2}"
_LOW = r"\\u[dD][c-fC-F][0-9a-fA-F]{2}"


def strict_json(text: Column) -> Column:
    """The one JSON value ``text`` holds, as VARIANT; NULL if it is anything else.

    Spark's parsers stop after the first value, so trailing text would go
    unseen.  The text is wrapped in an array before a mark made from its own
    hash: only a text that is exactly one value leaves the mark in second place.
    """
    mark = F.xxhash64(text).cast("string")
    wrapped = F.concat(F.lit("["), text, F.lit(',"'), mark, F.lit('"]'))
    parsed = F.from_json(wrapped, "array<variant>", {"allowSingleQuotes": "false"})
    return once(
        F.struct(parsed.alias("values"), mark.alias("mark")),
        lambda p: F.when(
            (F.size(p["values"]) == 2) & (F.try_variant_get(F.get(p["values"], F.lit(1)), "$", "string") == p["mark"]),
            F.get(p["values"], F.lit(0)),
        ),
    )


def variant_type(value: Column) -> Column:
    """Type name of a VARIANT, e.g. STRING, BIGINT, VOID (JSON null); NULL if absent."""
    return F.schema_of_variant(value)


def unpaired_surrogate(line: Column) -> Column:
    """True if the text holds a surrogate escape without its other half."""
    escapes = F.regexp_replace(line, r"\\\\", "")  # drop escaped backslashes first
    left = F.regexp_replace(escapes, _HIGH + _LOW, "")
    return line.rlike(r"\\u[dD][89a-fA-F]") & left.rlike(r"\\u[dD][89a-fA-F][0-9a-fA-F]{2}")


def json_string(text: Column) -> Column:
    """``text`` as a JSON string literal, non-ASCII kept, like Python prints it."""
    wrapped = F.to_json(F.struct(text.alias("t")))
    literal = once(wrapped, lambda w: _lower_escapes(F.substring(w, F.lit(6), F.length(w) - 6)))
    return F.when(text.isNotNull(), literal)


def _lower_escapes(compact: Column) -> Column:
    """Escapes of control characters in lower case; escaped backslashes are told apart."""
    def lowered(text: Column) -> Column:
        for code in _UPPER_ESCAPES:
            text = F.regexp_replace(text, rf"(?<!\\)((?:\\\\)*)\\u00{code}", rf"$1\\u00{code.lower()}")
        return text

    return once(compact, lambda c: F.when(c.contains("\\u00"), lowered(c)).otherwise(c))


def python_spacing(compact: Column) -> Column:
    """Compact JSON text as Python prints it: ", " and ": ", escapes in lower case."""
    return F.regexp_replace(_lower_escapes(compact), _SEPARATOR_PATTERN, "$1$2 ")


def has_fraction(compact: Column) -> Column:
    """True if the JSON text holds a number Java and Python may print differently."""
    return F.regexp_replace(compact, _STRING_PATTERN, "").rlike(r"[0-9][.eE]")


def colons(compact: Column) -> Column:
    """Colons outside strings, one for each key a JSON text spells out."""
    return F.length(F.regexp_replace(F.regexp_replace(compact, _STRING_PATTERN, ""), "[^:]", ""))


def negative_zero(text: Column) -> Column:
    """True if the text may hold the whole number -0, which Python prints as 0."""
    return text.rlike(r"-0(?![0-9.])")
