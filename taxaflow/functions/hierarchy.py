"""Dotted-code hierarchy as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_ancestor(upper: Column, lower: Column) -> Column:
    """True if ``upper`` is a proper ancestor; the dot keeps A.B apart from A.BC."""
    return F.startswith(lower, F.concat(upper, F.lit(".")))


def is_related(a: Column, b: Column) -> Column:
    return is_ancestor(a, b) | is_ancestor(b, a)


def nonredundant(codes: Column) -> Column:
    """Walk the codes in order; keep one unless a kept code is its relative."""
    return F.aggregate(
        codes,
        F.array().cast("array<string>"),
        lambda kept, code: F.when(F.exists(kept, lambda k: is_related(k, code)), kept).otherwise(
            F.array_append(kept, code)
        ),
    )
