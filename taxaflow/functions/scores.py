"""Numeric expressions on score arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from taxaflow.functions.arrays import once


def sigmoid(logit: Column) -> Column:
    """Single-precision sigmoid, widened so that thresholds compare as doubles."""
    return (F.lit(1.0) / (F.lit(1.0) + F.exp(-logit.cast("double")))).cast("float").cast("double")


def argmax(values: Column) -> Column:
    """0-based index of the largest value; the first one on ties."""
    return once(values, lambda v: F.array_position(v, F.array_max(v)) - F.lit(1))


def is_finite(value: Column) -> Column:
    return ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))


def all_finite(logits: Column, width: int) -> Column:
    """True if the row has exactly ``width`` logits and all of them are finite."""
    return F.coalesce((F.size(logits) == width) & F.forall(logits, is_finite), F.lit(False))
