"""Two helpers that keep the optimizer from computing a value more than once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed a single time, however often it is used.

    A filter pushed below a projection copies whole expressions.  A value bound
    this way is copied as one piece, and never recomputed inside a lambda.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def unfold(df: DataFrame, kept: list, items: Column, name: str) -> DataFrame:
    """One row per array item; rows with an empty array vanish.

    A plain explode makes Spark test the array's size in a pushed-down filter,
    which computes the array twice.  The outer form does not.  Items are never
    NULL, so the NULL row it makes of an empty array can be told apart.
    """
    return df.select(*kept, F.explode_outer(items).alias(name)).where(F.col(name).isNotNull())
