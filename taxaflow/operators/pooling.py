"""Pooling of token vectors (one row per token) into one vector per document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def last_pool(tokens: DataFrame, *, key: str, position: str = "pos", token: str = "token_id", vector: str = "vec",
              pad: int | None = None) -> DataFrame:
    """Vector of the last token that is not padding; of the first token if all are.

    Without a pad ID the last token counts.  Only the winning vector per map
    task is shuffled, also for a document with very many tokens.
    """
    rank = F.col(position)
    if pad is not None:
        # A pad token ranks below every real one, and earlier pads rank higher.
        rank = F.when(F.col(token) != pad, rank).otherwise(-1 - rank)
    return tokens.groupBy(key).agg(F.max_by(vector, rank).alias("pooled"))


def mean_pool(tokens: DataFrame, dim: int, *, key: str, mask: str = "mask", vector: str = "vec") -> DataFrame:
    """Mean of the unmasked vectors.

    A document without unmasked token stops the query, and so does an unmasked vector that is not ``dim`` numbers.

    Sums are combined on the map side, so a document that owns a third of all
    tokens reaches the reducer as one partial row per task.
    """
    present = F.col(mask)
    fits = (F.size(vector) == dim) & ~F.exists(vector, lambda x: x.isNull())
    checked = F.when(fits, F.col(vector)).otherwise(F.raise_error(F.lit(f"A token vector is not {dim} numbers")))
    values = F.when(present, checked).otherwise(F.array_repeat(F.lit(None).cast("double"), dim))
    unfolded = tokens.select(key, F.posexplode(values).alias("dim", "x"))
    means = unfolded.groupBy(key, "dim").agg(F.avg(F.col("x").cast("double")).alias("mean"))
    listed = means.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("dim", "mean"))).alias("m"))
    filled = F.when(F.forall("m", lambda s: s["mean"].isNotNull()), F.transform("m", lambda s: s["mean"]))
    guarded = F.coalesce(filled, F.raise_error(F.lit("A document has no unmasked token")))
    return listed.select(key, guarded.cast("array<float>").alias("pooled"))
