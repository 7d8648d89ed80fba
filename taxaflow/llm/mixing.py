"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each document draws an exponential key, divided by its quality weight; within a source documents are
taken in the order of their keys until the source's word budget is used up.  A budget above the source's
size takes whole epochs first and the rest by keys.  The last document of a source is cut at its budget.

A source may hold any share of the rows: keys fall into bins, sums per (source, bin) place every bin
below, above or across the budget, and only the documents of the one bin across it are sorted, within the
bin.  Keys come from hashes of doc_id and text, so reruns agree.

NULL sources are one source, listed last.  NULL or empty texts have size 0 and take 0.  Repeated rows are
taken each.  Labels that are missing or NULL give weight 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taxaflow.llm.common import stored, word_count

WEIGHTS = (3, 1, 2)  # of sources by code point, repeating
SHARE = 1.5  # words of the mix by words of all documents
MOST_EPOCHS = 2  # how often a document may be taken
QUALITY = {1: 2.0, 0: 0.5}  # weight of a document by its quality label
BINS = 4096  # bins of keys in each source


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST_EPOCHS) -> DataFrame:
    """(source, source_size, target): words of each source in the mix, from one row per source (source, source_size).

    Targets are weight x level, but no more than ``most`` times the size.  Sources in the order of
    size / weight fill up first: the level is what the rest share when no other one fills up.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")  # one row for each source
    ranked = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(order) - 1) % len(weights) + 1).cast("double"))
    ranked = ranked.withColumn("cap", (F.col("source_size") * most).cast("double"))
    filling = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    every = Window.partitionBy()
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    after = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.sum("source_size").over(every) * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    # The first source that its level does not fill gives the level of all.
    fitting = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.struct("place", "level"))
    found = ranked.withColumn("place", F.row_number().over(filling)).withColumn("level", level).withColumn("final", F.min(fitting).over(every)["level"])
    return found.select("source", "source_size", F.coalesce(F.least("cap", F.col("weight") * F.col("final")), F.col("cap")).alias("target"))


def unit_hash(*columns: Column | str) -> Column:
    """A number in (0, 1) from the MD5 of the columns."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"), F.lit("")) for c in columns])
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def with_keys(documents: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Add size, weight and key of each document; ``labels`` has doc_id and quality."""
    sized = documents.withColumns({"size": word_count("text"), "_draw": unit_hash("doc_id", F.md5(F.coalesce("text", F.lit("")).cast("binary")))})
    if labels is None:
        quality = sized.withColumn("_quality", F.lit(None).cast("int"))
    else:
        known = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_id")).agg(F.max("quality").alias("_quality"))
        quality = sized.join(known, sized["doc_id"] == known["_id"], "left").drop("_id")
    weight = F.lit(1.0)
    for value, number in QUALITY.items():
        weight = F.when(F.col("_quality") == value, number).otherwise(weight)
    return quality.withColumn("_key", -F.log(F.col("_draw")) / weight).drop("_quality", "_draw")


def mix_sources(keyed: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST_EPOCHS) -> DataFrame:
    """Add source_size, target and taken to documents with source, doc_id, size and _key."""
    binned = keyed.withColumn("_bin", F.floor((1 - F.exp(-F.col("_key"))) * BINS).cast("int"))
    bins = binned.groupBy("source", "_bin").agg(F.sum("size").alias("_words"))
    targets = source_targets(bins.groupBy("source").agg(F.sum("_words").alias("source_size")), weights, share, most)
    by_key = Window.partitionBy("source").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    placed = bins.join(targets, bins["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    placed = placed.withColumn("_epochs", F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(most))).otherwise(F.lit(0)).cast("bigint"))
    placed = placed.withColumn("_rest", F.round(F.col("target") - F.col("_epochs") * F.col("source_size")).cast("bigint"))
    placed = placed.withColumn("_before", F.coalesce(F.sum("_words").over(by_key), F.lit(0)).cast("bigint"))
    placed = placed.select(F.col("source").alias("_source"), F.col("_bin").alias("_place"), "source_size", "target", "_epochs", "_rest", "_before", "_words")
    joined = binned.join(placed, binned["source"].eqNullSafe(placed["_source"]) & (binned["_bin"] == placed["_place"])).drop("_source", "_place")
    across = (F.col("_before") < F.col("_rest")) & (F.col("_before") + F.col("_words") > F.col("_rest"))
    in_bin = Window.partitionBy("source", "_bin").orderBy("_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    sorted_in = joined.where(across).withColumn("_inner", F.coalesce(F.sum("size").over(in_bin), F.lit(0)))
    cut = F.least(F.greatest(F.col("_rest") - F.col("_before") - F.col("_inner"), F.lit(0)), F.col("size"))
    whole = F.when(F.col("_before") + F.col("_words") <= F.col("_rest"), F.col("size")).otherwise(0)
    helpers = ("_bin", "_epochs", "_rest", "_before", "_words", "_key")
    plain = joined.where(~across).withColumn("taken", (F.col("_epochs") * F.col("size") + whole).cast("bigint"))
    edge = sorted_in.withColumn("taken", (F.col("_epochs") * F.col("size") + cut).cast("bigint")).drop("_inner")
    return plain.drop(*helpers).unionByName(edge.drop(*helpers))


def mix_digest(documents: DataFrame, labels: DataFrame | None) -> DataFrame:
    """doc_id, size, source_size, target and taken of every document."""
    keyed = stored(with_keys(documents.select("doc_id", "source", "text"), labels).drop("text"), "mixing")
    return mix_sources(keyed).select("doc_id", "size", "source_size", "target", "taken")
