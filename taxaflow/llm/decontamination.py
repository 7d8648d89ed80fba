"""Benchmark decontamination: a positional inverted index of the corpus, searched from rare terms.

Every benchmark window (``width`` consecutive words of an item, or a shorter item as a whole) is looked up
by its rarest term in the corpus.  The index stores the postings of those terms: document, position, and the
words around it.  Subtracting the term's offset from a posting's position gives the place where the window
would begin; the posting's words are then intersected with all other terms at their offsets (exact match) or
in any order within the surroundings (proximity match).

Only DataFrame operations run.  Documents' texts are never shuffled: terms of the benchmark are joined to
them as a broadcast table of checked size, or by a sort-merge join if the benchmark is larger than that.

NULL and empty texts have no words and no hits.  A document is a row: repeated rows get a result each, and
rows that share a doc_id are told apart by a hash of their text.  NULL item_ids take no part in the list of
items but their windows hit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from taxaflow.llm.common import ascii_lower, stored

WIDTH = 10
MOST_BROADCAST = 32 << 20  # characters in a broadcast table

# Fixed value: the characters between words, after A-Z have been lowered.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column | str) -> Column:
    value = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(ascii_lower(F.coalesce(value, F.lit(""))), GAP), "")


def is_small(df: DataFrame) -> bool:
    """Whether a stored table's values, lists included, have no more than MOST_BROADCAST characters."""
    size = F.length(F.to_json(F.struct("*")))
    return (df.agg(F.sum(size)).first()[0] or 0) <= MOST_BROADCAST


def small(df: DataFrame) -> DataFrame:
    """A stored table, marked for broadcast if it is small; else Spark joins by sorting."""
    return F.broadcast(df) if is_small(df) else df


def benchmark_windows(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """(phrase, items): distinct windows of all items with the ids of the items they stand in."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words("text").alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - width + 1, F.lit(1)))
    windows = items.select("item", F.explode(F.transform(starts, lambda s: F.slice("w", s, F.lit(width)))).alias("phrase"))
    return windows.groupBy("phrase").agg(F.collect_set("item").alias("items"))


def rarest_terms(documents: DataFrame, windows: DataFrame) -> DataFrame:
    """(phrase, items, term, offset): each window with its rarest term in the corpus and the term's offset.

    Windows with a term that no document holds are left out: they occur nowhere.
    """
    terms = windows.select("phrase", "items", F.posexplode("phrase").alias("offset", "term"))
    known = stored(terms.select("term").distinct(), "terms")
    counts = documents.select(F.explode(words("text")).alias("term")).join(small(known), "term").groupBy("term").agg(F.count("*").alias("n"))
    counted = terms.join(stored(counts, "term-counts"), "term", "left")
    first = Window.partitionBy("phrase").orderBy(F.col("n").asc_nulls_first(), "term", "offset")
    rarest = counted.withColumn("place", F.row_number().over(first)).where("place = 1 AND n IS NOT NULL")
    return rarest.select("phrase", "items", "term", "offset")


def postings(documents: DataFrame, terms: DataFrame, reach: int = WIDTH) -> DataFrame:
    """(term, doc_id, text_hash, position, around, shift): the index entries of ``terms``.

    ``around`` are up to ``reach`` - 1 words on either side of the term, which stands at index ``shift`` in it.
    """
    listed = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), words("text").alias("w"))
    entries = listed.select("doc_id", "text_hash", "w", F.posexplode("w").alias("position", "term"))
    first = F.greatest(F.col("position") - reach + 1, F.lit(0))
    around = F.slice("w", first + 1, F.col("position") - first + reach).alias("around")
    columns = ["term", "doc_id", "text_hash", "position", around, (F.col("position") - first).alias("shift")]
    if is_small(terms):
        return entries.join(F.broadcast(terms), "term").select(*columns)
    return entries.select(*columns).join(terms, "term")  # a word travels with its surroundings, not with its text


def phrase_matches(index: DataFrame, rarest: DataFrame) -> DataFrame:
    """(doc_id, text_hash, start, size, items, exact): where windows match, exactly or by proximity."""
    joined = index.join(small(rarest), "term")
    begin = F.col("shift") - F.col("offset")
    exact = (begin >= 0) & (F.slice("around", F.greatest(begin, F.lit(0)) + 1, F.size("phrase")) == F.col("phrase"))
    near = F.size(F.array_except("phrase", "around")) == 0
    found = joined.withColumn("exact", exact).where(F.col("exact") | near)
    return found.select("doc_id", "text_hash", (F.col("position") - F.col("offset")).alias("start"), F.size("phrase").alias("size"), "items", "exact")


def find_contamination(documents: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """All matches of benchmark windows in documents; see ``phrase_matches``."""
    windows = stored(benchmark_windows(benchmark.select("item_id", "text"), width), "windows")
    texts = documents.select("doc_id", "text")
    rarest = stored(rarest_terms(texts, windows), "rarest")
    terms = stored(rarest.select("term").distinct(), "rare-terms")
    index = stored(postings(texts, terms, width), "postings")
    return phrase_matches(index, rarest)


def hit_summary(matches: DataFrame) -> DataFrame:
    """(_id, _hash, n_hit, items): distinct words hit by exact matches and sorted item ids of each document."""
    exact = matches.where("exact")
    places = exact.select("doc_id", "text_hash", F.explode(F.sequence("start", F.col("start") + F.col("size") - 1)).alias("at")).distinct()
    hit = places.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n_hit"))
    items = exact.select("doc_id", "text_hash", F.explode_outer("items").alias("item")).distinct().groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_list("item")).alias("items"))
    items = items.select(F.col("doc_id").alias("i"), F.col("text_hash").alias("h"), "items")
    return hit.join(items, hit["doc_id"].eqNullSafe(items["i"]) & (hit["text_hash"] == items["h"])).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "n_hit", "items")


def contamination_digest(documents: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per document: its words, the words hit, and the items whose windows occur."""
    hits = hit_summary(stored(find_contamination(documents, benchmark, width), "matches"))
    rows = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), F.coalesce(F.regexp_count(ascii_lower(F.col("text")), F.lit(WORD)), F.lit(0)).cast("bigint").alias("n_words"))
    joined = rows.join(hits, rows["doc_id"].eqNullSafe(hits["_id"]) & (rows["text_hash"] == hits["_hash"]), "left")
    n_hit, items = F.coalesce("n_hit", F.lit(0)), F.coalesce("items", F.array().cast("array<string>"))
    return joined.select(
        "doc_id", "n_words", n_hit.cast("bigint").alias("n_hit"), F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))
