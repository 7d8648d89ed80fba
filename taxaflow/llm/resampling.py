"""Importance resampling: documents whose hashed n-grams look like a target's are drawn more often.

Texts are cut into words by Arrow kernels (ascii_lower, split_pattern_regex, list_flatten, dictionary_encode).
An n-gram is a pair of an (n-1)-gram's index and the index of the word behind it, i.e. a shifted copy of the
same index column; a CRC is taken once for each distinct pair and carried on from the shorter n-gram's.  The
gains of a text's buckets are fetched by ``take`` and added up by segments.

Defined results: NULL and empty texts have no words, no features and weight 0.  Rows without doc_id are judged
like a doc_id of no characters and come last among equal scores.  Repeated rows count and are drawn one by one.
An empty table gives an empty result; without target texts T and t are 0.  Only ``doc_id`` and ``text`` of a table
are read, so no other column can clash.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from taxaflow.llm.common import pieces, share, shared_value, stored

# Fixed value: what stands between words once A-Z are lower-cased.
WORD_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")  # before A-Z are lower-cased
PIECE = 4 << 20  # bytes of text handled at once; longer texts are cut between words
SCORE_STEP = 1000  # scores and gains are thousandths


@dataclass
class Features:
    """Hashed n-grams of some texts: ``buckets`` of all of them, text by text, and the text each belongs to."""

    buckets: np.ndarray
    owners: np.ndarray
    words: np.ndarray


def hashed_ngrams(texts: pa.Array, longest: int, buckets: int, carried: int = 0) -> Features:
    """Buckets of all runs of 1 to ``longest`` words.

    ``carried`` leading words belong to a part of the text handled before: runs of only such words don't count again.
    """
    split = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), WORD_BREAK)
    flat, parents = pc.list_flatten(split), pc.list_parent_indices(split)
    filled = pc.greater(pc.binary_length(flat), 0)
    encoded = pc.dictionary_encode(flat.filter(filled))
    owner = parents.filter(filled).to_numpy(zero_copy_only=False).astype(np.int64)
    index = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    vocabulary = pc.cast(encoded.dictionary, pa.binary()).to_pylist()
    begins = np.arange(len(index))
    grams, crcs = index, np.fromiter((zlib.crc32(w) for w in vocabulary), np.int64, len(vocabulary))
    found, owners = [], []
    for n in range(1, longest + 1):
        if n > 1:
            ends = begins + n - 1
            inside = ends < len(index)
            inside[inside] = owner[begins[inside]] == owner[ends[inside]]
            begins, ends, grams = begins[inside], ends[inside], grams[inside]
            pairs, grams = np.unique(grams * len(vocabulary) + index[ends], return_inverse=True)
            heads, tails = np.divmod(pairs, max(len(vocabulary), 1))
            crcs = np.fromiter(
                (zlib.crc32(b" " + vocabulary[t], int(crcs[h])) for h, t in zip(heads.tolist(), tails.tolist())), np.int64, len(pairs)
            )
        fresh = begins + n - 1 >= carried
        found.append((crcs % buckets).take(grams[fresh]) if len(crcs) else np.zeros(0, np.int64))
        owners.append(owner[begins[fresh]])
    order = np.argsort(np.concatenate(owners), kind="stable") if longest > 1 else slice(None)
    return Features(
        np.concatenate(found)[order], np.concatenate(owners)[order], np.bincount(owner[carried:], minlength=len(texts)),
    )


def _cut(text: str, longest: int) -> Iterator[tuple[str, int]]:
    """Parts of one long text that end between words, and how many words each repeats from the part before."""
    begin, tail = 0, []
    while begin < len(text):
        end = min(begin + PIECE, len(text))
        while end < len(text) and (text[end - 1].isalnum() or not text[end - 1].isascii()):
            end += 1
        part = " ".join([*tail, text[begin:end]])
        yield part, len(tail)
        tail = WORD.findall(part)[-(longest - 1):] if longest > 1 else []
        begin = end


def batch_features(texts: pa.Array, longest: int, buckets: int) -> Iterator[tuple[slice, Features]]:
    """Features of a batch in pieces of bounded size; a text longer than a piece comes in several parts, all under its row."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    for rows in pieces(sizes, PIECE):
        if rows.stop - rows.start == 1 and sizes[rows.start] > PIECE:
            for part, carried in _cut(texts[rows.start].as_py(), longest):
                yield rows, hashed_ngrams(pa.array([part], pa.large_string()), longest, buckets, carried)
        else:
            yield rows, hashed_ngrams(texts.slice(rows.start, rows.stop - rows.start), longest, buckets)


def bucket_counts(texts: DataFrame, *, longest: int, buckets: int) -> DataFrame:
    """``bucket, n``: how many n-grams of column ``text`` fall into each bucket; a task sends one row per bucket at most."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, features in batch_features(batch.column(0), longest, buckets):
                total += np.bincount(features.buckets, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["bucket", "n"])

    return texts.select(F.col("text").cast("string")).mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame, *, longest: int, buckets: int) -> np.ndarray:
    """Gain of each bucket: thousandths of the log ratio of the smoothed target and source shares.

    Collects ``buckets`` numbers of each side, whatever the tables hold.
    """
    def counts(table: DataFrame) -> list[int]:
        found = dict(map(tuple, bucket_counts(table, longest=longest, buckets=buckets).collect()))
        return [found.get(b, 0) for b in range(buckets)]

    s, t = counts(source), counts(target)
    both, wanted = sum(s) + buckets, sum(t) + buckets
    ratios = ((float(t[b] + 1) * both) / (float(s[b] + 1) * wanted) for b in range(buckets))
    return np.array([math.floor(SCORE_STEP * math.log(r)) for r in ratios], np.int64)


def with_weights(documents: DataFrame, gains: np.ndarray, *, longest: int) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of every row; weight is the floored mean gain of a text's n-grams."""
    gained, buckets = share(documents.sparkSession, gains), len(gains)
    kind = documents.schema["doc_id"].dataType.simpleString()

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared_value(gained)
        for batch in batches:
            n = batch.num_rows
            words, features, total = (np.zeros(n, np.int64) for _ in range(3))
            for rows, part in batch_features(batch.column(1), longest, buckets):
                words[rows] += part.words
                sizes = np.bincount(part.owners, minlength=rows.stop - rows.start)
                features[rows] += sizes
                filled = np.flatnonzero(sizes)
                if len(filled):
                    begins = (np.cumsum(sizes) - sizes)[filled]
                    total[rows.start + filled] += np.add.reduceat(gain.take(part.buckets), begins)
            weight = np.floor_divide(total, np.maximum(features, 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (words, features, weight))], ["doc_id", "n_words", "n_features", "weight"]
            )

    return documents.select("doc_id", F.col("text").cast("string")).mapInArrow(weigh, f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint")


def with_score(weighted: DataFrame, seed: str) -> DataFrame:
    """Add ``score``: the weight plus Gumbel noise made from doc_id, so that reruns draw the same documents."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-float(SCORE_STEP)) * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return weighted.withColumn("score", F.col("weight") + noise.cast("bigint"))


def draw(scored: DataFrame, *, least_words: int, percent: int) -> DataFrame:
    """Add ``rank`` to the rows with the highest scores, ``percent`` of 100 of those with ``least_words`` words; else NULL.

    Scores are whole numbers between about -40,000 and 60,000 (log ratios of counts below 10^15 and noise of 32 bits), so
    there are at most some 100,000 levels.  A level's first rank is the number of rows above it, summed up in two steps;
    rows are ordered inside their own level only, and rows that are equal in all columns reach it as one with a count.
    """
    able = scored.where(F.col("n_words") >= least_words)
    wanted = able.count() * percent // 100
    coarse = F.floor(F.col("score") / 1024)
    levels = able.groupBy("score").agg(F.count(F.lit(1)).alias("n")).withColumn("coarse", coarse)
    above = Window.orderBy(F.desc("coarse")).rowsBetween(Window.unboundedPreceding, -1)  # over some hundred rows
    steps = levels.groupBy("coarse").agg(F.sum("n").alias("n")).select("coarse", F.coalesce(F.sum("n").over(above), F.lit(0)).alias("higher"))
    within = Window.partitionBy("coarse").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    first = (F.col("higher") + F.coalesce(F.sum("n").over(within), F.lit(0))).cast("bigint")
    drawn = levels.join(F.broadcast(steps), "coarse").select("score", first.alias("before")).where(F.col("before") < wanted)

    keys = ["doc_id", "n_words", "n_features", "weight", "score"]
    marked = scored.join(F.broadcast(drawn.withColumn("able", F.lit(True))), ["score"], "left")
    chosen = marked.where((F.col("n_words") >= least_words) & F.col("able"))
    others = marked.where(~F.coalesce((F.col("n_words") >= least_words) & F.col("able"), F.lit(False)))
    alike = chosen.groupBy(*keys, "before").agg(F.count(F.lit(1)).alias("copies"))
    order = Window.partitionBy("score").orderBy(F.asc_nulls_last("doc_id"), "n_features", "n_words")
    last = F.col("before") + F.sum("copies").over(order.rowsBetween(Window.unboundedPreceding, 0))
    ranked = alike.withColumn("last", last).select(*keys, F.explode(F.sequence(F.col("last") - F.col("copies") + 1, F.col("last"))).alias("rank"))
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    return ranked.unionByName(others.select(*keys, F.lit(None).cast("bigint").alias("rank")))


def importance_resample(
    documents: DataFrame, target: DataFrame, *, longest: int = 1, buckets: int = 10_000, seed: str = "2024",
    least_words: int = 20, percent: int = 10,
) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every document; rank is NULL where the draw left it out."""
    gains = bucket_gains(documents, target, longest=longest, buckets=buckets)
    scored = stored(with_score(with_weights(documents, gains, longest=longest), seed), "resampling")
    return draw(scored, least_words=least_words, percent=percent)


def resampling_digest(documents: DataFrame, target: DataFrame) -> DataFrame:
    """The operator with its production parameters: ``doc_id, n_features, weight, score, rank``."""
    return importance_resample(documents, target).select("doc_id", "n_features", "weight", "score", "rank")
