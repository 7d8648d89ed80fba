"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text.

Folding lower-cases, maps look-alike letters of other scripts and digits that stand for letters.  The
lexicon (words and word beginnings with weights, and exception phrases that cancel a match inside them)
is learned from a bounded number of labelled documents.  The weight found in a text, normalised by its
length, goes through a logistic curve fitted on the same documents.

NULL and empty texts score as texts without a match.  Labels that are NULL are ignored; of several
labels for one document the largest counts.  Repeated rows each get their score.  Without labels of both
classes nothing is learned and every score is 0.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from taxaflow.llm.common import as_text, give_back, lean_stage, share, shared_value, stored, text_or_empty

LABELLED_ROWS = 10_000  # most labelled documents of each class that the lexicon is learned from
LEXICON_ENTRIES = 5_000  # most lexicon entries, strongest first
LEAST_TOXIC = 5  # toxic documents an entry must occur in
LEAST_RATIO = 4.0  # how much more frequent an entry must be in toxic documents
STEMS = range(4, 9)  # lengths of word beginnings that may become entries

# Letters of other scripts that look like Latin ones, and signs written for letters.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "һ": "h", "ԁ": "d",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s",
}
_FOLD = {i: LOOKALIKES.get(chr(i), chr(i) if chr(i).isalpha() else " ") for i in range(128)}
_LOOKALIKE = re.compile(f"[{''.join(c for c in LOOKALIKES if ord(c) > 127)}]")
_SIGN = re.compile(r"[0134578@$]")
_GAP = re.compile(r"[\x00-\x60\x7B-\xBF\u2000-\u206F]+")


def fold(text: str) -> str:
    """Lower case, look-alikes replaced, every other separator one space; a space at both ends."""
    low = text.lower()
    if not low.isascii():
        low = _LOOKALIKE.sub(lambda m: LOOKALIKES[m[0]], low)
    return f" {' '.join(low.translate(_FOLD).split())} " if low.isascii() else f" {' '.join(_GAP.sub(' ', _SIGN.sub(lambda m: LOOKALIKES[m[0]], low)).split())} "




@dataclass
class Lexicon:
    """Entries (text with the spaces that bound it -> weight), exception phrases, and the curve."""

    entries: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    curve: tuple[float, float, float] = (0.0, 0.0, 0.0)

    def automaton(self) -> ahocorasick.Automaton | None:
        found = ahocorasick.Automaton()
        for text, weight in self.entries.items():
            found.add_word(text, (len(text), weight))
        for text in self.exceptions:
            found.add_word(text, (len(text), None))
        if not len(found):
            return None
        found.make_automaton()
        return found


def matched_weight(folded: str, automaton: ahocorasick.Automaton | None) -> float:
    """Sum over words of the heaviest entry that starts there, outside exception phrases."""
    if automaton is None:
        return 0.0
    best: dict[int, float] = {}
    spared: list[tuple[int, int]] = []
    for end, (length, weight) in automaton.iter(folded):
        start = end - length + 1
        if weight is None:
            spared.append((start, end))
        else:
            best[start] = max(weight, best.get(start, weight))
    if not spared:
        return sum(best.values())
    begins, ends = [], []  # of disjoint stretches of exception phrases
    for a, b in sorted(spared):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            begins.append(a)
            ends.append(b)
    return sum(w for s, w in best.items() if not ((at := bisect_right(begins, s)) and s < ends[at - 1]))


def features(texts: list[str], automaton: ahocorasick.Automaton | None) -> np.ndarray:
    """Columns: total weight (log), weight by length (log)."""
    out = np.zeros((len(texts), 2))
    for i, text in enumerate(texts):
        folded = fold(text)
        weight = matched_weight(folded, automaton)
        words = folded.count(" ") - 1
        out[i] = math.log1p(weight), math.log1p(100 * weight / max(words, 1))
    return out


def probability(x: np.ndarray, curve: tuple[float, float, float]) -> np.ndarray:
    z = np.clip(curve[0] + x @ np.array(curve[1:]), -30, 30)
    return 1 / (1 + np.exp(-z))


def fit_curve(x: np.ndarray, y: np.ndarray, steps: int = 25) -> tuple[float, float, float]:
    """Logistic regression by Newton steps with a small ridge."""
    a, w = np.column_stack([np.ones(len(x)), x]), np.zeros(3)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        hessian = (a * (p * (1 - p))[:, None]).T @ a + 1e-2 * np.eye(3)
        move = np.linalg.solve(hessian, a.T @ (y - p) - 1e-2 * w)
        w += move
        if np.abs(move).max() < 1e-8:
            break
    return float(w[0]), float(w[1]), float(w[2])


def _terms(folded: str) -> set[str]:
    """Whole words, and beginnings of words, as they can stand in the lexicon."""
    out = set()
    for word in set(folded.split()):
        out.add(f" {word} ")
        out.update(f" {word[:n]}" for n in STEMS if n < len(word))
    return out


def _small_batches(batches: Iterator[pd.DataFrame], rows: int = 200) -> Iterator[pd.DataFrame]:
    """Rows of Arrow batches, few at a time, so that counts of terms stay small in a worker."""
    for batch in batches:
        for begin in range(0, len(batch), rows):
            yield batch.iloc[begin:begin + rows]


def _term_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in _small_batches(batches):
        counts: dict[tuple[str, int], int] = Counter()
        for value, label in zip(batch["text"], batch["label"], strict=True):
            counts.update((t, int(label)) for t in _terms(fold(as_text(value))))
        yield pd.DataFrame([(t, y, n) for (t, y), n in counts.items()], columns=["term", "label", "n"])


def labelled_sample(documents: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> DataFrame:
    """(text, label) of at most ``rows`` documents of each class, first by hash of doc_id.

    Only the bounded list of ids is broadcast, so no text is shuffled.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    parts = [known.where(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for y in (0, 1)]
    return documents.select("doc_id", text_or_empty("text").alias("text")).join(F.broadcast(parts[0].unionAll(parts[1])), "doc_id").select("text", "label")


def learn_lexicon(documents: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> Lexicon:
    """Learn entries, exceptions and the curve; ``labels`` has doc_id and label (0 or 1)."""
    sample = stored(labelled_sample(documents, labels, rows), "toxicity")
    totals = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not totals.get(0) or not totals.get(1):
        return Lexicon()
    counts = sample.mapInPandas(lean_stage(_term_counts), "term string, label int, n bigint").groupBy("term").agg(
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("bad"), F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("good"))
    ratio = ((F.col("bad") + 0.5) / (totals[1] + 1)) / ((F.col("good") + 0.5) / (totals[0] + 1))
    kept = counts.where((F.col("bad") >= LEAST_TOXIC) & (ratio >= LEAST_RATIO)).select("term", F.log(ratio).alias("weight"), "bad")
    # Word-order free strength first; ties by term, so reruns agree.
    top = kept.orderBy((F.col("weight") * F.log1p("bad")).desc(), "term").limit(LEXICON_ENTRIES).collect()
    entries = {r["term"]: r["weight"] for r in top}
    lexicon = Lexicon(entries, _exceptions(sample, entries))
    shared = share(sample.sparkSession, lexicon)
    pairs = sample.mapInPandas(lean_stage(_feature_rows(shared)), "weight double, density double, label int").toPandas()
    lexicon.curve = fit_curve(pairs[["weight", "density"]].to_numpy(), pairs["label"].to_numpy())
    return lexicon


def _exceptions(sample: DataFrame, entries: dict[str, float]) -> list[str]:
    """Two-word phrases around an entry that clean documents use and toxic ones do not."""
    heads = share(sample.sparkSession, set(entries))

    def phrases(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared_value(heads)
        for batch in _small_batches(batches):
            counts: Counter = Counter()
            for value, label in zip(batch["text"], batch["label"], strict=True):
                words = fold(as_text(value)).split()
                found = set()
                for a, b in zip(words, words[1:], strict=False):
                    if not known.isdisjoint(_terms(f" {a} ")) or not known.isdisjoint(_terms(f" {b} ")):
                        found.add(f" {a} {b} ")
                counts.update((p, int(label)) for p in found)
            yield pd.DataFrame([(p, y, n) for (p, y), n in counts.items()], columns=["phrase", "label", "n"])

    counted = sample.mapInPandas(lean_stage(phrases), "phrase string, label int, n bigint").groupBy("phrase").agg(
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("bad"), F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("good"))
    spared = counted.where((F.col("bad") == 0) & (F.col("good") >= LEAST_TOXIC)).orderBy(F.col("good").desc(), "phrase").limit(LEXICON_ENTRIES)
    return [r["phrase"] for r in spared.collect()]


def _feature_rows(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = shared_value(shared).automaton()
        for batch in batches:
            x = features([as_text(t) for t in batch["text"]], automaton)
            yield pd.DataFrame({"weight": x[:, 0], "density": x[:, 1], "label": batch["label"]})

    return run


def toxicity_score(text: Column, lexicon: Lexicon, spark) -> Column:
    """Score of each text from 0 to 1."""
    shared = share(spark, lexicon)

    @pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lexicon = shared_value(shared)
        automaton = lexicon.automaton()
        for texts in batches:
            if not lexicon.entries:
                yield pd.Series(np.zeros(len(texts)))
            else:
                yield pd.Series(probability(features([as_text(t) for t in texts], automaton), lexicon.curve))
            del texts
            give_back()

    return score(text)


def held_out() -> Column:
    """Documents whose labels are never learned from; a NULL doc_id has no label, and is none of them."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def toxicity_digest(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of each document."""
    learned = labels.select("doc_id", F.col("toxic").alias("label")).where(~held_out())
    lexicon = learn_lexicon(documents, learned)
    scored = documents.select("doc_id", held_out().alias("held_out"), toxicity_score(text_or_empty("text"), lexicon, documents.sparkSession).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
