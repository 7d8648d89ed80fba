"""URL filters: rules first, then naive Bayes over segmented host and path words.

Concatenated host names are split by a unigram Viterbi search whose word frequencies come from the
whole corpus; a multinomial naive Bayes model scores the words.  Its labelled rows are the urls
themselves: a host that holds a seed word is an example of what to block, every other host of what to
allow.  The model learns from the words beside the one that gave the label: a seed word is counted only if
the host's other words are labelled without it, and the strong ones have a few prior counts besides.  So a
verdict can differ from the seed list.  Counts go to a fixed number of hashed bins, so the model has the
same size for any corpus.

NULL urls and urls without "://" have an empty host and path, match no rule and score 0 (allow).
Repeated rows are judged each; host and path keep their characters, only A-Z of the host are lowered.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from taxaflow.llm.common import ascii_lower, share, shared_value

VOCABULARY = 50_000  # most words the segmenter knows, most frequent first
LONGEST_WORD = 20
BINS = 1 << 18  # hashed bins of the naive Bayes model
CACHE = 50_000  # segmented names that a task remembers

# Words of hosts that mark a url as an example to block; fixed values.
SEEDS = (
    "ads", "adult", "bet", "bets", "betting", "casino", "cheap", "click", "deal", "escort", "farm", "free", "gambling",
    "loan", "loans", "pills", "poker", "porn", "sex", "spam", "track", "tracker", "viagra", "win", "xxx",
)
# Two of these must meet in a host, unless the word stands in STRONG.
STRONG = ("adult", "ads", "bets", "betting", "casino", "escort", "gambling", "pills", "poker", "porn", "sex", "spam", "tracker", "viagra", "xxx")
SEED_COUNT = 5  # prior examples to block in which each strong seed is held to have been seen


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules of the query.
RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def matched_rule(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """struct<text, verdict> of the longest rule that fits, else NULL."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):  # the longest is asked first, so it comes last here
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(out)
    return out


class Segmenter:
    """Splits a name into the likeliest words under unigram frequencies."""

    def __init__(self, counts: dict[str, int]) -> None:
        self.total = sum(counts.values()) + 1
        self.cost = {word: -math.log(n / self.total) for word, n in counts.items()}
        self.known: dict[str, list[str]] = {}

    def _unknown(self, length: int) -> float:
        """Cost of a word that is not in the vocabulary: dearer than any known one, and more so with length."""
        return math.log(self.total) + 2.3 * length

    def split(self, name: str) -> list[str]:
        if name in self.known:
            return self.known[name]
        best, back = [0.0], [0]
        for end in range(1, len(name) + 1):
            choices = ((best[start] + self.cost.get(name[start:end], self._unknown(end - start)), start) for start in range(max(0, end - LONGEST_WORD), end))
            cost, start = min(choices)
            best.append(cost)
            back.append(start)
        words, at = [], len(name)
        while at:
            words.append(name[back[at]:at])
            at = back[at]
        words.reverse()
        if len(self.known) >= CACHE:
            self.known.clear()
        self.known[name] = words
        return words


_RUNS = re.compile(r"[a-z]+|[0-9]+")


def tokens_of(host: str, path: str, segmenter: Segmenter) -> tuple[list[str], list[str]]:
    """Host words and path words; runs of digits are one token each."""
    def words(text: str) -> list[str]:
        out: list[str] = []
        for run in _RUNS.findall(text.lower()):
            out += ["<number>"] if run[0].isdigit() else segmenter.split(run)
        return out

    return words(host), words(path)


def _bin(token: str) -> int:
    return zlib.crc32(token.encode()) % BINS


def bins_of(host_words: list[str], path_words: list[str]) -> list[int]:
    return [_bin("h:" + w) for w in host_words] + [_bin("p:" + w) for w in path_words]


def seeded(host_words: list[str]) -> bool:
    found = set(host_words) & set(SEEDS)
    return bool(found & set(STRONG)) or len(found) > 1


def witnesses(host_words: list[str]) -> list[str]:
    """The words of a seeded host that are examples to block: all but seeds on which the label itself rests."""
    return [w for w in host_words if w not in SEEDS or seeded([v for v in host_words if v != w])]


def word_frequencies(texts: DataFrame, size: int = VOCABULARY) -> dict[str, int]:
    """The most frequent a-z words of a text column, counted over all rows; the seeds are always known."""
    words = texts.select(F.explode(F.split(F.lower(F.col(texts.columns[0])), "[^a-z]+")).alias("word"))
    counts = words.where(F.length("word").between(1, LONGEST_WORD)).groupBy("word").agg(F.count("*").alias("n"))
    top = {r["word"]: r["n"] for r in counts.orderBy(F.col("n").desc(), "word").limit(size).collect()}
    common = max(10, sum(top.values()) // 20_000)
    return top | {seed: max(top.get(seed, 0), common) for seed in SEEDS}


class HostModel:
    """Multinomial naive Bayes over hashed tokens: bins x (allow, block)."""

    def __init__(self, counts: np.ndarray, rows: np.ndarray) -> None:
        used = max(1, int(counts.any(axis=1).sum()))
        share = np.log((counts + 0.1) / (counts.sum(axis=0) + 0.1 * used))
        self.odds = share[:, 1] - share[:, 0]
        self.prior = math.log((rows[1] + 1) / (rows[0] + 1))

    def score(self, bins: list[int]) -> float:
        z = self.prior + float(self.odds[bins].sum()) if bins else -30.0
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def train_model(urls: DataFrame, segmenter: Segmenter) -> HostModel:
    """Count tokens by class over all urls (columns host, path); partial counts are added up before the shuffle."""
    shared = share(urls.sparkSession, segmenter)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared_value(shared)
        counts = np.zeros((BINS + 1, 2), np.int64)
        for batch in batches:
            for host, path in zip(batch["host"], batch["path"], strict=True):
                if not host:
                    continue
                host_words, path_words = tokens_of(host, path, own)
                label = int(seeded(host_words))
                np.add.at(counts[:, label], bins_of(witnesses(host_words) if label else host_words, path_words), 1)
                counts[BINS, label] += 1
        used = np.flatnonzero(counts.any(axis=1))
        yield pd.DataFrame({"bin": used, "allow": counts[used, 0], "block": counts[used, 1]})

    parts = urls.mapInPandas(count, "bin bigint, allow bigint, block bigint")
    table = np.zeros((BINS + 1, 2))
    for r in parts.groupBy("bin").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block")).collect():  # BINS + 1 rows at most
        table[r["bin"]] = r["allow"], r["block"]
    table[[_bin("h:" + seed) for seed in STRONG], 1] += SEED_COUNT
    return HostModel(table[:BINS], table[BINS])


def judge_urls(df: DataFrame, segmenter: Segmenter, model: HostModel, url: str = "url") -> DataFrame:
    """Add host, path, rule, verdict, score and host_words of each url."""
    shared = share(df.sparkSession, (segmenter, model))

    @pandas_udf("struct<score:double,host_words:array<string>>")
    def judged(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        own, model = shared_value(shared)
        for hosts, paths in batches:
            rows = []
            for host, path in zip(hosts, paths, strict=True):
                host_words, path_words = tokens_of(host, path, own)
                rows.append((model.score(bins_of(host_words, path_words)), host_words))
            yield pd.DataFrame(rows, columns=["score", "host_words"])

    parsed = df.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    ruled = parsed.withColumn("_rule", matched_rule(F.col("host"), F.col("path"))).withColumn("_judged", judged("host", "path"))
    by_model = F.when(F.col("_judged.score") >= 0.5, "block").otherwise("allow")
    return ruled.withColumns({"rule": F.col("_rule.rule"), "verdict": F.coalesce(F.col("_rule.verdict"), by_model), "score": F.col("_judged.score"), "host_words": F.col("_judged.host_words")}).drop("_rule", "_judged")


def url_verdicts(pages: DataFrame) -> DataFrame:
    """Fit on all pages, then judge all their urls."""
    segmenter = Segmenter(word_frequencies(pages.select("html")))
    urls = pages.select("page_id", "url")
    model = train_model(urls.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")), segmenter)
    return judge_urls(urls, segmenter, model).select("page_id", "host", "path", "rule", "verdict", "score", "host_words")
