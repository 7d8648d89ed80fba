"""Token counts: unigram segmentation of pre-tokens, computed along a trie of distinct pre-tokens.

The forward pass of a unigram tokenizer at a character depends only on what stands before it, so
pre-tokens that share a beginning share its scores.  Each task keeps the distinct pre-tokens it has met
with their counts; new ones are visited in sorted order, which walks their trie depth first: the scores of
the shared beginning are kept, only the rest is computed.  A document's count is the sum over its pre-tokens.

NULL and empty texts have 0 words and 0 tokens; repeated rows are counted each.  A character that is no
piece counts as one token per UTF-8 byte.
"""

from __future__ import annotations

import math
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from taxaflow.llm.common import as_text, share, shared_value, text_or_empty

TOKENIZER = os.environ.get("TOKENIZER_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
REMEMBERED = 400_000  # pre-tokens whose counts a task keeps; beyond it, it starts a new trie
SPACE = "▁"  # stands for the space before a word, as in the pieces


def load_pieces(path: str = TOKENIZER) -> dict[str, float]:
    """Pieces and their log probabilities.

    The public model lists its pieces by rank, not by probability; Zipf's law gives one: 1 / (rank + 1), normalised.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    norm = math.log(sum(1 / (i + 1) for i in range(len(pieces))))
    return {piece: -math.log(i + 1) - norm for i, piece in enumerate(pieces)}


class TrieCounter:
    """Counts tokens of pre-tokens, sharing forward scores between those with a common beginning."""

    def __init__(self, pieces: dict[str, float]) -> None:
        self.pieces = pieces
        self.longest = max(map(len, pieces), default=1)
        self.known: dict[str, int] = {}
        worst = min(pieces.values(), default=0.0)
        self.byte_cost = worst - 10.0  # a byte is worse than any piece

    def add(self, words: set[str]) -> None:
        """Count all pre-tokens that are not known yet: a depth-first walk over their trie."""
        pieces, longest = self.pieces, self.longest
        score, tokens = [0.0], [0]  # of each node on the path: best log probability, tokens of that segmentation
        path = ""
        for word in sorted(words):
            text = SPACE + word
            shared = len(os.path.commonprefix((path, text)))
            del score[shared + 1:], tokens[shared + 1:]
            for end in range(shared + 1, len(text) + 1):
                own = len(text[end - 1].encode("utf-8", "surrogatepass"))
                best, count = score[end - 1] + own * self.byte_cost, tokens[end - 1] + own
                for start in range(max(0, end - longest), end):
                    p = pieces.get(text[start:end])
                    if p is not None and (total := score[start] + p) > best:
                        best, count = total, tokens[start] + 1
                score.append(best)
                tokens.append(count)
            path = text
            self.known[word] = tokens[-1]

    def count(self, texts: list[str]) -> Iterator[tuple[int, int]]:
        """(words, tokens) of each text."""
        split = [text.split() for text in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        self.add({w for words in split for w in words}.difference(self.known))
        known = self.known
        for words in split:
            yield len(words), sum(map(known.__getitem__, words))


def token_counter(pieces: dict[str, float], spark: SparkSession):
    """A column function: text -> struct<n_words, n_tokens>."""
    shared = share(spark, pieces)

    @pandas_udf("struct<n_words:bigint,n_tokens:bigint>")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        counter = TrieCounter(shared_value(shared))
        for texts in batches:
            rows = []
            for begin in range(0, len(texts), 500):
                rows += counter.count([as_text(t) for t in texts.iloc[begin:begin + 500]])
            yield pd.DataFrame(rows, columns=["n_words", "n_tokens"])

    return count


def count_tokens(df: DataFrame, text: str = "text", path: str = TOKENIZER, into: str = "counted") -> DataFrame:
    """Add ``into``: words and tokens of each text."""
    counter = token_counter(load_pieces(path), df.sparkSession)
    value: Column = text_or_empty(text)
    return df.withColumn(into, counter(value))


def token_count_table(documents: DataFrame, path: str = TOKENIZER) -> DataFrame:
    counted = count_tokens(documents.select("doc_id", "text"), path=path)
    return counted.select("doc_id", F.col("counted.n_words").alias("n_words"), F.col("counted.n_tokens").alias("n_tokens"))
