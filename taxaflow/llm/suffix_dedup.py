"""Suffix dedup: remove every byte that lies in a 50-byte string which an earlier document holds too.

Texts are dealt to chunks by a hash of the document.  Three passes over the chunks exchange packed arrays, never
rows for single positions:

1. Each chunk sends the distinct anchors of its windows (see ``suffixes``); buckets of anchors answer which of them
   more than one document holds.
2. Around shared anchors, each chunk sends the distinct contexts with the smallest doc_id that has them.  A bucket
   sorts the suffixes and the reversed prefixes at equal anchors by hash-compared mergesort; common
   extensions of neighbours tell which windows are equal, and each window gets its smallest doc_id.
3. Each chunk turns the answers into removed spans.

A passage that many documents hold costs a chunk one context, and a bucket one for each chunk.  An anchor with more
than HOT_RUNS runs (a frequent line shorter than a window, say, between ever different neighbours) is hot: its windows
travel one by one, as hashes dealt over all buckets by themselves, and no bucket gathers its contexts.  Exact copies
of a text are found by its digest before and only take part through the first of them; repeated rows of one doc_id
and text are judged once.

NULL texts are empty.  Rows of one doc_id never remove each other's bytes.  Rows without doc_id count as later than
all others.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaflow.llm.common import as_text, stored, text_or_empty
from taxaflow.llm.suffixes import BUFFER, SPAN, WINDOW, HashedSuffixes, Runs, anchor_runs, contexts, gram_hashes
from taxaflow.llm.wordsets import mix

CHUNK_BYTES = 1 << 21  # text of one chunk
CHUNKS_TO_BUCKET = 8
HOT_RUNS = 1 << 14  # runs around one anchor, in all chunks, that are still compared as contexts in one bucket
LAST = (1 << 63) - 1  # stands for a missing doc_id
COPY, SHARED, ANSWER, WINDOWS, HOLDERS = 0, 1, 2, 3, 4
MESSAGE = "chunk int, bucket int, kind int, data binary, doc bigint, mark bigint"
_LOW = np.uint64((1 << 32) - 1)


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of one length, as one compressed block."""
    head = np.array([len(arrays[0])], np.int64).tobytes()
    return zlib.compress(head + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays), 1)


def _unpack(data: bytes, *kinds: tuple[type, int]) -> list[np.ndarray]:
    raw = zlib.decompress(data)
    count, at = int(np.frombuffer(raw, np.int64, 1)[0]), 8
    out = []
    for kind, width in kinds:
        size = count * width
        out.append(np.frombuffer(raw, kind, size, at).reshape((count, width) if width > 1 else count))
        at += size * np.dtype(kind).itemsize
    return out


def _split(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, rows) of each bucket that has rows."""
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.diff(bucket[order])) + 1
    for rows in np.split(order, edges):
        if len(rows):
            yield int(bucket[rows[0]]), rows


def _messages(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=["chunk", "bucket", "kind", "data", "doc", "mark"], dtype=object)
    return frame.astype({"chunk": "int32", "bucket": "int32", "kind": "int32", "doc": "int64", "mark": "int64"})


class _Chunk:
    """The documents of a chunk, without exact copies of earlier ones, and what others told about them."""

    def __init__(self, documents: pd.DataFrame, told: pd.DataFrame, buckets: int) -> None:
        self.buckets = buckets
        self.number = int(documents["chunk"].iloc[0])
        copies = told[told["kind"] == COPY]
        gone = set(zip(copies["doc"], copies["mark"], strict=True))
        self.all = [as_text(t).encode("utf-8", "surrogatepass") for t in documents["text"]]
        self.is_copy = np.array([pair in gone for pair in zip(documents["doc"], documents["mark"], strict=True)], bool)
        self.rows = np.flatnonzero(~self.is_copy)
        self.texts = [self.all[i] for i in self.rows]
        self.docs = documents["doc"].to_numpy(np.int64)[self.rows]
        self.shared = told[told["kind"] == SHARED]
        self.answers = told[told["kind"] == ANSWER]
        self.holders = told[told["kind"] == HOLDERS]
        self.runs = anchor_runs(self.texts)
        self.marks = mix(self.runs.anchor)
        self.bucket = ((self.marks >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)

    def own_docs(self) -> np.ndarray:
        return self.docs[self.runs.row]

    def keep_shared(self) -> None:
        """Leave only runs around anchors that several documents hold; those around hot ones go to ``hot``."""
        told = [(np.uint64(b) << np.uint64(32), *_unpack(d, (np.uint32, 1), (np.bool_, 1))) for b, d in zip(self.shared["bucket"], self.shared["data"], strict=True)]
        known = np.concatenate([b | marks.astype(np.uint64) for b, marks, _ in told]) if told else np.zeros(0, np.uint64)
        many = np.concatenate([hot for _, _, hot in told]) if told else np.zeros(0, bool)
        key = (self.bucket.astype(np.uint64) << np.uint64(32)) | (self.marks & _LOW)
        hot = np.isin(key, known[many])
        keep = np.isin(key, known) & ~hot

        def of(which: np.ndarray) -> Runs:
            r = self.runs
            return Runs(r.row[which], r.start[which], r.count[which], r.place[which], r.anchor[which])

        self.hot, self.runs = of(hot), of(keep)
        self.marks, self.bucket = self.marks[keep], self.bucket[keep]

    def hot_windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Text and place of each window around a hot anchor, the distinct hashes of windows, windows' numbers of their hash, the smallest doc of each."""
        runs = self.hot
        ends = np.cumsum(runs.count)
        row = np.repeat(runs.row, runs.count)
        start = np.repeat(runs.start, runs.count) + np.arange(len(row)) - np.repeat(ends - runs.count, runs.count)
        hashes = np.zeros(len(row), np.uint64)
        if len(row):
            data = np.frombuffer(b"".join(self.texts), np.uint8)
            at = np.cumsum([0] + [len(t) for t in self.texts])[row] + start
            order = np.argsort(at, kind="stable")
            edges = np.searchsorted(at[order], np.arange(0, len(data) + BUFFER, BUFFER))
            for n, (low, high) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                some = order[low:high]
                if len(some):
                    hashes[some] = gram_hashes(data[n * BUFFER:(n + 1) * BUFFER + WINDOW - 1], WINDOW)[at[some] - n * BUFFER]
        distinct, number = np.unique(hashes, return_inverse=True)
        smallest = np.full(len(distinct), LAST, np.int64)
        np.minimum.at(smallest, number, self.docs[row])
        return row, start, distinct, number, smallest

    def distinct_contexts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The contexts, a 64-bit name for each, and for each distinct name: a run that has it, runs' numbers of their name, the smallest doc."""
        strings = contexts(self.texts, self.runs)
        left = (self.runs.start - self.runs.place + SPAN - 1).astype(np.uint64)
        whole = HashedSuffixes(strings).prefix[:, -1] if len(strings) else np.zeros(0, np.uint64)
        names = mix(mix(whole ^ self.marks) + left * np.uint64(64) + self.runs.count.astype(np.uint64))
        distinct, first, number = np.unique(names, return_index=True, return_inverse=True)
        smallest = np.full(len(distinct), LAST, np.int64)
        np.minimum.at(smallest, number, self.own_docs())
        return strings, distinct, first, number, smallest


def _send_anchors(buckets: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    def send(documents: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        if documents.empty:
            return _messages([])
        chunk = _Chunk(documents, told, buckets)
        out = []
        for bucket, rows in _split(chunk.bucket):
            marks, docs = chunk.marks[rows] & _LOW, chunk.own_docs()[rows]
            distinct, number, runs = np.unique(marks, return_inverse=True, return_counts=True)
            least, most = np.full(len(distinct), LAST, np.int64), np.full(len(distinct), -LAST, np.int64)
            np.minimum.at(least, number, docs)
            np.maximum.at(most, number, docs)
            out.append((chunk.number, bucket, SHARED, _pack(distinct.astype(np.uint32), least < most, runs.astype(np.uint32)), 0, 0))
        return _messages(out)

    return send


def _shared_anchors(hot_runs: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def shared(sent: pd.DataFrame) -> pd.DataFrame:
        """Of all chunks' anchors in a bucket, those that two chunks or two documents of one chunk hold, and whether they are hot."""
        parts = [_unpack(d, (np.uint32, 1), (np.bool_, 1), (np.uint32, 1)) for d in sent["data"]]
        marks, several, runs = (np.concatenate(x) for x in zip(*parts, strict=True))
        distinct, number, count = np.unique(marks, return_inverse=True, return_counts=True)
        wanted = count > 1
        wanted[number[several]] = True
        hot = np.bincount(number, runs, len(distinct)) > hot_runs
        keep, many, out, at = wanted[number], hot[number], [], 0
        for (own, _, _), chunk, bucket in zip(parts, sent["chunk"], sent["bucket"], strict=True):
            rows = slice(at, at + len(own))
            at += len(own)
            mine = keep[rows]
            if mine.any():
                out.append((chunk, bucket, SHARED, _pack(own[mine], many[rows][mine]), 0, 0))
        return _messages(out)

    return shared


def _send_contexts(buckets: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    def send(documents: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        if documents.empty or not (told["kind"] == SHARED).any():
            return _messages([])
        chunk = _Chunk(documents, told, buckets)
        chunk.keep_shared()
        strings, names, first, _, smallest = chunk.distinct_contexts()
        runs, out = chunk.runs, []
        for bucket, rows in _split(chunk.bucket[first]):
            at = first[rows]
            left = runs.start[at] - runs.place[at] + SPAN - 1
            data = _pack(runs.anchor[at], names[rows], smallest[rows], left.astype(np.uint8), runs.count[at].astype(np.uint8), strings[at])
            out.append((chunk.number, bucket, SHARED, data, 0, 0))
        _, _, windows, _, smallest = chunk.hot_windows()
        for bucket, rows in _split(((windows >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)):
            out.append((chunk.number, bucket, WINDOWS, _pack(windows[rows], smallest[rows]), 0, 0))
        return _messages(out)

    return send


def first_holders(anchor: np.ndarray, doc: np.ndarray, left: np.ndarray, count: np.ndarray, strings: np.ndarray) -> np.ndarray:
    """The smallest doc that holds each window of each context: [context, window], LAST where there is no window.

    Row i holds ``count`` windows, the first at column ``left``; the anchor stands at column SPAN - 1.
    """
    order = np.argsort(anchor, kind="stable")
    anchor, doc, left, count, strings = (x[order] for x in (anchor, doc, left, count, strings))
    group = np.cumsum(np.concatenate([[0], anchor[1:] != anchor[:-1]])) if len(anchor) else np.zeros(0, np.int64)

    def classes(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sorted order of the strings, and for each place the common beginning with the one before it (-1: other group)."""
        suffixes = HashedSuffixes(part)
        by = suffixes.sort_groups(group)
        common = np.full(len(by), -1, np.int64)
        inside = np.flatnonzero(group[by[1:]] == group[by[:-1]]) + 1
        common[inside] = suffixes.verified(by[inside - 1], by[inside])
        return by, common

    by_right, right = classes(np.ascontiguousarray(strings[:, SPAN - 1:]))
    by_left, lefts = classes(np.ascontiguousarray(strings[:, SPAN - 2::-1]))
    found = np.full((len(anchor), SPAN), LAST, np.int64)
    class_right, class_left = np.empty(len(anchor), np.int64), np.empty(len(anchor), np.int64)
    for before in range(SPAN):  # windows that begin so many bytes before their anchor
        index = SPAN - 1 - before - left
        active = np.flatnonzero((index >= 0) & (index < count))
        if not len(active):
            continue
        class_right[by_right] = np.cumsum(right < WINDOW - before)
        class_left[by_left] = np.cumsum(lefts < before) if before else 0
        key = class_right[active] * (len(anchor) + 1) + class_left[active]
        sort = np.argsort(key, kind="stable")
        new = np.concatenate([[True], key[sort][1:] != key[sort][:-1]])
        least = np.minimum.reduceat(doc[active][sort], np.flatnonzero(new))
        found[active[sort], index[active[sort]]] = least[np.cumsum(new) - 1]
    out = np.empty_like(found)
    out[order] = found
    return out


def _answer_contexts(sent: pd.DataFrame) -> pd.DataFrame:
    """Windows' first holders for each chunk's contexts and hot windows, where they are not the chunk's own."""
    single, sent = sent[sent["kind"] == WINDOWS], sent[sent["kind"] == SHARED]
    return _messages((_context_holders(sent) if len(sent) else []) + (_window_holders(single) if len(single) else []))


def _window_holders(sent: pd.DataFrame) -> list[tuple]:
    parts = [_unpack(d, (np.uint64, 1), (np.int64, 1)) for d in sent["data"]]
    names, docs = (np.concatenate(x) for x in zip(*parts, strict=True))
    distinct, number = np.unique(names, return_inverse=True)
    smallest = np.full(len(distinct), LAST, np.int64)
    np.minimum.at(smallest, number, docs)
    out, at = [], 0
    for (own, mine), chunk, bucket in zip(parts, sent["chunk"], sent["bucket"], strict=True):
        first = smallest[number[at:at + len(own)]]
        at += len(own)
        asked = first < mine
        if asked.any():
            out.append((chunk, bucket, HOLDERS, _pack(own[asked], first[asked]), 0, 0))
    return out


def _context_holders(sent: pd.DataFrame) -> list[tuple]:
    kinds = ((np.uint64, 1), (np.uint64, 1), (np.int64, 1), (np.uint8, 1), (np.uint8, 1), (np.uint8, SPAN - 1 + WINDOW))
    parts = [_unpack(d, *kinds) for d in sent["data"]]
    anchor, names, docs, left, count, strings = (np.concatenate(x) for x in zip(*parts, strict=True))
    distinct, first, number = np.unique(names, return_index=True, return_inverse=True)
    smallest = np.full(len(distinct), LAST, np.int64)
    np.minimum.at(smallest, number, docs)
    holders = first_holders(anchor[first], smallest, left[first].astype(np.int64), count[first].astype(np.int64), strings[first])
    del strings
    out, at = [], 0
    for part, chunk, bucket in zip(parts, sent["chunk"], sent["bucket"], strict=True):
        rows = slice(at, at + len(part[1]))
        at += len(part[1])
        mine, windows = holders[number[rows]], part[4].astype(np.int64)
        inside = np.arange(SPAN)[None, :] < windows[:, None]
        asked = np.flatnonzero(((mine < part[2][:, None]) & inside).any(axis=1))
        if not len(asked):
            continue
        mine, inside = mine[asked], inside[asked]
        starts = inside.copy()
        starts[:, 1:] &= mine[:, 1:] != mine[:, :-1]
        row, column = np.nonzero(starts)
        last = np.concatenate([(row[1:] != row[:-1]), [True]])
        end = np.where(last, windows[asked][row], np.concatenate([column[1:], [0]]))
        out.append((chunk, bucket, ANSWER, _pack(part[1][asked][row], mine[row, column], column.astype(np.uint8), (end - column).astype(np.uint8)), 0, 0))
    return out


def _removed(chunk: _Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, begin, end) of removed stretches of the chunk's texts."""
    chunk.keep_shared()
    _, names, _, number, smallest = chunk.distinct_contexts()
    runs, docs = chunk.runs, chunk.own_docs()
    answers = [_unpack(d, (np.uint64, 1), (np.int64, 1), (np.uint8, 1), (np.uint8, 1)) for d in chunk.answers["data"]]
    empty = [np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint8), np.zeros(0, np.uint8)]
    named, holder, column, size = (np.concatenate(x) for x in zip(*answers, strict=True)) if answers else empty
    order = np.argsort(named, kind="stable")
    named, holder, column, size = named[order], holder[order], column[order].astype(np.int64), size[order].astype(np.int64)
    begin, end = np.searchsorted(named, names[number]), np.searchsorted(named, names[number], side="right")
    told = end - begin
    # Contexts without an answer: their first holder is this chunk's own smallest doc.
    own = np.flatnonzero((told == 0) & (smallest[number] < docs))
    run = np.repeat(np.arange(len(told)), told)
    seg = np.arange(len(run)) - np.repeat(np.cumsum(told) - told, told) + np.repeat(begin, told)
    hit = holder[seg] < docs[run]
    run, seg = run[hit], seg[hit]
    start = np.concatenate([runs.start[own], runs.start[run] + column[seg]])
    length = np.concatenate([runs.count[own], size[seg]]) + WINDOW - 1
    hot_row, hot_start = _removed_hot(chunk)
    row = np.concatenate([runs.row[own], runs.row[run], hot_row])
    return row, np.concatenate([start, hot_start]), np.concatenate([start + length, hot_start + WINDOW])


def _removed_hot(chunk: _Chunk) -> tuple[np.ndarray, np.ndarray]:
    """(row, begin) of the windows around hot anchors that an earlier document holds."""
    row, start, windows, number, smallest = chunk.hot_windows()
    for data in chunk.holders["data"]:
        named, holder = _unpack(data, (np.uint64, 1), (np.int64, 1))
        np.minimum.at(smallest, np.searchsorted(windows, named), holder)
    gone = smallest[number] < chunk.docs[row]
    return row[gone], start[gone]


def _remove(buckets: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    def remove(documents: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        chunk = _Chunk(documents, told, buckets) if not documents.empty else None
        rows = []
        if chunk is not None:
            row, begin, end = _removed(chunk)
            order = np.argsort(row, kind="stable")
            row, begin, end = row[order], begin[order], end[order]
            edges = np.searchsorted(row, np.arange(len(chunk.texts) + 1))
            place = {int(r): i for i, r in enumerate(chunk.rows)}
            for i, (text, missing, doc, n) in enumerate(zip(chunk.all, documents["doc_id"].isna(), documents["doc"], documents["n"], strict=True)):
                if chunk.is_copy[i]:
                    spans = [(0, len(text))] if len(text) >= WINDOW else []
                else:
                    own = slice(edges[place[i]], edges[place[i] + 1])
                    spans = _joined(begin[own], end[own])
                at, kept = 0, []
                for b, e in spans:
                    kept.append(text[at:b])
                    at = e
                rows.append((None if missing else doc, len(text), [b for b, _ in spans], [e for _, e in spans], b"".join([*kept, text[at:]]), n))
        frame = pd.DataFrame(rows, columns=["doc_id", "n_bytes", "starts", "ends", "kept", "n"])
        return frame.astype({"doc_id": "Int64", "n_bytes": "int64", "n": "int64"})

    return remove


def _joined(begin: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Maximal stretches of overlapping or touching ones."""
    if not len(begin):
        return []
    order = np.argsort(begin, kind="stable")
    begin, reach = begin[order], np.maximum.accumulate(end[order])
    new = np.flatnonzero(np.concatenate([[True], begin[1:] > reach[:-1]]))
    return list(zip(begin[new].tolist(), reach[np.concatenate([new[1:] - 1, [len(reach) - 1]])].tolist(), strict=True))


def _collapsed(dealt: DataFrame, digests: DataFrame) -> DataFrame:
    """One row for all rows of one doc_id and text, with their number ``n``; as it is if there are none."""
    if digests.groupBy("doc", "mark", "digest").count().where("count > 1").isEmpty():
        return dealt
    keys = ["doc_id", "doc", "mark", "chunk"]
    digest = F.md5(F.col("text").cast("binary")).alias("digest")
    return stored(dealt.groupBy(*keys, digest).agg(F.first("text").alias("text"), F.sum("n").alias("n")).drop("digest"), "collapsed")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, removed spans (``starts``, ``ends``: bytes) and ``kept`` bytes of every row of docs (doc_id, text)."""
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)).alias("doc"),
        text_or_empty("text").alias("text")).withColumn("mark", F.xxhash64("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, -(-size // CHUNK_BYTES))
    buckets = max(1, -(-chunks // CHUNKS_TO_BUCKET))
    dealt = texts.withColumn("chunk", F.pmod(F.xxhash64("doc", "mark"), F.lit(chunks)).cast("int")).withColumn("n", F.lit(1).cast("bigint"))

    digests = stored(dealt.select("chunk", "doc", "mark", F.md5(F.col("text").cast("binary")).alias("digest")), "digests")
    firsts = stored(digests.groupBy("digest").agg(F.min("doc").alias("first"), F.count("*").alias("n")).where("n > 1"), "firsts")
    copies = digests.join(firsts, "digest").where("doc > first").select("chunk", F.lit(0).alias("bucket"), F.lit(COPY).alias("kind"), F.lit(None).cast("binary").alias("data"), "doc", "mark")
    copies = stored(copies.distinct(), "copies")
    dealt = _collapsed(dealt, digests)

    def of(frame: DataFrame):
        return frame.groupBy("chunk")

    anchors = of(dealt).cogroup(of(copies)).applyInPandas(_send_anchors(buckets), MESSAGE)
    shared = anchors.groupBy("bucket").applyInPandas(_shared_anchors(HOT_RUNS), MESSAGE)
    told = shared.unionByName(copies)
    sent = of(dealt).cogroup(of(told)).applyInPandas(_send_contexts(buckets), MESSAGE)
    answers = sent.groupBy("bucket").applyInPandas(_answer_contexts, MESSAGE)
    schema = "doc_id bigint, n_bytes bigint, starts array<bigint>, ends array<bigint>, kept binary, n bigint"
    found = of(dealt).cogroup(of(told.unionByName(answers))).applyInPandas(_remove(buckets), schema)
    each = F.explode(F.sequence(F.lit(1).cast("bigint"), "n"))
    return found.withColumn("n", each).drop("n")


def repeat_digest(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the digest of what is left of each document."""
    found = remove_repeats(documents)
    return found.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("bigint").alias("n_removed"),
                        F.size("starts").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
