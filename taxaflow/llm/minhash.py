"""MinHash near-duplicates: an inverted join over the coordinates of signatures.

Documents with equal shingle sets form a class; only classes are compared.  A coordinate is made of ROWS min-hashes.
A class is posted under its (coordinate, value) pairs; a linked pair collides in SHARED of COORDINATES values at
least, but for one case in a million, so the most frequent values of a class need no posting (prefix filter) and
only lists with two members or more are read (skip merging).  Where two classes meet, their collisions are counted
on whole signatures: SHARED coordinates and ``needed`` single min-hashes must agree.  What is left is confirmed
on full sets.

Only components are asked for, so a list is not expanded into all pairs.  First every member is compared with pivots
of its lists that stand in other components.  Lists that still span several components are cut into blocks of BLOCK
members by size of set, and blocks are compared with array code in two passes: the first one, on signatures, tells which
members of a list may be linked with some other; the second one compares the full sets of these, again in blocks, and hands
on links alone.  So what is moved follows the members of lists, not their pairs.  A pair that meets in several lists is
judged in the one of its lowest common coordinate, by the tokens that both are posted under.  Left out are only pairs
within one component and pairs of sets whose sizes alone rule out a link.

A text without words has an empty set and is linked with nothing; NULL is such a text.  Rows of one doc_id are one
document.  Rows without doc_id are linked with nothing, have no component_id, and are kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import IntegerType

from taxaflow.llm.common import PIECE_BYTES, as_text, lean, lean_stage, pieces, small_batches, stored, text_or_empty
from taxaflow.llm.components import connected_components
from taxaflow.llm.wordsets import mix, shingle_sets

COORDINATES = 32
ROWS = 4  # min-hashes in one coordinate
SHARED = 2  # coordinates that a pair must share
MISSED = 1e-6  # most probability that a pair exactly at the threshold agrees in too few min-hashes
PIVOTS = 2  # pivots a class is compared with in a round, most alike ones first
ROUNDS = 1  # rounds of pivots before what is left is compared in blocks
BLOCK = 256  # members of a list that are compared at once with as many others
BLOCK_SHINGLES = 1 << 16  # and about how many shingles they have, where full sets are compared

_MIN_HASHES = COORDINATES * ROWS
_FACTORS = mix(np.arange(1, _MIN_HASHES + 1, dtype=np.uint64)) | np.uint64(1)
_SUM_SEEDS = (0x5851F42D4C957F2D, 0x14057B7EF767814F)
_MASKS = mix(np.arange(1001, _MIN_HASHES + 1001, dtype=np.uint64))


def matches_needed(similarity: float, coordinates: int = _MIN_HASHES, missed: float = MISSED) -> int:
    """The largest number of agreements that a pair of this similarity reaches but for ``missed``."""
    below = 0.0
    for count in range(coordinates + 1):
        below += math.comb(coordinates, count) * similarity**count * (1 - similarity) ** (coordinates - count)
        if below > missed:
            return max(count, 1)
    return coordinates


def signatures(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Set sizes, two 64-bit sums that tell sets apart, a token for each coordinate's value, and one byte for each
    min-hash; row i is text i.  The lowest bits of a token are its coordinate."""
    sizes = np.zeros(len(texts), np.int64)
    sums = np.zeros((len(texts), 2), np.uint64)
    tokens = np.zeros((len(texts), COORDINATES), np.uint64)
    marks = np.zeros((len(texts), _MIN_HASHES), np.uint8)
    for part in pieces([len(t) for t in texts]):
        hashes, counts = shingle_sets(texts[part], width)
        sizes[part] = counts
        rows = np.flatnonzero(counts) + part.start
        if not len(rows):
            continue
        begin = (np.cumsum(counts) - counts)[counts > 0]
        for k, seed in enumerate(_SUM_SEEDS):
            sums[rows, k] = np.add.reduceat(mix(hashes ^ np.uint64(seed)), begin)
        for k in range(_MIN_HASHES):
            least = mix(np.minimum.reduceat((hashes ^ _MASKS[k]) * _FACTORS[k], begin))
            tokens[rows, k // ROWS] = mix(tokens[rows, k // ROWS] ^ least)
            marks[rows, k] = least >> np.uint64(56)
    return sizes, sums, (tokens & ~np.uint64(COORDINATES - 1)) | np.arange(COORDINATES, dtype=np.uint64), marks


def _sketcher(width: int):
    @pandas_udf("struct<n:bigint,f1:bigint,f2:bigint,tokens:array<bigint>,sig:binary>")
    @lean
    def sketch(texts: pd.Series) -> pd.DataFrame:
        sizes, sums, tokens, marks = signatures([as_text(t) for t in texts], width)
        return pd.DataFrame({"n": sizes, "f1": sums[:, 0].view(np.int64), "f2": sums[:, 1].view(np.int64), "tokens": list(tokens.view(np.int64)), "sig": [m.tobytes() for m in marks]})

    return sketch


def _common(sets: list[np.ndarray], first: list[int], second: list[int]) -> np.ndarray:
    """Size of the intersection of sets[first[i]] and sets[second[i]], for each i; each element is numbered once."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    numbers = np.unique(np.concatenate(sets), return_inverse=True)[1]
    start = np.cumsum(sizes) - sizes
    marked = np.zeros(sizes.sum() + 1, bool)
    a, b = np.array(first), np.array(second)
    order = np.argsort(b, kind="stable")
    out = np.zeros(len(a), np.int64)
    for rows in np.split(order, np.flatnonzero(np.diff(b[order])) + 1):
        own = slice(start[b[rows[0]]], start[b[rows[0]]] + sizes[b[rows[0]]])
        marked[numbers[own]] = True
        for part in pieces(sizes[a[rows]].tolist()):
            asked = a[rows[part]]
            ends = np.cumsum(sizes[asked])
            at = np.arange(ends[-1]) + np.repeat(start[asked] - ends + sizes[asked], sizes[asked])
            found = np.concatenate([[0], np.cumsum(marked[numbers[at]])])
            out[rows[part]] = found[ends] - found[ends - sizes[asked]]
        marked[numbers[own]] = False
    return out


def _distinct_texts(first: list[str], second: list[str]) -> Iterator[tuple[slice, dict[str, int]]]:
    """Slices of pairs with their distinct texts, numbered, of some PIECE_BYTES in all or one pair at least."""
    begin, numbers, size = 0, {}, 0
    for i, pair in enumerate(zip(first, second, strict=True)):
        if numbers and size > 8 * PIECE_BYTES:
            yield slice(begin, i), numbers
            begin, numbers, size = i, {}, 0
        for text in pair:
            if text not in numbers:
                numbers[text] = len(numbers)
                size += len(text)
    if numbers:
        yield slice(begin, len(first)), numbers


def linked(first: list[str], second: list[str], width: int, percent: int) -> np.ndarray:
    """Whether the full sets of each pair of texts reach the similarity."""
    out = np.zeros(len(first), bool)
    for part, numbers in _distinct_texts(first, second):
        texts, sets = list(numbers), []
        for some in pieces([len(t) for t in texts]):
            hashes, counts = shingle_sets(texts[some], width)
            sets += np.split(hashes, np.cumsum(counts)[:-1])
        a, b = [numbers[t] for t in first[part]], [numbers[t] for t in second[part]]
        common = _common(sets, a, b)
        union = np.array([len(sets[i]) + len(sets[j]) for i, j in zip(a, b, strict=True)]) - common
        out[part] = (common > 0) & (100 * common >= percent * union)
    return out


def _confirmer(width: int, percent: int):
    @pandas_udf("boolean")
    @lean
    def confirm(first: pd.Series, second: pd.Series) -> pd.Series:
        return pd.Series(linked([as_text(t) for t in first], [as_text(t) for t in second], width, percent))

    return confirm


def sketch_documents(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n, f1, f2, tokens, sig) of each row."""
    sketched = docs.select("doc_id", _sketcher(width)(text_or_empty("text")).alias("s"))
    return sketched.select("doc_id", "s.n", "s.f1", "s.f2", "s.tokens", "s.sig")


def _band(percent: int) -> float:
    """Sizes of sets in one band differ by this factor at most."""
    return 100 / percent * (1 + 1e-9)


def prefix_lists(classes: DataFrame, percent: int) -> DataFrame:
    """(rep, f1, band, tokens): the rarest values of each class, as far as another class has them too.

    Sets whose sizes allow a link lie in one band of sizes or in neighbouring ones.
    """
    posts = classes.select("rep", "f1", "n", F.explode("tokens").alias("token"))
    shared = posts.groupBy("token").agg(F.count("*").alias("members")).where("members > 1")
    own = posts.join(shared, "token").groupBy("rep", "f1", "n").agg(F.sort_array(F.collect_list(F.struct("members", "token"))).alias("own"))
    # Values that no other class has are the rarest of all: they fill the prefix first.
    room = F.size("own") - (SHARED - 1)
    kept = own.where(room > 0).select("rep", "f1", "n", F.transform(F.slice("own", 1, room), lambda x: x["token"]).alias("tokens"))
    band = F.floor(F.log("n") / math.log(_band(percent))).cast("int")
    return kept.select("rep", "f1", band.alias("band"), "tokens")


@pandas_udf(IntegerType())
def _agreements(first: pd.Series, second: pd.Series) -> pd.Series:
    """Min-hashes that agree; 0 if fewer than SHARED coordinates do."""
    a, b = (np.frombuffer(b"".join(x), np.uint8).reshape(len(x), COORDINATES, ROWS) for x in (first, second))
    same = a == b
    return pd.Series(np.where(same.all(2).sum(1) >= SHARED, same.sum((1, 2)), 0).astype(np.int32))


def _agreeing(pairs: DataFrame, classes: DataFrame, needed: int) -> DataFrame:
    """Pairs (a, b) whose signatures agree often enough, with the number of agreements."""
    first = classes.select(F.col("rep").alias("a"), F.col("sig").alias("sig_a"))
    second = classes.select(F.col("rep").alias("b"), F.col("sig").alias("sig_b"))
    return pairs.join(first, "a").join(second, "b").select("a", "b", _agreements("sig_a", "sig_b").alias("agree")).where(F.col("agree") >= needed)


def _confirmed(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs (a, b) that are linked, judged on the full texts of both."""
    ids = stored(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "ids")
    texts = docs.select("doc_id", text_or_empty("text").alias("text")).join(ids, "doc_id", "left_semi")
    first = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.select("a", "b").join(first, "a").join(second, "b")
    return both.where(_confirmer(width, percent)("text_a", "text_b")).select("a", "b")


def _ordered(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _round_of_pairs(members: DataFrame, compared: DataFrame | None, classes: DataFrame, needed: int, seed: int) -> DataFrame:
    """Classes with the most alike pivots of their lists, where the pivot stands in another component.

    Each band of sizes of a list has a pivot: its first member by a hash that differs from round to round.
    """
    pivots = members.groupBy("token", "band").agg(F.min_by(F.struct("rep", "component"), F.xxhash64("rep", "token", F.lit(seed))).alias("pivot"), F.count("*").alias("n")).where("n > 1")
    met = members.join(pivots.select("token", "band", "pivot"), ["token", "band"]).where("component <> pivot.component")
    pairs = met.select("rep", F.col("pivot.rep").alias("pivot")).distinct()
    if compared is not None:
        known = compared.select(F.col("a").alias("rep"), F.col("b").alias("pivot"))
        pairs = pairs.join(known.unionAll(known.select(F.col("pivot").alias("rep"), F.col("rep").alias("pivot"))), ["rep", "pivot"], "left_anti")
    agreeing = _agreeing(pairs.select(F.col("pivot").alias("a"), F.col("rep").alias("b")), classes, needed)
    best = Window.partitionBy("b").orderBy(F.col("agree").desc(), "a")
    return agreeing.withColumn("place", F.row_number().over(best)).where(F.col("place") <= PIVOTS).select(*_ordered("a", "b")).distinct()


def _members(postings: DataFrame, components: DataFrame | None) -> DataFrame:
    """The postings of lists that span several components, with the component of each member."""
    if components is None:
        return postings.withColumn("component", F.col("rep"))
    placed = postings.join(components.select(F.col("node").alias("rep"), "component"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    spanning = placed.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("token")
    return stored(placed.join(spanning, "token"), "members")


def _blocks(members: DataFrame, carried: DataFrame, percent: int) -> DataFrame:
    """(token, cell, salt, members, partners): lists cut by band of sizes, by whether members are in the list's
    largest component, and by a hash, into blocks of about BLOCK members with what ``carried`` has of each.

    Where sets are carried, a block also has some BLOCK_SHINGLES shingles at most, or one member.  A partner is another
    block of the list to compare with.  Blocks of the largest component are not compared with each other.
    """
    groups = members.groupBy("token", "band", "component").agg(F.count("*").alias("n"))
    main = groups.groupBy("token").agg(F.max_by("component", F.struct("n", "component")).alias("main"))
    cell = (F.col("band") * 2 + (F.col("component") != F.col("main")).cast("int")).alias("cell")
    count = F.sum("n")
    if "shingles" in carried.columns:
        largest = F.pow(F.lit(_band(percent)), F.max("band") + 1)
        count = F.greatest(count, count * largest * BLOCK / BLOCK_SHINGLES)
    counted = groups.join(main, "token").groupBy("token", "main", cell).agg(F.ceil(count / BLOCK).cast("int").alias("blocks"))
    lists = counted.groupBy("token", "main").agg(F.collect_list(F.struct("cell", "blocks")).alias("cells"))
    placed = members.join(lists, "token").withColumn("cell", cell)
    blocks = F.element_at(F.map_from_entries("cells"), F.col("cell"))
    placed = placed.withColumn("salt", F.pmod(F.xxhash64("rep"), blocks).cast("int")).select("token", "cell", "salt", "rep", "f1", "component", "cells")
    held = placed.join(carried, ["rep", "f1"])
    member = F.struct("component", *[c for c in carried.columns if c != "f1"])
    grouped = held.groupBy("token", "cell", "salt").agg(F.collect_list(member).alias("members"), F.first("cells").alias("cells"))

    def wanted(other: Column) -> Column:
        below, above = F.floor(F.col("cell") / 2), F.floor(other["cell"] / 2)
        outside = (F.col("cell") % 2 + other["cell"] % 2) > 0
        return outside & (((above == below) & (other["cell"] >= F.col("cell"))) | (above == below + 1))

    def numbered(other: Column) -> Column:
        every = F.transform(F.sequence(F.lit(0), other["blocks"] - 1), lambda salt: F.struct(other["cell"].alias("cell"), salt.alias("salt")))
        return F.filter(every, lambda x: (x["cell"] != F.col("cell")) | (x["salt"] > F.col("salt")))

    partners = F.flatten(F.transform(F.filter("cells", wanted), numbered))
    return stored(grouped.select("token", "cell", "salt", "members", partners.alias("partners")), "blocks")


def _block_pairs(blocks: DataFrame) -> DataFrame:
    """(token, first, second): blocks to compare; second is NULL where a block is compared with itself."""
    alone = blocks.where("cell % 2 = 1 AND size(members) > 1").select("token", F.col("members").alias("first"), F.lit(None).cast(blocks.schema["members"].dataType).alias("second"))
    asked = blocks.select("token", F.col("members").alias("first"), F.explode("partners").alias("p"))
    other = blocks.select("token", F.col("cell").alias("other"), F.col("salt").alias("number"), F.col("members").alias("second"))
    met = asked.select("token", "first", F.col("p.cell").alias("other"), F.col("p.salt").alias("number")).join(other, ["token", "other", "number"]).select("token", "first", "second")
    return alone.unionAll(met)


def _block(column: pa.ListArray, row: int) -> dict:
    """Members of one block as arrays; ``token`` and ``posted`` have a column for each coordinate."""
    found = column.slice(row, 1).flatten()
    out = {name: found.field(name).to_numpy() for name in ("rep", "n", "component")}
    out["sig"] = np.frombuffer(b"".join(found.field("sig").to_pylist()), np.uint8).reshape(len(found), _MIN_HASHES)
    lists = found.field("tokens")
    values, owner = lists.flatten().to_numpy(), np.repeat(np.arange(len(found)), lists.value_lengths().to_numpy())
    out["token"], out["posted"] = np.zeros((len(found), COORDINATES), np.int64), np.zeros((len(found), COORDINATES), bool)
    place = values & (COORDINATES - 1)
    out["token"][owner, place], out["posted"][owner, place] = values, True
    if any(f.name == "shingles" for f in found.type):
        out["sets"] = [np.frombuffer(x, np.uint64) for x in found.field("shingles").to_pylist()]
    return out


def candidates(x: dict, y: dict, coordinate: int, needed: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of two blocks of a list (or of one) that may be linked and have no common list of a lower coordinate."""
    low, high = np.minimum.outer(x["n"], y["n"]), np.maximum.outer(x["n"], y["n"])
    i, j = np.nonzero((x["component"][:, None] != y["component"][None]) & (100 * low >= percent * high))
    if y is x:
        i, j = i[i < j], j[i < j]
    # Whole coordinates first: most pairs that meet by chance share no second one.
    may = np.flatnonzero((x["sig"].view(np.uint32)[i] == y["sig"].view(np.uint32)[j]).sum(1) >= SHARED)
    i, j = i[may], j[may]
    before = (x["token"][i, :coordinate] == y["token"][j, :coordinate]) & x["posted"][i, :coordinate] & y["posted"][j, :coordinate]
    may = np.flatnonzero(~before.any(1))
    i, j = i[may], j[may]
    may = (x["sig"][i] == y["sig"][j]).sum(1) >= needed
    return i[may], j[may]


def _scout(needed: int, percent: int):
    def scout(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(token, rep) of the members that may be linked with another one of the list."""
        for batch in batches:
            tokens, reps = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for row, token in enumerate(batch.column("token").to_pylist()):
                x = _block(batch.column("first"), row)
                y = _block(batch.column("second"), row) if batch.column("second")[row].is_valid else x
                i, j = candidates(x, y, token & (COORDINATES - 1), needed, percent)
                reps.append(np.unique(np.concatenate([x["rep"][i], y["rep"][j]])))
                tokens.append(np.full(len(reps[-1]), token, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens)), pa.array(np.concatenate(reps))], ["token", "rep"])

    return scout


def _judge(needed: int, percent: int):
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links (a, b) between members of two blocks, or of one, by their full sets."""
        for batch in batches:
            found = [np.zeros((0, 2), np.int64)]
            for row, token in enumerate(batch.column("token").to_pylist()):
                x = _block(batch.column("first"), row)
                y = _block(batch.column("second"), row) if batch.column("second")[row].is_valid else x
                i, j = candidates(x, y, token & (COORDINATES - 1), needed, percent)
                if len(i):
                    common = _common([*x["sets"], *y["sets"]], i, j + len(x["sets"]))
                    union = x["n"][i] + y["n"][j] - common
                    linked = (common > 0) & (100 * common >= percent * union)
                    found.append(np.sort(np.stack([x["rep"][i[linked]], y["rep"][j[linked]]], 1), 1))
            pairs = np.concatenate(found)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return judge


def _full_sets(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(rep, f1, shingles): the full sets of the documents in ``ids``, as sorted hashes."""
    @pandas_udf("struct<f1:bigint,shingles:binary>")
    @lean
    def sets(texts: pd.Series) -> pd.DataFrame:
        out = []
        for part in pieces([len(as_text(t)) for t in texts]):
            hashes, counts = shingle_sets([as_text(t) for t in texts.iloc[part]], width)
            for own in np.split(hashes, np.cumsum(counts)[:-1]):
                out.append((int(mix(own ^ np.uint64(_SUM_SEEDS[0])).sum(dtype=np.uint64).view(np.int64)), own.tobytes()))
        return pd.DataFrame(out, columns=["f1", "shingles"])

    texts = docs.select(F.col("doc_id").alias("rep"), text_or_empty("text").alias("text")).join(ids, "rep", "left_semi")
    found = texts.select("rep", sets("text").alias("s")).select("rep", "s.f1", "s.shingles")
    return found.groupBy("rep", "f1").agg(F.first("shingles").alias("shingles"))


def _links_in_blocks(members: DataFrame, classes: DataFrame, lists: DataFrame, docs: DataFrame, width: int, needed: int, percent: int) -> DataFrame:
    """All links between members of a list that stand in different components."""
    carried = stored(classes.select("rep", "f1", "n", "sig").join(lists.select("rep", "f1", "tokens"), ["rep", "f1"]), "carried")
    scouted = _block_pairs(_blocks(members, carried, percent)).mapInArrow(lean_stage(_scout(needed, percent)), "token bigint, rep bigint")
    involved = stored(scouted.distinct(), "involved")
    left = stored(members.join(involved, ["token", "rep"], "left_semi"), "members")
    sets = _full_sets(docs, involved.select("rep").distinct(), width)
    judged = _block_pairs(_blocks(left, carried.join(sets, ["rep", "f1"]), percent))
    return judged.mapInArrow(lean_stage(_judge(needed, percent)), "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, width: int = 2, threshold: float = 0.8) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs`` (doc_id, text)."""
    with small_batches(docs.sparkSession):
        return _near_duplicates(docs, width, threshold)


def _near_duplicates(docs: DataFrame, width: int, threshold: float) -> DataFrame:
    percent = round(100 * threshold)
    needed = matches_needed(threshold)
    docs = docs.select("doc_id", "text")
    rows = stored(sketch_documents(docs, width), "sketches")
    usable = rows.where("n > 0 AND doc_id IS NOT NULL")
    classes = stored(usable.groupBy("f1", "f2").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("tokens").alias("tokens"), F.first("sig").alias("sig")), "classes")
    lists = stored(prefix_lists(classes, percent), "postings")
    postings = lists.select("rep", "f1", "band", F.explode("tokens").alias("token"))
    # Rows of one doc_id with different sets tie their classes together.
    tied = usable.select("doc_id", "f1", "f2").join(classes.select("f1", "f2", "rep"), ["f1", "f2"]).groupBy("doc_id").agg(F.min("rep").alias("a"), F.collect_set("rep").alias("reps"))
    tied = tied.where(F.size("reps") > 1).select("a", F.explode("reps").alias("b")).where("a <> b")
    links, compared, components = stored(tied, "links"), None, None
    for number in range(ROUNDS):
        members = _members(postings, components)
        pairs = stored(_round_of_pairs(members, compared, classes, needed, number), "pairs")
        more = stored(_confirmed(pairs, docs, width, percent), "links")
        compared = pairs if compared is None else compared.unionAll(pairs)
        links = links.unionAll(more)
        components = connected_components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
        if more.isEmpty():
            break
    more = stored(_links_in_blocks(_members(postings, components), classes, lists, docs, width, needed, percent), "links")
    if not more.isEmpty():
        components = connected_components(links.unionAll(more).select(F.col("a").alias("u"), F.col("b").alias("v")))
    found = classes.select("f1", "f2", "rep").join(components, classes["rep"] == components["node"], "left").select("f1", "f2", F.coalesce("component", "rep").alias("component"))
    joined = rows.select("doc_id", "n", "f1", "f2").join(found, ["f1", "f2"], "left")
    component = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
