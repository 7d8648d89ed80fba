"""Logits -> roots, exact codes, primary code and document state.

The decoder works inside the row: one array of logits per document, no shuffle.
Codes below a safe logit bound are dropped before any sigmoid is taken, so the
work per document depends on the few candidates, not on the taxonomy.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from taxaflow.functions.arrays import once, unfold
from taxaflow.functions.hierarchy import is_ancestor, nonredundant
from taxaflow.functions.scores import all_finite, argmax, sigmoid
from taxaflow.operators.taxonomy import EXACT_THRESHOLD, ROOT_THRESHOLD, HeadContract

_MARGIN = 0.01  # far more than single-precision rounding, so no candidate is lost


def _names(values: list[str]) -> Column:
    """A constant array; one literal to split, so that wide heads plan quickly."""
    return F.split(F.lit("\n".join(values)), "\n")


def _logit_bound(threshold: float) -> float | None:
    """A logit below this cannot reach the threshold; None if all can."""
    if threshold <= 0:
        return None
    if threshold >= 1:
        threshold = 1 - 1e-9
    return math.log(threshold / (1 - threshold)) - _MARGIN


def checked_logits(logits: Column, contract: HeadContract) -> Column:
    """The logits; a row of wrong width or with a value that is not finite stops the job."""
    problem = F.raise_error(F.lit(f"Expected {contract.width} finite logits per document"))
    return once(logits, lambda values: F.when(all_finite(values, contract.width), values).otherwise(problem))


def head_scores(logits: Column, offset: int, size: int) -> Column:
    return F.transform(F.slice(logits, offset + 1, size), sigmoid)


def selected(scores: Column, names: list[str], threshold: float) -> Column:
    """``struct(code, score, idx)`` of every score at or above the threshold, in contract order."""
    positions = F.sequence(F.lit(0), F.lit(len(names) - 1))
    codes = _names(names)
    # NaN is Spark's largest value, but passes no threshold.
    passed = F.filter(positions, lambda i: (F.get(scores, i).cast("double") >= F.lit(threshold)) & ~F.isnan(F.get(scores, i)))
    return F.transform(
        passed,
        lambda i: F.struct(F.get(codes, i).alias("code"), F.get(scores, i).cast("double").alias("score"), i.alias("idx")),
    )


def selected_from_logits(logits: Column, offset: int, names: list[str], threshold: float) -> Column:
    """Same as :func:`selected` on the sigmoid of a slice of the logits."""
    positions = F.sequence(F.lit(0), F.lit(len(names) - 1))
    bound = _logit_bound(threshold)
    codes = _names(names)
    near = positions
    if bound is not None:
        near = F.filter(positions, lambda i: F.get(logits, i + offset) >= F.lit(bound))
    scored = F.transform(
        near,
        lambda i: F.struct(
            F.get(codes, i).alias("code"), sigmoid(F.get(logits, i + offset)).alias("score"), i.alias("idx")
        ),
    )
    return F.filter(scored, lambda s: s["score"] >= F.lit(threshold))


_KEPT = "array<struct<order: double, code: string, score: double, root: string>>"


def keep_nonredundant(candidates: Column, contract: HeadContract, roots: Column) -> Column:
    """Candidates of the selected roots, best first, without relatives inside a root."""
    root_of = _names([contract.roots[i] for i in contract.exact_root_indices])
    gated = F.filter(candidates, lambda c: F.array_contains(roots, F.get(root_of, c["idx"])))
    ranked = F.array_sort(
        F.transform(
            gated,
            lambda c: F.struct(
                (-c["score"]).alias("order"),
                c["code"].alias("code"),
                c["score"].alias("score"),
                F.get(root_of, c["idx"]).alias("root"),
            ),
        )
    )

    def related(a: Column, b: Column) -> Column:
        return (a["root"] == b["root"]) & (is_ancestor(a["code"], b["code"]) | is_ancestor(b["code"], a["code"]))

    return F.aggregate(
        ranked,
        F.array().cast(_KEPT),
        lambda kept, c: F.when(F.exists(kept, lambda k: related(k, c)), kept).otherwise(F.array_append(kept, c)),
    )


def _score_map(entries: Column) -> Column:
    pairs = F.transform(entries, lambda e: F.struct(e["code"].alias("key"), e["score"].alias("value")))
    return F.map_from_entries(F.array_distinct(pairs))


def _codes(entries: Column) -> Column:
    return F.transform(entries, lambda e: e["code"])


def _labels(root_entries: Column, candidates: Column, contract: HeadContract, named: Column | None) -> Column:
    """``struct(roots, exact, root_entries, kept)``; each part is computed once."""
    def with_kept(s: Column) -> Column:
        roots = _codes(s["root_entries"]) if named is None else s["named"]
        kept = keep_nonredundant(s["candidates"], contract, roots)
        return F.struct(roots.alias("roots"), s["root_entries"].alias("root_entries"), kept.alias("kept"))

    def with_exact(s: Column) -> Column:
        codes = _codes(s["kept"])
        if named is not None:
            # A root the caller names twice yields its codes twice.
            codes = F.flatten(
                F.transform(s["roots"], lambda r: _codes(F.filter(s["kept"], lambda k: k["root"] == r)))
            )
        return F.struct(s["roots"], F.sort_array(codes).alias("exact"), s["root_entries"], s["kept"])

    parts = [root_entries.alias("root_entries"), candidates.alias("candidates")]
    if named is not None:
        parts.append(named.alias("named"))
    return once(F.struct(*parts), lambda s: once(with_kept(s), with_exact))


def predict_sets(
    df: DataFrame,
    contract: HeadContract,
    *,
    root_scores: str = "root_scores",
    exact_scores: str = "exact_scores",
    root_threshold: float = ROOT_THRESHOLD,
    exact_threshold: float = EXACT_THRESHOLD,
    roots: str | None = None,
) -> DataFrame:
    """Select ``roots`` and ``exact`` from score arrays; column ``roots`` replaces the gate."""
    kept = [c for c in df.columns if c not in ("roots", "exact")]
    labels = _labels(
        once(F.col(root_scores), lambda s: selected(s, contract.roots, root_threshold)),
        once(F.col(exact_scores), lambda s: selected(s, contract.exact, exact_threshold)),
        contract,
        None if roots is None else F.col(roots),
    )
    return df.withColumn("_labels", labels).select(*kept, "_labels.roots", "_labels.exact")


def decode_logits(
    df: DataFrame,
    contract: HeadContract,
    *,
    logits: str = "logits",
    root_threshold: float = ROOT_THRESHOLD,
    exact_threshold: float = EXACT_THRESHOLD,
    roots: str | None = None,
    check: bool = True,
) -> DataFrame:
    """Add the label columns and drop the logits; other columns pass through.

    Columns that are not used later are not computed.
    """
    made = ["roots", "exact", "root_probabilities", "exact_probabilities", "auxiliary_primary", "document_state"]
    passed = [c for c in df.columns if c not in (*made, logits)]
    named = None if roots is None else F.col(roots)

    def roots_of(values: Column) -> Column:
        if named is None:
            return selected_from_logits(values, 0, contract.roots, root_threshold)
        return F.filter(
            selected_from_logits(values, 0, contract.roots, 0.0), lambda r: F.array_contains(named, r["code"])
        )

    if check:
        df = df.withColumn(logits, checked_logits(F.col(logits), contract))
    labels = once(
        F.col(logits),
        lambda values: _labels(
            roots_of(values),
            selected_from_logits(values, contract.exact_offset, contract.exact, exact_threshold),
            contract,
            named,
        ),
    )
    found = F.col("_labels")
    return df.withColumn("_labels", labels).select(
        *passed,
        found["roots"].alias("roots"),
        found["exact"].alias("exact"),
        _score_map(found["root_entries"]).alias("root_probabilities"),
        _score_map(found["kept"]).alias("exact_probabilities"),
        primary_code(F.col(logits), contract).alias("auxiliary_primary"),
        document_state(F.col(logits), contract).alias("document_state"),
    )


def primary_code(logits: Column, contract: HeadContract) -> Column:
    """Code with the largest primary logit.  Never gated."""
    part = F.slice(logits, contract.primary_offset + 1, len(contract.exact))
    return F.get(_names(contract.exact), argmax(part).cast("int"))


def document_state(logits: Column, contract: HeadContract) -> Column:
    fields = []
    for name, offset in contract.state_offsets.items():
        labels = contract.states[name]
        part = F.slice(logits, offset + 1, len(labels))
        fields.append(F.get(_names(labels), argmax(part).cast("int")).alias(name))
    return F.struct(*fields)


def exact_rank(df: DataFrame, contract: HeadContract, taxonomy: DataFrame, *, key: str = "sample_id", logits: str = "logits",
               root_threshold: float = ROOT_THRESHOLD, exact_threshold: float = EXACT_THRESHOLD) -> DataFrame:
    """Long form: one row per passing code of a selected root, ranked by score and code.

    Only passing codes are unfolded.  Rank groups are bounded by the codes of a
    root, however many documents there are.
    """
    values = checked_logits(F.col(logits), contract)
    roots = once(values, lambda v: _codes(selected_from_logits(v, 0, contract.roots, root_threshold)))
    entries = once(values, lambda v: selected_from_logits(v, contract.exact_offset, contract.exact, exact_threshold))
    passing = unfold(df, [key, roots.alias("roots")], entries, "e").select(key, "roots", "e.idx", "e.score")
    exact = taxonomy.where("head = 'exact'").select("idx", "code", "root_code")
    order = Window.partitionBy(key, "root_code").orderBy(F.desc("score"), "code")
    return (
        passing.join(exact, "idx")  # a local table of known size: Spark broadcasts it if it fits
        .where(F.array_contains("roots", F.col("root_code")))
        .select(key, "root_code", "code", "score", F.row_number().over(order).alias("rank"))
    )


def decode_long(ranked: DataFrame, *, key: str = "sample_id") -> DataFrame:
    """Greedy selection on the ranked long form; a readable check of the row-local decoder."""
    listed = ranked.groupBy(key, "root_code").agg(
        F.array_sort(F.collect_list(F.struct("rank", "code"))).alias("codes")
    )
    kept = nonredundant(F.transform("codes", lambda c: c["code"]))
    return unfold(listed, [key], kept, "code")


def register_decode_function(spark: SparkSession, contract: HeadContract, name: str = "decode_memberships") -> None:
    """SQL function ``name(logits)`` -> array of ``kind, code, score``, roots first.

    Use as ``FROM (SELECT id, decode_memberships(logits) AS found FROM t) LATERAL VIEW OUTER inline(found) AS kind, code,
    score`` (rows without labels then have NULLs).  The body is a plain expression over the same rule: each row is decoded
    where it lies, once, without a join or a shuffle.
    """
    def literals(values: list[str]) -> str:
        return "array(" + ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values) + ")"

    n_roots, n_exact = len(contract.roots), len(contract.exact)
    score = "cast(cast(1.0D / (1.0D + exp(-cast(get(v, i + {o}) as double))) as float) as double)"
    entry = "named_struct('neg', -{s}, 'code', get({c}, i), 'score', {s}, 'root', get({r}, i))"
    roots = literals(contract.roots)
    root_of = literals([contract.roots[i] for i in contract.exact_root_indices])

    def entries(offset, size, codes, owners, threshold):
        s = score.format(o=offset)
        e = entry.format(s=s, c=codes, r=owners)
        return f"transform(filter(sequence(0, {size - 1}), i -> {s} >= {threshold}D), i -> {e})"

    root_rows = entries(0, n_roots, roots, roots, ROOT_THRESHOLD)
    exact_rows = entries(n_roots, n_exact, literals(contract.exact), root_of, EXACT_THRESHOLD)
    gated = (
        f"array_sort(filter({exact_rows}, e -> exists({root_rows}, r -> r.code = e.root)))"
    )
    related = (
        "(k.root = c.root and (startswith(c.code, concat(k.code, '.')) or startswith(k.code, concat(c.code, '.'))))"
    )
    entry_type = "array<struct<neg: double, code: string, score: double, root: string>>"
    kept = (
        f"aggregate({gated}, cast(array() as {entry_type}), "
        f"(acc, c) -> if(exists(acc, k -> {related}), acc, array_append(acc, c)))"
    )
    finite = "forall(l, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    problem = f"cast(raise_error('Expected {contract.width} finite logits per document') AS array<float>)"
    guarded = f"if(size(l) = {contract.width} AND {finite}, l, {problem})"
    def shown(kind: str, entries: str) -> str:
        return f"transform({entries}, x -> named_struct('kind', '{kind}', 'code', x.code, 'score', x.score))"

    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(l ARRAY<FLOAT>)
        RETURNS ARRAY<STRUCT<kind: STRING, code: STRING, score: DOUBLE>>
        RETURN get(transform(array({guarded}), v -> concat({shown('root', root_rows)}, {shown('exact', kept)})), 0)
    """)
