"""Queries over logits: gates, ranks, memberships, states, pooling."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaflow.functions.arrays import once, unfold
from taxaflow.functions.scores import all_finite
from taxaflow.operators.decode import (
    decode_logits, decode_long, document_state, exact_rank, head_scores, predict_sets, primary_code,
    register_decode_function, selected_from_logits,
)
from taxaflow.operators.memberships import (
    all_memberships, export_documents, label_metrics, membership, review_queue, source_rollup,
)
from taxaflow.operators.pooling import last_pool, mean_pool
from taxaflow.operators.scoring import (
    ScoredBatch, prediction_columns, score_documents, with_model_input,
)
from taxaflow.operators.taxonomy import label_memberships, taxonomy_table
from taxaflow.queries.inputs import (
    ALL_LOGITS_SQL, CONTRACT, EXACT_CODES_SQL, LOGIT_SCALE, LOGITS_SQL, PAD, PRIMARY_SQL, ROOT_CODES_SQL,
    STATE_JSON_SQL, WORDS_SQL, decode_sql, digest_logits, documents, logits, sigmoid_sql, state_sql, table, token_vectors,
)
from taxaflow.queries.registry import query


def score6(name: str = "score"):
    return F.round(name, 6).alias("score")


def decoded(spark, sf_dir):
    return decode_logits(logits(spark, sf_dir), CONTRACT)


def scored_documents(spark, sf_dir):
    """Every usable document with logits: of its vector, joined by ID, or of its text where it has none."""
    ready = with_model_input(documents(spark, sf_dir).where(F.size("violations") == 0)).drop("text_window", "metadata_compact", "model_input", "violations")
    joined = ready.join(logits(spark, sf_dir).drop("vec_id"), "sample_id", "left")
    return joined.withColumn("logits", F.coalesce("logits", digest_logits(F.col("model_input_sha256"))))


def predictions(spark, sf_dir):
    """All documents, decoded into prediction columns."""
    return prediction_columns(decode_logits(scored_documents(spark, sf_dir), CONTRACT))


PREDICTED_SQL = f"""{decode_sql(ALL_LOGITS_SQL)}, predicted AS (
    SELECT d.*, e.l, len({WORDS_SQL.format("d.model_input")}) AS n_tokens,
        (SELECT count(*) FROM kept k WHERE k.sample_id = d.sample_id) AS n_exact
    FROM inputs d JOIN emb e ON e.sample_id = d.sample_id)"""


@query("root_gate", f"""
WITH {decode_sql()}
SELECT sample_id, code, round(score, 6) AS score, idx FROM root_sel""")
def root_gate(spark, sf_dir):
    gate = once(F.col("logits"), lambda v: selected_from_logits(v, 0, CONTRACT.roots, 0.5))
    return unfold(logits(spark, sf_dir), ["sample_id"], gate, "r").select(
        "sample_id", "r.code", score6("r.score"), "r.idx"
    )


@query("logit_guard", f"""
WITH {LOGITS_SQL}
SELECT sample_id, vec_id % 4 = 0 AS usable FROM emb""")
def logit_guard(spark, sf_dir):
    """Rows with a missing, infinite or undefined logit are found."""
    rest, values = F.col("vec_id") % 4, F.col("logits")
    planted = (
        F.when(rest == 1, F.slice(values, 1, 63))
        .when(rest == 2, F.concat(F.slice(values, 1, 63), F.array(F.lit(float("nan")).cast("float"))))
        .when(rest == 3, F.concat(F.array(F.lit(float("-inf")).cast("float")), F.slice(values, 2, 63)))
        .otherwise(values)
    )
    return logits(spark, sf_dir).select("sample_id", all_finite(planted, CONTRACT.width).alias("usable"))


@query("head_slices", f"""
WITH {LOGITS_SQL}
SELECT sample_id, round(list_max(list_transform(l[1:5], lambda x: {sigmoid_sql("x")})), 6) AS best_root,
    round(list_min(list_transform(l[6:30], lambda x: {sigmoid_sql("x")})), 6) AS worst_exact,
    round(list_max(l[31:55])::DOUBLE, 6) AS best_primary, round(list_max(l[56:64])::DOUBLE, 6) AS best_state FROM emb""")
def head_slices(spark, sf_dir):
    values = F.col("logits")
    return logits(spark, sf_dir).select(
        "sample_id",
        F.round(F.array_max(head_scores(values, 0, 5)), 6).alias("best_root"),
        F.round(F.array_min(head_scores(values, CONTRACT.exact_offset, 25)), 6).alias("worst_exact"),
        F.round(F.array_max(F.slice(values, CONTRACT.primary_offset + 1, 25)).cast("double"), 6).alias("best_primary"),
        F.round(F.array_max(F.slice(values, 56, 9)).cast("double"), 6).alias("best_state"),
    )


@query("gate_override", f"""
WITH {LOGITS_SQL}, {ROOT_CODES_SQL}, {EXACT_CODES_SQL},
root_sel AS (SELECT sample_id, unnest(CASE vec_id % 3 WHEN 0 THEN ['T.A'] WHEN 1 THEN ['T.C', 'T.B'] ELSE [] END) AS code FROM emb),
""" + decode_sql().split("WHERE score >= 0.5),")[1] + """
SELECT sample_id, code FROM kept""")
def gate_override(spark, sf_dir):
    """The caller names the roots; the root scores do not matter."""
    rest = F.col("vec_id") % 3
    none = F.array().cast("array<string>")
    chosen = F.when(rest == 0, F.array(F.lit("T.A"))).when(rest == 1, F.array(F.lit("T.C"), F.lit("T.B"))).otherwise(none)
    rows = logits(spark, sf_dir).withColumn("chosen", chosen)
    result = decode_logits(rows, CONTRACT, roots="chosen")
    return unfold(result, ["sample_id"], F.col("exact"), "code")


@query("other_thresholds", f"""
WITH {decode_sql(exact_threshold=0.7, root_threshold=0.2)}
SELECT sample_id, code FROM kept""")
def other_thresholds(spark, sf_dir):
    """Selection from score arrays under other thresholds."""
    values = F.col("logits")
    rows = logits(spark, sf_dir).select(
        "sample_id", head_scores(values, 0, 5).alias("root_scores"),
        head_scores(values, CONTRACT.exact_offset, 25).alias("exact_scores"),
    )
    result = predict_sets(rows, CONTRACT, root_threshold=0.2, exact_threshold=0.7)
    return unfold(result, ["sample_id"], F.col("exact"), "code")


@query("exact_rank", f"""
WITH {decode_sql()}
SELECT sample_id, root AS root_code, code, round(score, 6) AS score, rank FROM ranked""")
def ranks(spark, sf_dir):
    ranked = exact_rank(logits(spark, sf_dir), CONTRACT, taxonomy_table(spark, CONTRACT))
    return ranked.select("sample_id", "root_code", "code", score6(), F.col("rank").cast("bigint").alias("rank"))


@query("exact_decode", f"""
WITH {decode_sql()}
SELECT e.sample_id, coalesce(string_agg(k.code, '|' ORDER BY k.code), '') AS exact, count(k.code) = 0 AS empty_exact
FROM emb e LEFT JOIN kept k ON k.sample_id = e.sample_id GROUP BY e.sample_id""")
def exact_decode(spark, sf_dir):
    return decoded(spark, sf_dir).select(
        "sample_id", F.array_join("exact", "|").alias("exact"), (F.size("exact") == 0).alias("empty_exact")
    )


@query("exact_decode_long", f"""
WITH {decode_sql()}
SELECT sample_id, code FROM kept""")
def exact_decode_long(spark, sf_dir):
    """The long-form twin of the row-local decoder."""
    return decode_long(exact_rank(logits(spark, sf_dir), CONTRACT, taxonomy_table(spark, CONTRACT))).select("sample_id", "code")


@query("decode_function", f"""
WITH {decode_sql()}
SELECT sample_id, 'root' AS kind, code, round(score, 6) AS score FROM root_sel
UNION ALL SELECT sample_id, 'exact', code, round(score, 6) FROM kept""")
def decode_function(spark, sf_dir):
    """The SQL function over a view, its array unfolded beside each row."""
    register_decode_function(spark, CONTRACT)
    logits(spark, sf_dir).createOrReplaceTempView("taxaflow_logits")
    return spark.sql(
        "SELECT sample_id, kind, code, round(score, 6) AS score "
        "FROM (SELECT sample_id, decode_memberships(logits) AS found FROM taxaflow_logits) "
        "LATERAL VIEW OUTER inline(found) AS kind, code, score WHERE kind IS NOT NULL"
    )


@query("primary_code", f"""
WITH {LOGITS_SQL}, {EXACT_CODES_SQL}
SELECT sample_id, {PRIMARY_SQL} AS auxiliary_primary FROM emb""")
def primary(spark, sf_dir):
    return logits(spark, sf_dir).select("sample_id", primary_code(F.col("logits"), CONTRACT).alias("auxiliary_primary"))


@query("document_state", f"""
WITH {LOGITS_SQL}
SELECT sample_id, {state_sql("document_integrity")} AS document_integrity, {state_sql("topic_structure")} AS topic_structure,
    {state_sql("labelability")} AS labelability FROM emb""")
def states(spark, sf_dir):
    state = document_state(F.col("logits"), CONTRACT).alias("s")
    return logits(spark, sf_dir).select("sample_id", state).select("sample_id", "s.*")


@query("root_membership", f"""
WITH {decode_sql()}
SELECT sample_id, code, round(score, 6) AS score FROM root_sel""")
def root_membership(spark, sf_dir):
    return membership(decoded(spark, sf_dir), "root").select("sample_id", "code", score6())


@query("exact_membership", f"""
WITH {decode_sql(ALL_LOGITS_SQL)}
SELECT sample_id, code, round(score, 6) AS score FROM kept""")
def exact_membership(spark, sf_dir):
    """Documents joined with their logits, decoded, unfolded."""
    scored = scored_documents(spark, sf_dir).select("sample_id", "logits")
    return membership(decode_logits(scored, CONTRACT), "exact").select("sample_id", "code", score6())


@query("memberships", f"""
WITH {decode_sql()}
SELECT sample_id, 'root' AS kind, code, round(score, 6) AS score FROM root_sel
UNION ALL SELECT sample_id, 'exact', code, round(score, 6) FROM kept""")
def both_memberships(spark, sf_dir):
    return all_memberships(decoded(spark, sf_dir)).select("sample_id", "kind", "code", score6())


def _catalog(spark, sf_dir):
    """A catalog read off the memberships: label and parent are made from the code."""
    codes = all_memberships(decoded(spark, sf_dir)).select("code").distinct()
    parts = F.split("code", r"\.")
    parent = F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 1), ".")
    return codes.select(
        "code", parent.alias("parent"), F.lower(F.element_at(parts, -1)).alias("label"),
        F.concat(F.lit("about "), F.col("code")).alias("definition"),
    )


@query("label_lookup", f"""
WITH {decode_sql()}, codes AS (SELECT code FROM root_sel UNION SELECT code FROM kept)
SELECT k.sample_id, k.code, lower(string_split(k.code, '.')[-1]) AS label,
    array_to_string(string_split(k.code, '.')[1:len(string_split(k.code, '.')) - 1], '.') AS parent, 'about ' || k.code AS definition
FROM kept k JOIN codes c ON c.code = k.code""")
def label_lookup(spark, sf_dir):
    taxonomy = taxonomy_table(spark, CONTRACT, _catalog(spark, sf_dir)).where("head = 'exact'")
    rows = membership(decoded(spark, sf_dir), "exact").select("sample_id", "code")
    return label_memberships(rows, taxonomy).select("sample_id", "code", "label", "parent", "definition")


@query("review_queue", f"""
WITH {PREDICTED_SQL}
SELECT sample_id, reasons FROM (SELECT sample_id, array_to_string(list_filter([
    CASE WHEN n_exact = 0 THEN 'no_exact_label' END, CASE WHEN n_tokens > 768 THEN 'token_truncated' END,
    CASE WHEN raw_windowed THEN 'raw_windowed' END], lambda x: x IS NOT NULL), '|') AS reasons FROM predicted) WHERE reasons <> ''""")
def reviews(spark, sf_dir):
    return review_queue(predictions(spark, sf_dir)).select("sample_id", F.array_join("reasons", "|").alias("reasons"))


@query("documents_export", f"""
WITH {PREDICTED_SQL}
SELECT p.sample_id,
    coalesce((SELECT string_agg(code, '|' ORDER BY idx) FROM root_sel r WHERE r.sample_id = p.sample_id), '') AS roots,
    coalesce((SELECT string_agg(code, '|' ORDER BY code) FROM kept k WHERE k.sample_id = p.sample_id), '') AS exact,
    source_family, source_locator AS source_locator_json, {STATE_JSON_SQL} AS document_state_json,
    {PRIMARY_SQL} AS auxiliary_primary, 'supplied_window_prefix_768' AS input_scope, n_tokens::BIGINT AS input_tokens,
    least(n_tokens, 768)::BIGINT AS visible_tokens, n_tokens > 768 AS truncated, n_exact = 0 AS empty_exact, raw_windowed,
    sha256(text_window) AS stored_text_sha256, sha256(model_input) AS model_input_sha256
FROM predicted p""")
def documents_export(spark, sf_dir):
    return export_documents(predictions(spark, sf_dir)).withColumns(
        {"roots": F.array_join("roots", "|"), "exact": F.array_join("exact", "|")}
    ).drop("token_ids_sha256")


@query("source_rollup", f"""
WITH {PREDICTED_SQL}
SELECT source_family, count(*) AS documents, count(*) FILTER (WHERE n_exact = 0) AS without_exact,
    count(*) FILTER (WHERE n_tokens > 768) AS token_truncated, count(*) FILTER (WHERE raw_windowed) AS raw_windowed,
    sum(n_exact)::BIGINT AS exact_labels
FROM predicted GROUP BY source_family""")
def rollup(spark, sf_dir):
    return source_rollup(predictions(spark, sf_dir))


@query("label_metrics", f"""
WITH {decode_sql()}, gold AS (
    SELECT 'doc-' || doc_id AS sample_id, CASE quality WHEN 1 THEN 'T.A.X' ELSE 'T.B' END AS code FROM labels
    UNION SELECT 'doc-' || doc_id, 'T.C.Y' FROM labels WHERE toxic = 1),
given AS (SELECT k.sample_id, k.code FROM kept k WHERE k.sample_id IN (SELECT sample_id FROM gold)),
counts AS (SELECT count(*) FILTER (WHERE g.code IS NOT NULL AND p.code IS NOT NULL) AS tp,
    count(*) FILTER (WHERE g.code IS NULL) AS fp, count(*) FILTER (WHERE p.code IS NULL) AS fn
    FROM given p FULL JOIN gold g ON g.sample_id = p.sample_id AND g.code = p.code)
SELECT tp, fp, fn, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall,
    round(2 * tp / (2 * tp + fp + fn), 6) AS micro_f1 FROM counts""")
def metrics(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    sample_id = F.concat(F.lit("doc-"), F.col("doc_id")).alias("sample_id")
    gold = labels.select(sample_id, F.when(F.col("quality") == 1, "T.A.X").otherwise("T.B").alias("code")).unionByName(
        labels.where("toxic = 1").select(sample_id, F.lit("T.C.Y").alias("code"))
    )
    found = label_metrics(membership(decoded(spark, sf_dir), "exact"), gold)
    return found.select("tp", "fp", "fn", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "micro_f1")])


@query("last_pool", f"""
WITH tokens AS (SELECT label AS doc, vec_id AS pos, vec_id % 3 AS token_id, embedding AS vec FROM embeddings)
SELECT doc, round(list_sum(list_transform(v, lambda x: x::DOUBLE)), 4) AS total, round(v[1]::DOUBLE, 6) AS first, round(v[64]::DOUBLE, 6) AS last
FROM (SELECT doc, coalesce(arg_max(vec, pos) FILTER (WHERE token_id <> {PAD}), arg_min(vec, pos)) AS v FROM tokens GROUP BY doc)""")
def pooled_last(spark, sf_dir):
    return _shown(last_pool(token_vectors(spark, sf_dir), key="doc", pad=PAD))


def _shown(pooled):
    total = F.aggregate("pooled", F.lit(0.0), lambda s, x: s + x.cast("double"))
    ends = [F.round(F.element_at("pooled", i).cast("double"), 6).alias(n) for i, n in ((1, "first"), (-1, "last"))]
    return pooled.select("doc", F.round(total, 4).alias("total"), *ends)


MEAN_SQL = f"""
WITH tokens AS (SELECT label AS doc, vec_id % 3 AS token_id, embedding AS vec FROM embeddings),
cells AS (SELECT doc, unnest(range(1, 65)) AS d, unnest(vec)::DOUBLE AS x FROM tokens WHERE token_id <> {PAD}),
means AS (SELECT doc, d, avg(x)::FLOAT::DOUBLE AS m FROM cells GROUP BY doc, d)
SELECT doc, round(sum(m), 4) AS total, round(max(m) FILTER (WHERE d = 1), 6) AS first, round(max(m) FILTER (WHERE d = 64), 6) AS last
FROM means GROUP BY doc"""


@query("mean_pool", MEAN_SQL)
def pooled_mean(spark, sf_dir):
    tokens = token_vectors(spark, sf_dir).withColumn("mask", F.col("token_id") != PAD)
    return _shown(mean_pool(tokens, 64, key="doc"))


class TextLogits:
    """Reads the logits back from the text: a scorer whose answers can be checked."""

    def score(self, sample_ids, texts):
        import numpy as np

        rows = [np.array(t.split(","), dtype=np.float32).astype(np.float64) * LOGIT_SCALE for t in texts]
        return ScoredBatch(sample_ids, np.stack(rows).astype(np.float32))


@query("scorer_roundtrip", f"""
WITH {decode_sql()}
SELECT e.sample_id, coalesce(string_agg(k.code, '|' ORDER BY k.code), '') AS exact,
    round(max(k.score), 6) AS best_score
FROM emb e LEFT JOIN kept k ON k.sample_id = e.sample_id GROUP BY e.sample_id""")
def scorer_roundtrip(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("doc-"), F.col("vec_id")).alias("sample_id"),
        F.array_join(F.col("embedding").cast("array<string>"), ",").alias("model_input"),
    )
    result = decode_logits(score_documents(rows, TextLogits, batch_size=32), CONTRACT)
    best = F.array_max(F.map_values("exact_probabilities"))
    return result.select("sample_id", F.array_join("exact", "|").alias("exact"), F.round(best, 6).alias("best_score"))
