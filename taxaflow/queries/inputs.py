"""Inputs of the queries: the given tables seen as records, logits and tokens.

Each function has its SQL twin, so every check states the same inputs itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaflow.operators.normalize import normalize
from taxaflow.operators.taxonomy import STATE_LABELS, HeadContract

LOGIT_SCALE = 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- a small head that fits the 64 values of an embedding: 5 + 25 + 25 + 9 ---

ROOTS = [f"T.{letter}" for letter in "ABCDE"]
BELOW = ["", ".X", ".X.P", ".X.Q", ".Y"]
CONTRACT = HeadContract(
    roots=ROOTS,
    exact=[root + tail for root in ROOTS for tail in BELOW],
    exact_root_indices=[i for i in range(len(ROOTS)) for _ in BELOW],
)


def _values(rows: list[tuple]) -> str:
    def one(value) -> str:
        return f"'{value}'" if isinstance(value, str) else str(value)

    return ", ".join("(" + ", ".join(map(one, row)) + ")" for row in rows)


ROOT_CODES_SQL = "root_codes(idx, code) AS (VALUES " + _values(list(enumerate(ROOTS))) + ")"
EXACT_CODES_SQL = "exact_codes(idx, code, root) AS (VALUES " + _values(
    [(i, code, ROOTS[CONTRACT.exact_root_indices[i]]) for i, code in enumerate(CONTRACT.exact)]
) + ")"


# --- documents as records ---

def flag(doc_id: Column) -> Column:
    rest = F.pmod(doc_id, F.lit(5))
    return F.when(rest == 0, F.lit(True)).when(rest == 1, F.lit(None)).otherwise(F.lit(False))


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc_id = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.concat(F.lit("doc-"), doc_id).alias("sample_id"),
        F.col("text").alias("text_window"),
        F.struct(F.col("lang").alias("language")).alias("metadata_compact"),
        F.col("source").alias("source_family"),
        F.struct(F.lit("documents").alias("table"), doc_id).alias("source_locator"),
        flag(doc_id).alias("raw_windowed"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalized documents with their ``doc_id`` and ``violations``."""
    return normalize(raw_records(spark, sf_dir), keep=["doc_id"])


DOCUMENTS_SQL = """docs AS (
    SELECT doc_id, 'doc-' || doc_id AS sample_id, text AS text_window,
        CASE WHEN lang <> '' THEN '{"language": ' || to_json(lang)::VARCHAR || '}' ELSE '{}' END AS metadata_compact,
        coalesce(nullif(source, ''), 'unspecified') AS source_family,
        '{"table": "documents", "doc_id": ' || doc_id || '}' AS source_locator,
        CASE doc_id % 5 WHEN 0 THEN true WHEN 1 THEN NULL ELSE false END AS raw_windowed
    FROM documents)"""

MODEL_INPUT_SQL = DOCUMENTS_SQL + """, inputs AS (
    SELECT *, '[DOCUMENT METADATA]' || chr(10) || metadata_compact || chr(10) || chr(10) || '[DOCUMENT]' || chr(10)
        || text_window AS model_input FROM docs)"""

WORDS_SQL = r"regexp_extract_all({}, '[^ \t\n\r\f\x0b]+')"

_PARTS = ["sample_id", "text_window", "metadata_compact", "source_family", "source_locator",
          "coalesce(raw_windowed::VARCHAR, 'null')"]
CONTENT_BYTES_SQL = "(" + " + ".join(f"octet_length(encode({p}))" for p in _PARTS) + ")"
CONTENT_SHA_SQL = "sha256(" + " || ',' || ".join(f"octet_length(encode({p}))" for p in _PARTS) + " || chr(10) || " + (
    " || ".join(_PARTS) + ")"
)

LINE_SQL = """'{"sample_id": ' || to_json(sample_id)::VARCHAR || ', "text_window": ' || to_json(text_window)::VARCHAR
    || ', "metadata_compact": ' || to_json(metadata_compact)::VARCHAR || ', "source_family": '
    || to_json(source_family)::VARCHAR || ', "source_locator": ' || source_locator || ', "raw_windowed": '
    || coalesce(raw_windowed::VARCHAR, 'null') || '}'"""

SHARD_ROWS = 64


def lane_sql(sha: str, i: int) -> str:
    return f"sum(('0x' || substr({sha}, {1 + 8 * i}, 8))::BIGINT)::VARCHAR"


def digest_sql(sha: str) -> str:
    lanes = " || ':' || ".join(lane_sql(sha, i) for i in range(4))
    return f"sha256(count(*)::VARCHAR || ':' || {lanes})"


# --- embeddings as logits ---

def logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = F.transform("embedding", lambda x: (x.cast("double") * LOGIT_SCALE).cast("float"))
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.concat(F.lit("doc-"), F.col("vec_id")).alias("sample_id"), scaled.alias("logits")
    )


LOGITS_SQL = f"""emb AS (
    SELECT vec_id, 'doc-' || vec_id AS sample_id,
        list_transform(embedding, lambda x: (x::DOUBLE * {LOGIT_SCALE})::FLOAT) AS l
    FROM embeddings)"""


def digest_logits(sha256: Column) -> Column:
    """Logits made from the digits of a hash: each of the 64 hex digits d gives (d - 7.5) / 2."""
    digit = lambda i: F.conv(F.substr(sha256, i, F.lit(1)), 16, 10).cast("double")
    return F.transform(F.sequence(F.lit(1), F.lit(64)), lambda i: ((digit(i) - 7.5) * 0.5).cast("float"))


DIGEST_LOGITS = """SELECT doc_id AS vec_id, sample_id, list_transform(range(1, 65), lambda i:
        ((strpos('0123456789abcdef', substr(sha, i, 1)) - 8.5) * 0.5)::FLOAT) AS l
    FROM (SELECT doc_id, sample_id, sha256(model_input) AS sha FROM inputs)"""
DIGEST_LOGITS_SQL = f"{MODEL_INPUT_SQL}, emb AS ({DIGEST_LOGITS})"

# Every document: its vector's logits, or those of its text where it has no vector.
ALL_LOGITS_SQL = f"""{MODEL_INPUT_SQL}, emb AS (
    SELECT vec_id, 'doc-' || vec_id AS sample_id, list_transform(embedding, lambda x: (x::DOUBLE * {LOGIT_SCALE})::FLOAT) AS l
    FROM embeddings WHERE vec_id IN (SELECT doc_id FROM documents)
    UNION ALL SELECT * FROM ({DIGEST_LOGITS}) WHERE vec_id NOT IN (SELECT vec_id FROM embeddings))"""


def sigmoid_sql(logit: str) -> str:
    return f"(1 / (1 + exp(-({logit})::DOUBLE)))::FLOAT::DOUBLE"


def decode_sql(logit_cte: str = LOGITS_SQL, exact_threshold: float = 0.95, root_threshold: float = 0.5) -> str:
    """CTEs ``root_sel, ranked, kept, best``: selection in long form, greedy per document and root."""
    return f"""{logit_cte}, {ROOT_CODES_SQL}, {EXACT_CODES_SQL},
root_sel AS (
    SELECT * FROM (
        SELECT e.sample_id, c.idx, c.code, {sigmoid_sql('e.l[c.idx + 1]')} AS score FROM emb e JOIN root_codes c ON true
    ) WHERE score >= {root_threshold}),
passing AS (
    SELECT * FROM (
        SELECT e.sample_id, c.root, c.code, {sigmoid_sql(f'e.l[c.idx + {1 + CONTRACT.exact_offset}]')} AS score
        FROM emb e JOIN exact_codes c ON true
    ) WHERE score >= {exact_threshold}),
ranked AS (
    SELECT p.*, row_number() OVER (PARTITION BY p.sample_id, p.root ORDER BY p.score DESC, p.code) AS rank
    FROM passing p JOIN root_sel r ON r.sample_id = p.sample_id AND r.code = p.root),
lists AS (
    SELECT sample_id, root, list(code ORDER BY rank) AS codes FROM ranked GROUP BY ALL),
greedy AS (
    SELECT sample_id, unnest(list_reduce(list_transform(codes, lambda c: [c]), lambda acc, c:
        CASE WHEN len(list_filter(acc, lambda k: starts_with(k, c[1] || '.') OR starts_with(c[1], k || '.'))) > 0
        THEN acc ELSE list_concat(acc, c) END)) AS code FROM lists),
kept AS (
    SELECT g.sample_id, g.code, r.score FROM greedy g JOIN ranked r ON r.sample_id = g.sample_id AND r.code = g.code)"""


def argmax_sql(values: str) -> str:
    return f"list_position({values}, list_max({values}))"


PRIMARY_SQL = "(SELECT code FROM exact_codes c WHERE c.idx + 1 = {})".format(
    argmax_sql(f"l[{CONTRACT.primary_offset + 1}:{CONTRACT.primary_offset + len(CONTRACT.exact)}]")
)


def state_sql(name: str) -> str:
    offset, labels = CONTRACT.state_offsets[name], STATE_LABELS[name]
    names = "[" + ", ".join(f"'{label}'" for label in labels) + "]"
    return f"({names})[{argmax_sql(f'l[{offset + 1}:{offset + len(labels)}]')}]"


STATE_JSON_SQL = "'{' || " + " || ', ' || ".join(
    f"'\"{name}\": \"' || {state_sql(name)} || '\"'" for name in STATE_LABELS
) + " || '}'"


# --- embeddings as token vectors of ten long documents ---

PAD = 0


def token_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``label`` plays the document, ``vec_id`` the position; every third token is padding."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("label").alias("doc"),
        F.col("vec_id").alias("pos"),
        F.pmod(F.col("vec_id"), F.lit(3)).alias("token_id"),
        F.col("embedding").alias("vec"),
    )
