"""Queries opN_<name>: each operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from taxaflow.llm.common import table
from taxaflow.llm.decontamination import contamination_digest
from taxaflow.llm.minhash import near_duplicates
from taxaflow.llm.mixing import mix_digest
from taxaflow.llm.neighbours import nearest
from taxaflow.llm.pii import personal_data_digest
from taxaflow.llm.registry import query
from taxaflow.llm.resampling import resampling_digest
from taxaflow.llm.secret_scan import fit_formats, secret_digest
from taxaflow.llm.suffix_dedup import repeat_digest
from taxaflow.llm.token_counts import token_count_table
from taxaflow.llm.toxicity import toxicity_digest
from taxaflow.llm.url_filters import url_verdicts
from taxaflow.llm.vector_codes import vector_codes
from taxaflow.llm.web_archives import archive_digest


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HASHED_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# DuckDB has no crc32: eight shifts for each byte of a distinct word.
RESAMPLING_SQL = f"""
WITH feats AS (
    SELECT 'd' AS side, doc_id AS id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{HASHED_WORD}')) AS w FROM documents
    UNION ALL SELECT 'b', item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{HASHED_WORD}')) FROM benchmark
), vocabulary AS (
    SELECT w, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, strlen(w)),
        lambda i: ('0x' || substr(hex(w), (2 * i + 1)::INT, 2))::BIGINT)),
        lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(0, 8)),
            lambda c, k: xor(c >> 1, (c & 1) * 3988292384::BIGINT))), 4294967295::BIGINT) % 10000 AS bucket
    FROM (SELECT DISTINCT w FROM feats)
), hashed AS (SELECT side, id, bucket FROM feats JOIN vocabulary USING (w)),
counts AS (SELECT bucket, count(*) FILTER (WHERE side = 'd') AS s, count(*) FILTER (WHERE side = 'b') AS t FROM hashed GROUP BY bucket),
sums AS (SELECT coalesce(sum(s), 0) AS ss, coalesce(sum(t), 0) AS tt FROM counts),
gains AS (
    SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (ss + 10000)::DOUBLE) / ((s + 1)::DOUBLE * (tt + 10000)::DOUBLE)))::BIGINT AS gain
    FROM counts, sums
), weights AS (
    SELECT id AS doc_id, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
    FROM hashed JOIN gains USING (bucket) WHERE side = 'd' GROUP BY id
), scored AS (
    SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
    FROM documents d LEFT JOIN weights USING (doc_id)
), ranked AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scored WHERE n_features >= 20
)
SELECT s.doc_id, n_features::BIGINT AS n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank
FROM scored s LEFT JOIN ranked USING (doc_id)"""

_NEAREST = """assigned{k} AS MATERIALIZED (
    SELECT vec_id, p, any_value(w) AS w, min(struct_pack(d := list_sum(list_transform(list_zip(w, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, e := e)) AS best
    FROM parts JOIN book{k} USING (p) GROUP BY vec_id, p)"""
_MOVED = """means{n} AS MATERIALIZED (
    SELECT p, best.e AS e, i, sum(w[i])::BIGINT AS s, count(*) AS n FROM assigned{k}, range(1, 9) t(i) GROUP BY p, best.e, i),
book{n} AS MATERIALIZED (
    SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book{k} b LEFT JOIN (
        SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM means{n} GROUP BY p, e) m ON b.p = m.p AND b.e = m.e)"""

VECTOR_CODES_SQL = """
WITH kept AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (SELECT vec_id, p, v[p * 8 + 1:p * 8 + 8] AS w FROM kept, range(0, 8) t(p)),
book0 AS (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, w AS c
    FROM parts WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 16)),
""" + ",\n".join(x for k in range(6) for x in (_NEAREST.format(k=k), _MOVED.format(k=k, n=k + 1))) + ",\n" + _NEAREST.format(k=6) + """,
coded AS (
    SELECT vec_id, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM assigned6 GROUP BY vec_id
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
    (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, e, i)) FROM (SELECT p, e, unnest(c) AS x, generate_subscripts(c, 1) AS i FROM book6)) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)"""

ARCHIVES_SQL = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS html, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
    list_aggregate(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        ((('0x' || substr(sha1(html), (5 * (k // 4) + 1)::INT, 5))::BIGINT >> (15 - 5 * (k % 4))) & 31)::INT + 1, 1)), 'string_agg', '') AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to
FROM payloads"""


REPEATS_SQL = """
WITH texts AS (SELECT doc_id, hex(coalesce(text, '')) AS h, strlen(coalesce(text, ''))::BIGINT AS n FROM documents),
chunks AS (SELECT doc_id, n, c, substr(h, (2 * c + 1)::INT, 610) AS ch FROM (SELECT *, unnest(range(0, n - 49, 256)) AS c FROM texts WHERE n >= 50)),
strings AS (SELECT doc_id, c + o AS k, substr(ch, (2 * o + 1)::INT, 100) AS s FROM (SELECT *, unnest(range(0, least(256, n - 49 - c))) AS o FROM chunks)),
gone AS (
    SELECT doc_id, k, lag(k) OVER (PARTITION BY doc_id ORDER BY k) AS before
    FROM strings JOIN (SELECT s, min(doc_id) AS first FROM strings GROUP BY s) USING (s) WHERE doc_id > first),
runs AS (SELECT doc_id, k, sum(CASE WHEN before IS NULL OR k > before + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY k) AS run FROM gone),
spans AS (SELECT doc_id, min(k) AS a, max(k) + 50 AS b FROM runs GROUP BY doc_id, run),
ordered AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS from_here FROM spans),
kept AS (
    SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, max(b) AS last,
        string_agg(substr(h, (2 * from_here + 1)::INT, (2 * (a - from_here))::INT), '' ORDER BY a) AS pieces
    FROM ordered JOIN texts USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
    sha256(unhex(coalesce(pieces, '') || substr(h, (2 * coalesce(last, 0) + 1)::INT))) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)"""

NEAR_SQL = f"""
WITH RECURSIVE split AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 2 THEN w ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM split),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id),
links AS (SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 80 * (p.n + q.n - c)),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT b, other FROM reach JOIN links ON a = doc_id),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM least LEFT JOIN sizes USING (doc_id)"""

LEAKS_SQL = f"""
WITH texts AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{HASHED_WORD}') AS w FROM documents),
items AS (SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{HASHED_WORD}') AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item, least(len(w), 10) AS size, array_to_string(w[i:i + 9], ' ') AS phrase
    FROM items, range(1, 100000) t(i) WHERE len(w) > 0 AND i <= greatest(len(w) - 9, 1)),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS p, w FROM texts, sizes WHERE len(w) >= size),
found AS (SELECT doc_id, p, size, item FROM (SELECT doc_id, p, size, array_to_string(w[p:p + size - 1], ' ') AS phrase FROM places) JOIN windows USING (size, phrase)),
hits AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + size)) AS place FROM found) GROUP BY doc_id),
held AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM texts LEFT JOIN hits USING (doc_id) LEFT JOIN held USING (doc_id)"""


@query("op1_url_filters")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(table(spark, sf_dir, "pages"))


@query("op4_mixing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op6_token_counts")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count_table(table(spark, sf_dir, "documents"))


@query("op7_decontamination", LEAKS_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op8_secret_scan")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return secret_digest(documents, fit_formats(documents))


@query("op9_neighbours")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


@query("op10_pii")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data_digest(table(spark, sf_dir, "documents"))


@query("op3_minhash", NEAR_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=2, threshold=0.8)


@query("op2_suffix_dedup", REPEATS_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_digest(table(spark, sf_dir, "documents"))


@query("op11_resampling", RESAMPLING_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op12_vector_codes", VECTOR_CODES_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(table(spark, sf_dir, "embeddings"))


@query("op13_web_archives", ARCHIVES_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_digest(table(spark, sf_dir, "pages"))
