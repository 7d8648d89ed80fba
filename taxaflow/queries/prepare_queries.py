"""Queries over documents before scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaflow.functions.metadata import with_canonical_metadata
from taxaflow.functions.json_text import strict_json, variant_type
from taxaflow.functions.text import VISIBLE_TOKENS, reread_metadata, token_ids_sha256, words
from taxaflow.operators.duplicates import duplicate_keys, repeated_ids
from taxaflow.operators.integrity import content_digest, is_safe_path, manifest_faults
from taxaflow.operators.normalize import normalize, normalize_fields, record_line
from taxaflow.operators.scoring import prepare_inputs, with_model_input
from taxaflow.operators.sharding import (
    batch_number, forwards, shard_id, shard_index, split_offsets, with_position, worker,
)
from taxaflow.plans.prepare import shard_table, with_content_hash
from taxaflow.queries.inputs import (
    CONTENT_BYTES_SQL, CONTENT_SHA_SQL, DOCUMENTS_SQL, LINE_SQL, MODEL_INPUT_SQL, SHARD_ROWS, WORDS_SQL, digest_sql, documents, raw_records, table,
)
from taxaflow.queries.registry import query
from taxaflow.session import configure, shared_dir
from taxaflow.sources.records import fields_from_columns, read_records

SPLIT = ["file_path", "block_start"]


@query("normalize_documents", f"""
WITH {DOCUMENTS_SQL}
SELECT sample_id, length(text_window) AS chars, metadata_compact, source_family, source_locator, raw_windowed,
    CASE WHEN sample_id = '' OR NOT regexp_matches(text_window, '[^\\s\\x1c-\\x1f\\x85\\p{{Z}}]') THEN 1 ELSE 0 END AS faults
FROM docs""")
def normalize_documents(spark, sf_dir):
    return documents(spark, sf_dir).select(
        "sample_id", F.length("text_window").alias("chars"), "metadata_compact", "source_family", "source_locator",
        "raw_windowed", F.size("violations").alias("faults"),
    )


@query("record_lines", f"""
WITH {DOCUMENTS_SQL}
SELECT sample_id, sha256({LINE_SQL}) AS line_sha256, octet_length(encode({LINE_SQL})) AS line_bytes FROM docs""")
def record_lines(spark, sf_dir):
    """Documents as JSON lines, byte for byte."""
    lines = documents(spark, sf_dir).select("sample_id", record_line().alias("line"))
    return lines.select("sample_id", F.sha2("line", 256).alias("line_sha256"), F.octet_length("line").alias("line_bytes"))


def _faulty_lines(spark, sf_dir):
    """Every document as a JSON line, with a fault planted in most of them."""
    doc_id = F.col("doc_id")
    text = F.to_json(F.struct(F.col("text").alias("t")))
    body = F.substring(text, F.lit(6), F.length(text) - 6)  # the escaped text with its quotes
    record = lambda i, t, more: F.concat(F.lit('{"sample_id":'), i, F.lit(',"text_window":'), t, more, F.lit("}"))
    name = F.concat(F.lit('"doc-'), doc_id, F.lit('"'))
    none = F.lit("")
    kind = F.pmod(doc_id, F.lit(16))
    line = (
        F.when(kind == 0, record(doc_id.cast("string"), body, none))
        .when(kind == 1, record(F.lit('""'), body, none))
        .when(kind == 2, record(name, F.lit('" \\u00a0\\u3000\\u001c"'), none))
        .when(kind == 3, record(name, F.lit("null"), none))
        .when(kind == 4, record(name, body, F.lit(',"raw_windowed":1')))
        .when(kind == 5, record(name, body, F.lit(',"raw_windowed":"true"')))
        .when(kind == 6, F.concat(record(name, body, none), F.lit(" trailing")))
        .when(kind == 7, F.concat(F.lit("["), record(name, body, none), F.lit("]")))
        .when(kind == 8, F.concat(F.lit('{"sample_id":'), name))
        .when(kind == 9, F.lit("  　 "))
        .when(kind == 10, record(name, body, F.lit(',"source_family":7')))
        .when(kind == 11, record(name, body, F.lit(',"sample_id":"again","raw_windowed":null,"source_family":false')))
        .when(kind == 12, record(name, body, F.lit(',"extra":NaN,"raw_windowed":true')))
        .otherwise(record(name, body, none))
    )
    return table(spark, sf_dir, "documents").select(line.alias("value"))


@query("reject_report", """
SELECT violation, count(*) AS records FROM (
    SELECT CASE
        WHEN doc_id % 16 <> 9 AND octets > 20000 THEN 'record_too_large'
        WHEN doc_id % 16 IN (0, 1) THEN 'bad_sample_id'
        WHEN doc_id % 16 IN (2, 3) THEN 'bad_text'
        WHEN doc_id % 16 IN (4, 5) THEN 'bad_raw_windowed'
        WHEN doc_id % 16 IN (6, 8) THEN 'malformed_json'
        WHEN doc_id % 16 = 7 THEN 'not_an_object'
        WHEN doc_id % 16 = 10 THEN 'bad_source_family'
        ELSE 'none' END AS violation
    FROM (
        SELECT doc_id, 1 + CASE doc_id % 16
            WHEN 2 THEN length('{"sample_id":"doc-' || doc_id || '","text_window":" \\u00a0\\u3000\\u001c"}')
            WHEN 3 THEN length('{"sample_id":"doc-' || doc_id || '","text_window":null}')
            WHEN 8 THEN length('{"sample_id":"doc-' || doc_id || '"')
            ELSE length(to_json(text)::VARCHAR) + length('{"sample_id":,"text_window":}') + CASE doc_id % 16
                WHEN 0 THEN length(doc_id::VARCHAR)
                WHEN 1 THEN 2
                ELSE length('"doc-' || doc_id || '"') END
                + CASE doc_id % 16
                WHEN 4 THEN length(',"raw_windowed":1')
                WHEN 5 THEN length(',"raw_windowed":"true"')
                WHEN 6 THEN length(' trailing')
                WHEN 7 THEN 2
                WHEN 10 THEN length(',"source_family":7')
                WHEN 11 THEN length(',"sample_id":"again","raw_windowed":null,"source_family":false')
                WHEN 12 THEN length(',"extra":NaN,"raw_windowed":true')
                ELSE 0 END
            END AS octets
        FROM documents WHERE doc_id % 16 <> 9)
) GROUP BY violation""")
def reject_report(spark, sf_dir):
    path = shared_dir(spark, "lines")
    _faulty_lines(spark, sf_dir).write.text(path)
    checked = normalize_fields(read_records(spark, path, max_record_chars=20_000))
    named = F.when(F.size("violations") > 0, F.get("violations", F.lit(0))).otherwise(F.lit("none"))
    return checked.groupBy(named.alias("violation")).agg(F.count(F.lit(1)).alias("records"))


@query("jsonl_sources", f"""
WITH {DOCUMENTS_SQL}
SELECT format, count(*) AS documents, sum(length(text_window))::BIGINT AS chars,
    {digest_sql(CONTENT_SHA_SQL)} AS digest
FROM docs JOIN (VALUES ('plain'), ('gzip'), ('parquet')) AS f(format) ON true GROUP BY format""")
def jsonl_sources(spark, sf_dir):
    """The same records through every reader."""
    base = shared_dir(spark, "formats")
    records = raw_records(spark, sf_dir).drop("doc_id")
    results = []
    for name, codec in (("plain", "none"), ("gzip", "gzip"), ("parquet", None)):
        path = f"{base}/{name}" + ("" if codec else ".parquet")
        if codec:
            records.write.option("compression", codec).json(path)
        else:
            records.write.parquet(path)
        read = with_content_hash(normalize_fields(read_records(spark, path))).withColumn("format", F.lit(name))
        chars = F.sum(F.length("text_window")).alias("chars")
        totals = content_digest(read, ["format"], "row_sha256", "row_bytes", (chars,))
        results.append(totals.select("format", F.col("rows").alias("documents"), "chars", "digest"))
    out = results[0]
    for one in results[1:]:
        out = out.unionByName(one)
    return out


@query("renamed_columns", """
SELECT url AS sample_id, length(html) AS chars, '' AS metadata_compact, 'unspecified' AS source_family FROM pages""")
def renamed_columns(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return normalize(pages, id_field="url", text_field="html").where(F.size("violations") == 0).select(
        "sample_id", F.length("text_window").alias("chars"), "metadata_compact", "source_family"
    )


def _metadata_records(spark, sf_dir, *keep):
    """Metadata as JSON text: every text is a title, some with overlay, falsy and foreign keys."""
    rest = F.pmod(F.col("doc_id"), F.lit(4))
    title = F.when(F.col("doc_id") % 8 == 7, "").otherwise(F.col("text"))
    top = F.struct(title.alias("title"), F.col("lang").alias("language"), F.lit("").alias("publisher"),
                   F.col("n_chars").alias("date"), F.col("source").alias("origin"))
    overlay = F.struct(F.upper("lang").alias("language"), F.lit(0).alias("date"), F.lit(True).alias("format_family"))
    both = F.struct("top.*", F.col("overlay").alias("metadata_subset"))
    text = (
        F.when(rest == 0, F.to_json("top")).when(rest == 1, F.to_json(both))
        .when(rest == 2, F.concat(F.lit("["), F.to_json("top"), F.lit("]"))).otherwise(F.to_json("top"))
    )
    docs = table(spark, sf_dir, "documents").withColumn("top", top).withColumn("overlay", overlay)
    return docs.select("doc_id", *keep, text.alias("metadata"))


METADATA_SQL = """meta AS (
    SELECT doc_id, CASE WHEN doc_id % 4 = 2 THEN '' ELSE '{' || array_to_string(list_filter([
        '"date": ' || n_chars,
        CASE WHEN doc_id % 4 = 1 THEN '"format_family": true' END,
        CASE WHEN lang <> '' THEN '"language": ' || to_json(CASE WHEN doc_id % 4 = 1 THEN upper(lang) ELSE lang END)::VARCHAR END,
        CASE WHEN doc_id % 8 <> 7 THEN '"title": ' || to_json(text)::VARCHAR END
        ], lambda x: x IS NOT NULL), ', ') || '}' END AS full_text
    FROM documents), stored AS (SELECT doc_id, full_text, substr(full_text, 1, 1200) AS metadata_compact FROM meta)"""


@query("canonical_metadata", f"""
WITH {METADATA_SQL}
SELECT doc_id, length(metadata_compact) AS chars, sha256(metadata_compact) AS metadata_sha256 FROM stored""")
def canonical_metadata(spark, sf_dir):
    configure(spark)
    parsed = _metadata_records(spark, sf_dir).withColumn("metadata", strict_json(F.col("metadata")))
    return with_canonical_metadata(parsed, "metadata").select(
        "doc_id", F.length("metadata_compact").alias("chars"), F.sha2("metadata_compact", 256).alias("metadata_sha256")
    )


@query("metadata_at_scoring", f"""
WITH {METADATA_SQL}
SELECT doc_id, sha256(CASE WHEN length(full_text) > 1200 THEN '' ELSE full_text END) AS metadata_sha256,
    length(full_text) > 1200 AS lost FROM stored""")
def metadata_at_scoring(spark, sf_dir):
    """Clipped metadata is no JSON any more and is lost at scoring time."""
    configure(spark)
    parsed = _metadata_records(spark, sf_dir).withColumn("metadata", strict_json(F.col("metadata")))
    stored = with_canonical_metadata(parsed, "metadata")
    again = stored.withColumn("again", reread_metadata(F.col("metadata_compact")))
    return again.select(
        "doc_id", F.sha2("again", 256).alias("metadata_sha256"),
        ((F.col("again") == "") & (F.col("metadata_compact") != "")).alias("lost"),
    )


@query("raw_model_input", f"""
WITH {METADATA_SQL}
SELECT d.doc_id, sha256('[DOCUMENT METADATA]' || chr(10) || s.metadata_compact || chr(10) || chr(10) || '[DOCUMENT]' || chr(10)
    || d.text) AS model_input_sha256 FROM documents d JOIN stored s ON s.doc_id = d.doc_id""")
def raw_model_input(spark, sf_dir):
    """Model input straight from raw text and raw metadata."""
    configure(spark)
    return prepare_inputs(_metadata_records(spark, sf_dir, "text")).select("doc_id", F.sha2("model_input", 256).alias("model_input_sha256"))


@query("model_input_hash", f"""
WITH {MODEL_INPUT_SQL}
SELECT sample_id, sha256(text_window) AS stored_text_sha256, sha256(model_input) AS model_input_sha256 FROM inputs""")
def model_input_hash(spark, sf_dir):
    return with_model_input(documents(spark, sf_dir), tokenize=False).select(
        "sample_id", "stored_text_sha256", "model_input_sha256"
    )


@query("token_window", f"""
WITH {MODEL_INPUT_SQL}, tokens AS (SELECT sample_id, {WORDS_SQL.format("model_input")} AS t FROM inputs)
SELECT sample_id, len(t)::BIGINT AS input_tokens, least(len(t), 768)::BIGINT AS visible_tokens, len(t) > 768 AS truncated,
    'supplied_window_prefix_768' AS input_scope, sha256(array_to_string(t[1:768], ' ')) AS visible_sha256
FROM tokens""")
def token_window(spark, sf_dir):
    ready = with_model_input(documents(spark, sf_dir))
    visible = F.slice(words(F.col("model_input")), 1, VISIBLE_TOKENS)
    return ready.select(
        "sample_id", "input_tokens", "visible_tokens", "truncated", "input_scope",
        F.sha2(F.array_join(visible, " "), 256).alias("visible_sha256"),
    )


@query("id_list_hash", """
SELECT vec_id, sha256('[' || array_to_string(list_transform(embedding, lambda x: floor(x::DOUBLE * 1000)::BIGINT), ',') || ']')
    AS token_ids_sha256 FROM embeddings""")
def id_list_hash(spark, sf_dir):
    """The hash of a list of token IDs, on the integer parts of the vectors."""
    ids = F.transform("embedding", lambda x: F.floor(x.cast("double") * 1000).cast("bigint"))
    return table(spark, sf_dir, "embeddings").select("vec_id", token_ids_sha256(ids).alias("token_ids_sha256"))


@query("duplicate_ids", """
SELECT conv_id, count(*) AS copies FROM conversations GROUP BY conv_id HAVING count(*) > 1""")
def duplicate_ids(spark, sf_dir):
    return duplicate_keys(table(spark, sf_dir, "conversations"), ["conv_id"])


@query("duplicate_texts", """
SELECT sha256(text) AS text_sha256, count(*) AS copies FROM documents GROUP BY text HAVING count(*) > 1""")
def duplicate_texts(spark, sf_dir):
    hashed = table(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("text_sha256"))
    return duplicate_keys(hashed, ["text_sha256"])


@query("repeated_ids", """
SELECT DISTINCT conv_id::VARCHAR AS sample_id FROM conversations c
WHERE EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = c.conv_id)
    OR (SELECT count(*) FROM conversations x WHERE x.conv_id = c.conv_id) > 1""")
def repeated(spark, sf_dir):
    """IDs of a new batch that are doubled or were committed before."""
    batch = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("sample_id"))
    committed = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("sample_id"))
    return repeated_ids(batch, committed)


def _placed(spark, sf_dir, shard_rows=SHARD_ROWS):
    records = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.concat(F.lit("doc-"), F.col("doc_id")).alias("sample_id"),
        F.col("text").alias("text_window"),
        F.struct(F.col("lang").alias("language")).alias("metadata_compact"),
        F.col("source").alias("source_family"),
        F.struct(F.lit("documents").alias("table"), "doc_id").alias("source_locator"),
        F.when(F.pmod("doc_id", F.lit(5)) == 0, True).when(F.pmod("doc_id", F.lit(5)) == 1, None).otherwise(False).alias("raw_windowed"),
        F.col("_metadata.file_path").alias("file_path"),
        F.lit(0).cast("bigint").alias("block_start"),
        F.col("_metadata.row_index").alias("seq"),
    )
    fields = fields_from_columns(records, "sample_id", "text_window", keep=[*SPLIT, "seq"])
    docs = normalize_fields(fields)
    sizes = split_offsets(spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.col("_metadata.file_path").alias("file_path"), F.lit(0).cast("bigint").alias("block_start"),
        F.col("_metadata.row_index").alias("seq")), SPLIT)
    placed = with_position(docs, sizes, SPLIT)
    return placed.withColumn("shard_index", shard_index(F.col("input_pos"), shard_rows))


PLACED_SQL = DOCUMENTS_SQL + f""", placed AS (
    SELECT *, doc_pos // {SHARD_ROWS} AS shard_index, {CONTENT_SHA_SQL} AS row_sha, {CONTENT_BYTES_SQL} AS row_bytes
    FROM (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS doc_pos FROM docs))"""


@query("shard_manifest", f"""
WITH {PLACED_SQL}
SELECT printf('shard-%06d', shard_index) AS id, printf('inputs/shard-%06d.jsonl', shard_index) AS path, count(*) AS rows,
    sum(row_bytes)::BIGINT AS bytes, {digest_sql("row_sha")} AS digest
FROM placed GROUP BY shard_index""")
def shard_manifest(spark, sf_dir):
    return shard_table(with_content_hash(_placed(spark, sf_dir))).drop("shard_index")


@query("shard_manifest_check", f"""
WITH {PLACED_SQL}, shards AS (SELECT shard_index, count(*) AS n FROM placed GROUP BY shard_index)
SELECT printf('shard-%06d', CASE WHEN shard_index % 4 = 1 THEN shard_index - 1 ELSE shard_index END) AS id,
    CASE shard_index % 4 WHEN 2 THEN 'unexpected_path' WHEN 3 THEN 'invalid_rows' WHEN 1 THEN 'duplicate_id' END AS fault
FROM shards WHERE shard_index % 4 <> 0
UNION ALL SELECT printf('shard-%06d', shard_index - 1), 'unexpected_path' FROM shards WHERE shard_index % 4 = 1
UNION ALL SELECT NULL, 'row_count_mismatch' FROM (SELECT 1) WHERE EXISTS (SELECT 1 FROM shards WHERE shard_index % 4 = 3)""")
def shard_manifest_check(spark, sf_dir):
    """The manifest rules on a shard table with planted faults."""
    shards = _placed(spark, sf_dir).groupBy("shard_index").agg(F.count(F.lit(1)).alias("rows"))
    index, rest = F.col("shard_index"), F.col("shard_index") % 4
    identifier = F.when(rest == 1, shard_id(index - 1)).otherwise(shard_id(index))
    planted = shards.select(
        identifier.alias("id"),
        F.when(rest == 2, F.lit("../inputs/x.jsonl")).otherwise(F.concat(F.lit("inputs/"), shard_id(index), F.lit(".jsonl"))).alias("path"),
        F.when(rest == 3, 0).otherwise(F.col("rows")).cast("bigint").alias("rows"),
    )
    total = table(spark, sf_dir, "documents").count()
    return manifest_faults(planted, total)


@query("micro_batches", f"""
WITH {PLACED_SQL}
SELECT printf('shard-%06d', shard_index) AS shard_id, (doc_pos % {SHARD_ROWS}) // 10 AS batch, count(*) AS rows,
    min(doc_pos) AS first_pos, max(doc_pos) AS last_pos
FROM placed GROUP BY shard_index, (doc_pos % {SHARD_ROWS}) // 10""")
def micro_batches(spark, sf_dir):
    placed = _placed(spark, sf_dir)
    return placed.groupBy(
        shard_id(F.col("shard_index")).alias("shard_id"),
        batch_number(F.col("input_pos") % SHARD_ROWS, 10).alias("batch"),
    ).agg(F.count(F.lit(1)).alias("rows"), F.min("input_pos").alias("first_pos"), F.max("input_pos").alias("last_pos"))


@query("shard_workers", f"""
WITH {PLACED_SQL}, shards AS (SELECT shard_index, count(*) AS n FROM placed GROUP BY shard_index)
SELECT shard_index % 3 AS worker, count(*) AS shards, sum(n)::BIGINT AS rows, sum((n + 9) // 10)::BIGINT AS forwards
FROM shards GROUP BY shard_index % 3""")
def shard_workers(spark, sf_dir):
    shards = _placed(spark, sf_dir).groupBy("shard_index").agg(F.count(F.lit(1)).alias("n"))
    return shards.groupBy(worker(F.col("shard_index"), 3).alias("worker")).agg(
        F.count(F.lit(1)).alias("shards"), F.sum("n").alias("rows"), F.sum(forwards(F.col("n"), 10)).alias("forwards")
    )


@query("tolerant_json", """
SELECT event_id, (props::JSON ->> 'k')::BIGINT AS k, event_id % 7 <> 0 AS is_object FROM events WHERE event_id % 7 <> 0
UNION ALL SELECT event_id, NULL, false FROM events WHERE event_id % 7 = 0""")
def tolerant_json(spark, sf_dir):
    """JSON text that may be broken: no object, no value."""
    configure(spark)
    broken = F.when(F.col("event_id") % 7 == 0, F.concat("props", F.lit("}"))).otherwise(F.col("props"))
    parsed = table(spark, sf_dir, "events").select("event_id", strict_json(broken).alias("v"))
    return parsed.select(
        "event_id", F.try_variant_get("v", "$.k", "bigint").alias("k"),
        F.coalesce(variant_type(F.col("v")).startswith("OBJECT"), F.lit(False)).alias("is_object"),
    )


@query("safe_paths", """
SELECT safe, count(*) AS pages FROM (
    SELECT page_id, page_id % 6 NOT IN (1, 2, 3, 4) AS safe FROM pages) GROUP BY safe""")
def safe_paths(spark, sf_dir):
    plain = F.regexp_replace("url", "^https?://", "")
    rest = F.pmod("page_id", F.lit(6))
    path = (
        F.when(rest == 1, F.concat(F.lit("../"), plain)).when(rest == 2, F.concat(F.lit("/"), plain))
        .when(rest == 3, F.concat(F.lit("a/../../"), plain)).when(rest == 4, F.concat(plain, F.lit("\\x")))
        .otherwise(plain)
    )
    checked = table(spark, sf_dir, "pages").select(is_safe_path(path).alias("safe"))
    return checked.groupBy("safe").agg(F.count(F.lit(1)).alias("pages"))


@query("dataset_digest", f"""
WITH {DOCUMENTS_SQL}
SELECT source_family, count(*) AS rows, {digest_sql(CONTENT_SHA_SQL)} AS digest FROM docs GROUP BY source_family""")
def dataset_digest(spark, sf_dir):
    hashed = with_content_hash(documents(spark, sf_dir))
    return content_digest(hashed, ["source_family"], "row_sha256", "row_bytes").drop("bytes")
