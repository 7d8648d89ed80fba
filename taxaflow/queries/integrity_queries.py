"""Queries over shards, receipts, registries and references."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaflow.operators.decode import decode_logits
from taxaflow.operators.integrity import (
    dangling, file_inventory, file_set_digest, key_mismatch, missing_required, pending_shards, receipt_audit,
    registry_audit,
)
from taxaflow.operators.memberships import membership
from taxaflow.operators.taxonomy import table_difference
from taxaflow.plans.prepare import shard_table, with_content_hash
from taxaflow.queries.inputs import CONTRACT, decode_sql, digest_sql, documents, logits, table
from taxaflow.queries.prepare_queries import PLACED_SQL, _placed
from taxaflow.queries.registry import query

SHARDS_SQL = f"""{PLACED_SQL}, shards AS (
    SELECT shard_index, printf('shard-%06d', shard_index) AS id, count(*) AS rows, {digest_sql("row_sha")} AS digest
    FROM placed GROUP BY shard_index)"""


def _shards(spark, sf_dir):
    return shard_table(with_content_hash(_placed(spark, sf_dir)))


def _receipts(shards):
    """Receipts with planted faults: some missing, some foreign, some for other input."""
    rest = F.col("shard_index") % 5
    return shards.where(rest != 1).select(
        F.when(rest == 2, F.concat(F.col("id"), F.lit("9"))).otherwise(F.col("id")).alias("id"),
        F.when(rest == 3, F.col("rows") + 1).otherwise(F.col("rows")).alias("rows"),
        F.col("digest").alias("input_digest"),
        F.sha2("digest", 256).alias("predictions_digest"),
    )


@query("pending_shards", f"""
WITH {SHARDS_SQL}
SELECT id, rows FROM shards WHERE shard_index % 5 IN (1, 2)""")
def pending(spark, sf_dir):
    shards = _shards(spark, sf_dir)
    return pending_shards(shards, _receipts(shards)).select("id", "rows")


@query("provenance_check", f"""
WITH {SHARDS_SQL}
SELECT id, CASE shard_index % 5 WHEN 1 THEN 'pending' WHEN 2 THEN 'pending' WHEN 3 THEN 'provenance_mismatch'
    WHEN 4 THEN 'corrupt' ELSE 'complete' END AS status FROM shards
UNION ALL SELECT id || '9', 'unknown_shard' FROM shards WHERE shard_index % 5 = 2""")
def provenance_check(spark, sf_dir):
    shards = _shards(spark, sf_dir)
    observed = shards.select(
        "id", "rows", F.when(F.col("shard_index") % 5 == 4, "other").otherwise(F.sha2("digest", 256)).alias("digest")
    )
    return receipt_audit(shards, _receipts(shards), observed)


@query("identity_check", """
SELECT 'doc-' || doc_id AS sample_id, 'left' AS side FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)
UNION ALL SELECT 'doc-' || vec_id, 'right' FROM embeddings WHERE vec_id NOT IN (SELECT doc_id FROM documents)""")
def identity_check(spark, sf_dir):
    """Documents without logits and logits without documents."""
    return key_mismatch(documents(spark, sf_dir), logits(spark, sf_dir), "sample_id")


def _files(spark, sf_dir):
    """Every document seen as a file."""
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit("docs/"), "source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"),
        F.octet_length("text").cast("bigint").alias("bytes"), F.sha2("text", 256).alias("sha256"),
    )


@query("registry_audit", """
SELECT CASE WHEN doc_id % 10 = 4 THEN '../' || path ELSE path END AS path,
    CASE doc_id % 10 WHEN 1 THEN 'missing' WHEN 2 THEN 'unregistered' WHEN 3 THEN 'changed' WHEN 4 THEN 'unsafe_path'
    ELSE 'ok' END AS status
FROM (SELECT doc_id, 'docs/' || source || '/' || doc_id || '.txt' AS path FROM documents)""")
def audit(spark, sf_dir):
    files, rest = _files(spark, sf_dir), F.col("doc_id") % 10
    path = F.when(rest == 4, F.concat(F.lit("../"), "path")).otherwise(F.col("path")).alias("path")
    registry = files.where(rest != 2).select(path, "bytes", "sha256")
    changed = F.when(rest == 3, F.sha2(F.concat("sha256", F.lit("x")), 256)).otherwise(F.col("sha256")).alias("sha256")
    return registry_audit(registry, files.where(rest != 1).select(path, "bytes", changed))


@query("required_files", """
SELECT 'docs/' || source || '/' || doc_id || '.txt' AS path FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def required_files(spark, sf_dir):
    """Documents whose file no label registers."""
    files = _files(spark, sf_dir)
    registered = files.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi").select("path")
    return missing_required(files, registered)


@query("file_set_digest", f"""
SELECT count(*) AS rows, sum(octet_length(encode(text)))::BIGINT AS bytes,
    {digest_sql("sha256('docs/' || source || '/' || doc_id || '.txt' || chr(10) || sha256(text))")} AS digest FROM documents""")
def set_digest(spark, sf_dir):
    return file_set_digest(_files(spark, sf_dir))


@query("file_inventory")
def inventory(spark, sf_dir):
    """Hashes of the given Parquet files themselves."""
    return file_inventory(spark, sf_dir, glob="*.parquet")


@query("reference_check", f"""
WITH {decode_sql()}
SELECT k.sample_id, k.code FROM kept k WHERE k.sample_id NOT IN (SELECT 'doc-' || doc_id FROM labels)""")
def reference_check(spark, sf_dir):
    """Memberships that point at no labelled document."""
    rows = membership(decode_logits(logits(spark, sf_dir), CONTRACT), "exact")
    known = table(spark, sf_dir, "labels").select(F.concat(F.lit("doc-"), F.col("doc_id")).alias("sample_id"))
    return dangling(rows, known, "sample_id").select("sample_id", "code")


@query("layout_diff", """
SELECT path, CASE side WHEN 'l' THEN 'left' ELSE 'right' END AS side, sha256 FROM (
    SELECT source || '/' || doc_id AS path, 'l' AS side, sha256(text) AS sha256 FROM documents WHERE n_chars % 3 = 0
    UNION ALL SELECT source || '/' || doc_id, 'r', sha256(text || '!') FROM documents WHERE n_chars % 3 = 0)""")
def layout_diff(spark, sf_dir):
    """Two registries that differ wherever a text was changed."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat("source", F.lit("/"), F.col("doc_id").cast("string")).alias("path")
    left = docs.select(path, F.sha2("text", 256).alias("sha256"))
    changed = F.when(F.col("n_chars") % 3 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    return table_difference(left, docs.select(path, F.sha2(changed, 256).alias("sha256")))
