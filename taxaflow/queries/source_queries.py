"""Queries over inputs that are awkward to read: tables that differ, locators with repeated keys."""

from __future__ import annotations

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import functions as F

from taxaflow.functions.metadata import exact_fields
from taxaflow.operators.integrity import content_digest, file_inventory, manifest_faults
from taxaflow.operators.normalize import normalize_fields
from taxaflow.operators.scoring import prediction_columns
from taxaflow.operators.taxonomy import read_catalog
from taxaflow.plans.export import write_prediction_lines
from taxaflow.plans.prepare import prepare, shard_table, with_content_hash, write_shard_lines
from taxaflow.queries.inputs import CONTENT_SHA_SQL, DOCUMENTS_SQL, LINE_SQL, SHARD_ROWS, digest_sql, raw_records, table
from taxaflow.queries.prepare_queries import PLACED_SQL, _placed
from taxaflow.queries.registry import query
from taxaflow.session import configure, shared_dir
from taxaflow.sources import storage
from taxaflow.sources.jobs import read_job, read_manifest_file, read_prediction_lines, read_registry
from taxaflow.sources.records import read_records
from taxaflow.sources.remote import create_file


def _drifting_tables(spark, sf_dir, path):
    """Five kinds of Parquet files in one folder: columns are missing, foreign, named like the reader's own, or of other types."""
    records = raw_records(spark, sf_dir)
    kind, doc_id = F.pmod("doc_id", F.lit(5)), F.col("doc_id")
    ids = ["sample_id", "text_window"]
    everything = [*ids, "metadata_compact", "source_family", "source_locator", "raw_windowed"]
    shapes = [
        ids,
        [*everything, (doc_id * -1).alias("seq"), F.lit("/nowhere").alias("file_path"), F.lit(7).alias("block_start"),
         F.lit("mine").alias("_metadata"), F.lit(1).alias("note")],
        [*ids, "source_family", "raw_windowed", F.lit("text").alias("seq"), F.array(F.lit("other")).alias("note")],
        [*ids, "source_family", F.to_json("metadata_compact").alias("metadata_compact"), F.concat(F.lit("loc/"), doc_id).alias("source_locator")],
        [*ids, "source_family", F.struct(F.col("metadata_compact.language"), F.concat(F.lit("T"), doc_id).alias("title")).alias("metadata_compact"),
         doc_id.alias("source_locator"), F.lit(None).cast("boolean").alias("raw_windowed"), F.lit(0.5).alias("block_start")],
    ]
    for number, columns in enumerate(shapes):
        records.where(kind == number).select(*columns).write.mode("append").parquet(path)


@query("table_drift", f"""
WITH {DOCUMENTS_SQL}
SELECT sample_id, length(text_window) AS chars,
    CASE doc_id % 5 WHEN 0 THEN '' WHEN 2 THEN ''
        WHEN 4 THEN CASE WHEN metadata_compact = '{{}}' THEN '{{"title": "T' || doc_id || '"}}'
            ELSE replace(metadata_compact, '}}', ', "title": "T' || doc_id || '"}}') END
        ELSE metadata_compact END AS metadata_compact,
    CASE doc_id % 5 WHEN 0 THEN 'unspecified' ELSE source_family END AS source_family,
    CASE doc_id % 5 WHEN 1 THEN source_locator WHEN 3 THEN '"loc/' || doc_id || '"' WHEN 4 THEN doc_id::VARCHAR END AS source_locator,
    CASE WHEN doc_id % 5 IN (1, 2) THEN raw_windowed END AS raw_windowed, 0 AS faults
FROM docs""")
def table_drift(spark, sf_dir):
    path = shared_dir(spark, "drift") + ".parquet"
    _drifting_tables(spark, sf_dir, path)
    rows = exact_fields(normalize_fields(read_records(spark, path)))
    return rows.select(
        "sample_id", F.length("text_window").alias("chars"), "metadata_compact", "source_family", "source_locator",
        "raw_windowed", F.size("violations").alias("faults"),
    )


# What stands in a line, and what Python prints for it.
LOCATORS = [
    ('"source_locator":{"b":1,"a":2,"b":%d}', '{"b": %d, "a": 2}'),
    ('"source_locator":{"x":{"k":1,"j":0,"k":[%d,2]},"y":null}', '{"x": {"k": [%d, 2], "j": 0}, "y": null}'),
    ('"source_locator":{"a":[1,{"q":2,"q":3}]},"source_locator":{"b":%d}', '{"b": %d}'),
    ('"source_locator":[%d,2.50,1e3,-0,1E-7,-0.0,12345678901234567890123]', '[%d, 2.5, 1000.0, 0, 1e-07, -0.0, 12345678901234567890123]'),
    ('"source_locator":{"a":%d},"source_locator":1.0', '1.0'),
    ('"source_locator":"päth\\/%d\\t\\u00e9"', '"päth/%d\\té"'),
    ('"source_locator":[{"z":"ä, b: %d","a":[ ]} ,{"k":{ },"k":{}}]', '[{"z": "ä, b: %d", "a": []}, {"k": {}}]'),
    ('"source_locator":{"z":1,"m":{"y":"a:b","x":%d},"a":true}', '{"z": 1, "m": {"y": "a:b", "x": %d}, "a": true}'),
    ('"source_locator":null', None),
    ('"other":%d', None),
]


def _locator_sql() -> str:
    cases = []
    for number, (_, printed) in enumerate(LOCATORS):
        value = "NULL" if printed is None else "'" + printed.replace("%d", "' || doc_id || '") + "'"
        cases.append(f"WHEN {number} THEN {value}")
    return f"CASE doc_id % {len(LOCATORS)} {' '.join(cases)} END"


@query("locators", f"""
SELECT 'doc-' || doc_id AS sample_id, {_locator_sql()} AS source_locator, {_locator_sql()} AS read_back FROM documents""")
def locators(spark, sf_dir):
    """Locators with repeated keys at every depth, read from lines, written to prediction lines and read again."""
    configure(spark)
    doc_id = F.col("doc_id").cast("string")
    planted = F.lit(None).cast("string")
    for number, (written, _) in enumerate(LOCATORS):
        before, _, after = written.partition("%d")
        value = F.concat(F.lit(before), doc_id, F.lit(after)) if "%d" in written else F.lit(written)
        planted = F.when(F.pmod("doc_id", F.lit(len(LOCATORS))) == number, value).otherwise(planted)
    body = F.to_json(F.struct(F.concat(F.lit("doc-"), doc_id).alias("sample_id"), F.col("text").alias("text_window")))
    line = F.concat(F.substring(body, F.lit(1), F.length(body) - 1), F.lit(","), planted, F.lit("}"))
    source, lines, kept = (shared_dir(spark, what) for what in ("locators", "prediction-lines", "found-locators"))
    table(spark, sf_dir, "documents").select(line.alias("value")).write.text(source)
    rows = exact_fields(normalize_fields(read_records(spark, source)))
    # Stored, so that the lines with their texts are parsed once, not for the filter, the line files and the join each.
    stored = storage.write_table(rows.select("sample_id", "source_locator", F.size("violations").alias("faults")), kept)
    found = stored.where("faults = 0").drop("faults")
    write_prediction_lines(prediction_columns(found.withColumn("exact", F.array().cast("array<string>"))), lines)
    again = read_prediction_lines(spark, lines).select("sample_id", F.col("source_locator").alias("read_back"))
    return found.join(again, "sample_id", "left")


@query("line_file_digest", f"""
WITH {PLACED_SQL}, lines AS (SELECT shard_index, doc_pos, {LINE_SQL} || chr(10) AS line FROM placed)
SELECT printf('shard-%06d', shard_index) AS id, sum(octet_length(encode(line)))::BIGINT AS bytes,
    sha256(string_agg(line, '' ORDER BY doc_pos)) AS sha256 FROM lines GROUP BY shard_index""")
def line_file_digest(spark, sf_dir):
    """One ordered line file for each shard, hashed as it lies on disk."""
    path = shared_dir(spark, "line-files")
    write_shard_lines(_placed(spark, sf_dir), path)
    files = file_inventory(spark, path, glob="*.txt")
    return files.select(F.regexp_extract("path", "shard_id=([^/]+)/", 1).alias("id"), "bytes", "sha256")


@query("quarantined_shards", f"""
WITH {DOCUMENTS_SQL}, kept AS (
    SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM docs WHERE doc_id % 7 <> 3)
SELECT printf('shard-%06d', pos // {SHARD_ROWS}) AS id, count(*) AS rows, min(pos) AS first_pos, max(pos) AS last_pos,
    {digest_sql(CONTENT_SHA_SQL)} AS digest FROM kept GROUP BY pos // {SHARD_ROWS}""")
def quarantined_shards(spark, sf_dir):
    """A job whose input holds a bad record in every seven; the others are numbered without holes."""
    source, path = shared_dir(spark, "with-faults"), shared_dir(spark, "quarantined")
    # Files of ranges of doc_id: their names rise with it, in whatever order the table's files are read.
    records = raw_records(spark, sf_dir).orderBy("doc_id")
    blank = F.when(F.pmod("doc_id", F.lit(7)) == 3, F.lit("  ")).otherwise(F.col("text_window"))
    records.withColumn("text_window", blank).drop("doc_id").write.json(source)
    prepare(spark, source, path, shard_rows=SHARD_ROWS, on_error="quarantine")
    job = read_job(spark, path)
    places = job.documents.groupBy("shard_index").agg(F.min("input_pos").alias("first_pos"), F.max("input_pos").alias("last_pos"))
    return job.shards.join(places, "shard_index").select("id", "rows", "first_pos", "last_pos", "digest")


@query("manifest_file", f"""
WITH {PLACED_SQL}
SELECT printf('shard-%06d', shard_index) AS id, printf('inputs/shard-%06d.jsonl', shard_index) AS path, count(*) AS rows,
    sum(row_bytes)::BIGINT AS bytes, {digest_sql("row_sha")} AS sha256, (SELECT count(*) FROM documents) AS job_rows, 0 AS faults
FROM placed GROUP BY shard_index""")
def manifest_file(spark, sf_dir):
    """A manifest that is one JSON document, read back as its record and its shards, and checked."""
    path = shared_dir(spark, "manifest")
    shards = shard_table(with_content_hash(_placed(spark, sf_dir)))
    listed = F.sort_array(F.collect_list(F.struct("id", "path", "rows", "bytes", F.col("digest").alias("sha256"))))
    job = shards.agg(F.sum("rows").alias("rows"), listed.alias("shards"))
    record = F.struct(F.lit("any-v1").alias("format"), "rows", F.lit(SHARD_ROWS).alias("shard_rows"), F.lit("window").alias("input_scope"), "shards")
    job.select(F.to_json(record).alias("value")).coalesce(1).write.text(path)
    head, found = read_manifest_file(spark, path)
    total = head.first()["rows"]
    return found.withColumn("job_rows", F.lit(total)).withColumn("faults", F.lit(manifest_faults(found, total).count()))


@query("catalog_file", """
SELECT 'C.' || upper(source) AS code, 'C' AS parent, source AS label, 'written by "' || source || '"' AS definition
FROM documents WHERE source IS NOT NULL GROUP BY source""")
def catalog_file(spark, sf_dir):
    """A catalog as one JSON map, read back as a table."""
    path = shared_dir(spark, "catalog")
    sources = table(spark, sf_dir, "documents").where("source IS NOT NULL").select("source").distinct()
    entry = F.struct(F.col("source").alias("label"), F.lit("C").alias("parent"), F.concat(F.lit('written by "'), "source", F.lit('"')).alias("prompt_definition"))
    named = F.struct(F.concat(F.lit("C."), F.upper("source")), entry)
    sources.agg(F.map_from_entries(F.collect_list(named)).alias("m")).select(F.to_json("m")).coalesce(1).write.text(path)
    return read_catalog(spark, path)


@query("registry_files", """
SELECT 'docs/' || doc_id || '.txt' AS path, octet_length(encode(text))::BIGINT AS bytes, sha256(text) AS sha256 FROM documents""")
def registry_files(spark, sf_dir):
    """Registries of 64 files each, as JSON maps in files of their own."""
    path = shared_dir(spark, "registries")
    docs = table(spark, sf_dir, "documents")
    entry = F.struct(F.octet_length("text").alias("bytes"), F.sha2("text", 256).alias("sha256"))
    named = F.struct(F.concat(F.lit("docs/"), F.col("doc_id").cast("string"), F.lit(".txt")), entry)
    groups = docs.groupBy(F.floor(F.col("doc_id") / 64).alias("part")).agg(F.map_from_entries(F.collect_list(named)).alias("files"))
    groups.select("part", F.to_json(F.struct("files"))).repartition("part").write.partitionBy("part").text(path)
    return read_registry(spark, path)


def _write_frames(folder, suffix):
    """Writes a task's lines as one file of several zstd frames; a task done again replaces its file."""
    def write(batches):
        number = TaskContext.get().partitionId()
        squeeze, count = zstandard.ZstdCompressor(), 0
        with create_file(f"{folder}/part-{number:05d}.jsonl.{suffix}") as out:
            for batch in batches:
                for begin in range(0, batch.num_rows, 100):
                    lines = batch.column(0).slice(begin, 100).to_pylist()
                    out.write(squeeze.compress("".join(f"{x}\n" for x in lines).encode()))
                    count += len(lines)
        yield pa.RecordBatch.from_arrays([pa.array([count], pa.int64())], ["lines"])

    return write


@query("zstd_sources", f"""
WITH {DOCUMENTS_SQL}
SELECT suffix, count(*) AS documents, {digest_sql(CONTENT_SHA_SQL)} AS digest
FROM docs JOIN (VALUES ('zst'), ('zstd')) AS f(suffix) ON true GROUP BY suffix""")
def zstd_sources(spark, sf_dir):
    """Lines in zstd files of several frames, under both suffixes."""
    lines = raw_records(spark, sf_dir).drop("doc_id").select(F.to_json(F.struct("*")).alias("value"))
    results = []
    for suffix in ("zst", "zstd"):
        folder = shared_dir(spark, suffix)
        storage.make_dir(spark, folder)
        lines.mapInArrow(_write_frames(folder, suffix), "lines bigint").agg(F.sum("lines")).collect()
        read = with_content_hash(normalize_fields(read_records(spark, folder))).withColumn("suffix", F.lit(suffix))
        results.append(content_digest(read, ["suffix"], "row_sha256", "row_bytes").select("suffix", F.col("rows").alias("documents"), "digest"))
    return results[0].unionByName(results[1])
