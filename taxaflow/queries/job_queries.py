"""Queries that run whole jobs over the given documents."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from taxaflow.operators.integrity import content_digest, file_inventory, registry_audit
from taxaflow.operators.scoring import ScoredBatch
from taxaflow.plans.export import export, export_increments
from taxaflow.plans.prepare import prepare, source_state
from taxaflow.plans.run import run
from taxaflow.queries.inputs import (
    CONTENT_BYTES_SQL, CONTENT_SHA_SQL, CONTRACT, DIGEST_LOGITS_SQL, DOCUMENTS_SQL, PRIMARY_SQL, SHARD_ROWS, STATE_JSON_SQL, WORDS_SQL, decode_sql,
    digest_sql, raw_records,
)
from taxaflow.operators.memberships import EXPORTS, state_json
from taxaflow.queries.registry import query
from taxaflow.session import shared_dir
from taxaflow.sources import storage
from taxaflow.sources.jobs import read_exports, read_job, read_predictions, read_receipts
from taxaflow.streaming.incremental import score_new_files


class DigestScorer:
    """Logits made from the SHA-256 of the text: any engine can recompute them.

    Each of the 64 hex digits d gives the logit (d - 7.5) / 2, so there are many ties.
    """

    def score(self, sample_ids, texts):
        import hashlib as h

        import numpy as np

        digits = [[int(c, 16) for c in h.sha256(t.encode()).hexdigest()] for t in texts]
        return ScoredBatch(sample_ids, (np.array(digits, dtype=np.float32) - 7.5) * 0.5)


MODEL = hashlib.sha256(b"digest scorer").hexdigest()

SCORED_SQL = f"""{decode_sql(DIGEST_LOGITS_SQL)}, scored AS (
    SELECT d.*, e.l, len({WORDS_SQL.format("d.model_input")})::BIGINT AS input_tokens,
        coalesce((SELECT string_agg(code, '|' ORDER BY idx) FROM root_sel r WHERE r.sample_id = d.sample_id), '') AS roots,
        coalesce((SELECT string_agg(code, '|' ORDER BY code) FROM kept k WHERE k.sample_id = d.sample_id), '') AS exact
    FROM inputs d JOIN emb e ON e.sample_id = d.sample_id)"""

PREDICTION_ROWS_SQL = f"""
WITH {SCORED_SQL}
SELECT sample_id, roots, exact, {PRIMARY_SQL} AS auxiliary_primary, {STATE_JSON_SQL} AS document_state, input_tokens,
    input_tokens > 768 AS truncated, source_family, source_locator, raw_windowed,
    sha256(model_input) AS model_input_sha256 FROM scored"""

_jobs: dict[tuple[str, str, str], tuple[str, tuple[int, int] | None]] = {}


def _once(spark, what, made_of, make):
    """Jobs of one session and input are run once and then read by several queries, as long as they lie there as they were left.

    ``made_of`` is the state of the table, or the folder of the job before; the latter is another one if that job was run again.
    """
    key = (spark.sparkContext.applicationId, what, made_of)
    path, left = _jobs.get(key, (None, None))
    if path is None or storage.extent(spark, path) != left:
        path = shared_dir(spark, what)
        make(path)
        _jobs[key] = path, storage.extent(spark, path)
    return path


def _table_state(spark, sf_dir):
    """Names, sizes and times of the files of ``documents``; another table may have come under the same path."""
    return source_state(spark, [f"{sf_dir}/documents.parquet"], "stat")


def _lines(spark, sf_dir):
    return _once(spark, "lines", _table_state(spark, sf_dir), lambda path: raw_records(spark, sf_dir).drop("doc_id").write.json(path))


# Text in one of the files that a stream finds; three files hold less if there is less.
ARRIVING_BYTES = 64 << 20


def _arriving(spark, sf_dir):
    """A folder of files for a stream, and how many it may take at once to see them all in two batches."""
    def make(path):
        records = raw_records(spark, sf_dir).drop("doc_id")
        total = records.agg(F.sum(F.octet_length("text_window"))).first()[0] or 0
        records.repartition(max(3, -(-total // ARRIVING_BYTES)), "sample_id").write.json(path)

    source = _once(spark, "arriving", _table_state(spark, sf_dir), make)
    files = sum(name.startswith("part-") for name in storage.children(spark, source))
    return source, max(2, files * 2 // 3)


def _prepared(spark, sf_dir):
    source = _lines(spark, sf_dir)
    return _once(spark, "job", source, lambda path: prepare(spark, source, path, shard_rows=SHARD_ROWS))


def _scored(spark, job):
    return _once(spark, "scored", job, lambda path: run(spark, job, path, DigestScorer, CONTRACT, model_sha256=MODEL))


def _exported(spark, sf_dir):
    job = _prepared(spark, sf_dir)
    scored = _scored(spark, job)
    return _once(spark, "tables", scored, lambda path: export(spark, job, scored, path))


def _shown(predictions):
    return predictions.select(
        "sample_id", F.array_join("roots", "|").alias("roots"), F.array_join("exact", "|").alias("exact"),
        "auxiliary_primary", state_json(F.col("document_state")).alias("document_state"), "input_tokens", "truncated",
        "source_family", "source_locator", "raw_windowed", "model_input_sha256",
    )


@query("prepare_job", f"""
WITH {DOCUMENTS_SQL}
SELECT count(*) AS rows, ((count(*) + {SHARD_ROWS - 1}) // {SHARD_ROWS})::BIGINT AS shards,
    sum({CONTENT_BYTES_SQL})::BIGINT AS bytes, {digest_sql(CONTENT_SHA_SQL)} AS digest,
    count(*) AS positions FROM docs""")
def prepare_job(spark, sf_dir):
    job = read_job(spark, _prepared(spark, sf_dir))
    content = content_digest(job.documents, [], "row_sha256", "row_bytes")
    shards = job.shards.agg(F.count(F.lit(1)).alias("shards"))
    # Positions are 0..n-1 without a gap exactly if they are distinct and the largest is n-1.
    places = job.documents.agg(F.countDistinct("input_pos").alias("n"), (F.max("input_pos") + 1).alias("m"))
    positions = places.select(F.when(F.col("n") == F.col("m"), F.col("n")).alias("positions"))
    one = F.lit(1)
    return (
        content.withColumn("k", one).join(shards.withColumn("k", one), "k").join(positions.withColumn("k", one), "k").drop("k")
    )


@query("scoring_job", PREDICTION_ROWS_SQL)
def scoring_job(spark, sf_dir):
    return _shown(read_predictions(spark, _scored(spark, _prepared(spark, sf_dir))))


@query("resumed_job", PREDICTION_ROWS_SQL)
def resumed_job(spark, sf_dir):
    """A run that dies after its first commit and is started again with the same command."""
    job = _prepared(spark, sf_dir)

    def make(path):
        def die(_record):
            raise InterruptedError

        options = dict(model_sha256=MODEL, wave_shards=2 + read_job(spark, job).manifest["shards"] // 2)
        try:
            run(spark, job, path, DigestScorer, CONTRACT, on_commit=die, **options)
        except InterruptedError:
            run(spark, job, path, DigestScorer, CONTRACT, **options)

    return _shown(read_predictions(spark, _once(spark, "resumed", job, make)))


@query("export_counts", f"""
WITH {SCORED_SQL}
SELECT 'documents' AS table_name, count(*) AS rows FROM scored
UNION ALL SELECT 'root_membership', count(*) FROM root_sel
UNION ALL SELECT 'exact_membership', count(*) FROM kept
UNION ALL SELECT 'review_queue', count(*) FROM scored WHERE exact = '' OR input_tokens > 768 OR raw_windowed""")
def export_counts(spark, sf_dir):
    _, tables = read_exports(spark, _exported(spark, sf_dir))
    out = None
    for name in EXPORTS:
        one = tables[name].agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        out = one if out is None else out.unionByName(one)
    return out


@query("exported_memberships", f"""
WITH {SCORED_SQL}
SELECT sample_id, 'root' AS kind, code, round(score, 6) AS score FROM root_sel
UNION ALL SELECT sample_id, 'exact', code, round(score, 6) FROM kept""")
def exported_memberships(spark, sf_dir):
    _, tables = read_exports(spark, _exported(spark, sf_dir))
    parts = [tables[f"{kind}_membership"].withColumn("kind", F.lit(kind)) for kind in ("root", "exact")]
    return parts[0].unionByName(parts[1]).select("sample_id", "kind", "code", F.round("score", 6).alias("score"))


ID_SUM_SQL = "coalesce(sum(('0x' || substr(sha256(sample_id), 1, 8))::BIGINT), NULL)::BIGINT"


@query("verify_job", f"""
WITH {SCORED_SQL}, tables AS (
    SELECT 'documents' AS table_name, sample_id FROM scored UNION ALL SELECT 'root_membership', sample_id FROM root_sel
    UNION ALL SELECT 'exact_membership', sample_id FROM kept
    UNION ALL SELECT 'review_queue', sample_id FROM scored WHERE exact = '' OR input_tokens > 768 OR raw_windowed)
SELECT table_name, 'ok' AS status, count(*) AS rows, {ID_SUM_SQL} AS id_sum FROM tables GROUP BY table_name""")
def verify_job(spark, sf_dir):
    """Audit of the exported files against their registry, per table."""
    path = _exported(spark, sf_dir)
    receipt, tables = read_exports(spark, path)
    folder = f"{path}/{receipt['tables']}"
    found = file_inventory(spark, folder, glob="*.parquet").where(~F.col("path").startswith("files/"))
    audit = registry_audit(spark.read.parquet(f"{folder}/files"), found)
    table_name = F.get(F.split("path", "/"), F.lit(0)).alias("table_name")
    status = audit.groupBy(table_name, "status").agg(F.count(F.lit(1)).alias("files"))
    rows = None
    for name in EXPORTS:
        # Rows and one sum of hashes of each table's key column, read back from the audited files.
        mark = F.sum(F.conv(F.substring(F.sha2("sample_id", 256), 1, 8), 16, 10).cast("bigint")).cast("bigint").alias("id_sum")
        one = tables[name].agg(F.count(F.lit(1)).alias("rows"), mark).select(F.lit(name).alias("table_name"), "rows", "id_sum")
        rows = one if rows is None else rows.unionByName(one)
    return rows.join(status, "table_name", "left").select("table_name", "status", "rows", "id_sum")


@query("incremental_resume", PREDICTION_ROWS_SQL)
def incremental_resume(spark, sf_dir):
    """Files arrive in a folder; the stream dies after a commit, resumes, and is then run with nothing to do."""
    source, at_once = _arriving(spark, sf_dir)

    def make(path):
        def die(_record):
            raise InterruptedError

        options = dict(model_sha256=MODEL, max_files_per_trigger=at_once)
        try:
            score_new_files(spark, source, path, DigestScorer, CONTRACT, on_commit=die, **options)
        except Exception as error:  # noqa: BLE001
            if "InterruptedError" not in str(error):
                raise
        score_new_files(spark, source, path, DigestScorer, CONTRACT, **options)
        again = score_new_files(spark, source, path, DigestScorer, CONTRACT, **options)
        if again["state"] != "nothing_to_do":
            raise AssertionError("a stream with nothing to do did something")

    return _shown(read_predictions(spark, _streamed(spark, sf_dir, make)))


def _streamed(spark, sf_dir, make=None):
    source, at_once = _arriving(spark, sf_dir)

    def plain(path):
        score_new_files(spark, source, path, DigestScorer, CONTRACT, model_sha256=MODEL, max_files_per_trigger=at_once)

    return _once(spark, "stream", source, make or plain)


def _table_rows_sql(source: str) -> str:
    """One row for each row of the four tables: table, document, and a text of what else the row holds."""
    return f"""
SELECT 'documents' AS table_name, sample_id, roots || ' / ' || exact || ' / ' || auxiliary_primary || ' / ' || document_state AS content FROM (
    SELECT sample_id, roots, exact, {PRIMARY_SQL} AS auxiliary_primary, {STATE_JSON_SQL} AS document_state FROM {source})
UNION ALL SELECT 'root_membership', sample_id, code || ' ' || round(score * 1000000)::BIGINT FROM root_sel
UNION ALL SELECT 'exact_membership', sample_id, code || ' ' || round(score * 1000000)::BIGINT FROM kept
UNION ALL SELECT 'review_queue', sample_id, array_to_string(list_filter([CASE WHEN exact = '' THEN 'no_exact_label' END,
    CASE WHEN input_tokens > 768 THEN 'token_truncated' END, CASE WHEN raw_windowed THEN 'raw_windowed' END], lambda x: x IS NOT NULL), ',')
    FROM {source} WHERE exact = '' OR input_tokens > 768 OR raw_windowed"""


def _table_rows(tables):
    """The four exported tables in one: see the SQL above."""
    labels = F.concat_ws(" / ", F.array_join("roots", "|"), F.array_join("exact", "|"), "auxiliary_primary", "document_state_json")
    score = F.round(F.col("score") * 1_000_000).cast("bigint").cast("string")
    parts = [tables["documents"].select(F.lit("documents").alias("table_name"), "sample_id", labels.alias("content"))]
    for kind in ("root", "exact"):
        name = f"{kind}_membership"
        parts.append(tables[name].select(F.lit(name).alias("table_name"), "sample_id", F.concat_ws(" ", "code", score).alias("content")))
    parts.append(tables["review_queue"].select(F.lit("review_queue").alias("table_name"), "sample_id", F.array_join("reasons", ",").alias("content")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("incremental_export", f"WITH {SCORED_SQL} {_table_rows_sql('scored')}")
def incremental_export(spark, sf_dir):
    """All four tables of the batches that a stream has committed."""
    source = _streamed(spark, sf_dir)
    path = _once(spark, "stream-tables", source, lambda path: export_increments(spark, source, path, check_references=True))
    return _table_rows(read_exports(spark, path)[1])


@query("incremental_positions", f"""
SELECT count(*) AS documents, count(*) AS positions, 0::BIGINT AS first_pos, count(*) - 1 AS last_pos FROM documents""")
def incremental_positions(spark, sf_dir):
    """Positions over all batches: each once, without a hole, and rising from batch to batch."""
    source = _streamed(spark, sf_dir)
    rows = read_predictions(spark, source)
    found = rows.agg(
        F.count(F.lit(1)).alias("documents"), F.countDistinct("input_pos").alias("positions"),
        F.min("input_pos").alias("first_pos"), F.max("input_pos").alias("last_pos"),
    )
    log = read_receipts(spark, source).select("shard_index", "first_pos", (F.col("first_pos") + F.col("rows") - 1).alias("last"))
    strays = rows.join(log, "shard_index").where(~F.col("input_pos").between(F.col("first_pos"), F.col("last")))
    one = F.lit(1)
    none = strays.agg(F.count(one).alias("strays")).where("strays = 0").select(one.alias("k"))
    return found.withColumn("k", one).join(none, "k").drop("k")


@query("commit_log", f"""
WITH totals AS (SELECT count(*) AS rows, ((count(*) + {SHARD_ROWS - 1}) // {SHARD_ROWS})::BIGINT AS shards FROM documents)
SELECT log, shards, rows, true AS calls_agree, true AS timed FROM totals JOIN (VALUES ('receipts'), ('progress'), ('session')) AS l(log) ON true""")
def commit_log(spark, sf_dir):
    """What the three logs of one run say: its receipts, its progress records and its session record."""
    job, seen = _prepared(spark, sf_dir), []
    path = shared_dir(spark, "logged")
    outcome = run(spark, job, path, DigestScorer, CONTRACT, model_sha256=MODEL, wave_shards=5, on_commit=seen.append)
    receipts = read_receipts(spark, path).agg(
        F.count(F.lit(1)).alias("shards"), F.sum("rows").alias("rows"), F.sum("model_calls").alias("calls"), F.min("seconds").alias("seconds"))
    sums = "count(*) AS n, sum(shards) AS shards, sum(rows) AS rows, sum(model_calls) AS calls, min(seconds) AS seconds"
    schema = "commit string, shards bigint, rows bigint, model_calls bigint, seconds double"
    progress = spark.createDataFrame(seen, schema).selectExpr(*sums.split(", "))
    session = spark.read.json(f"{path}/sessions").select(
        F.lit(receipts.first()["shards"]).alias("shards"), (F.col("scored") + F.col("kept")).alias("rows"), F.col("model_calls").alias("calls"), "seconds")
    parts = [p.select(F.lit(name).alias("log"), "shards", "rows", (F.col("calls") == outcome["model_calls"]).alias("calls_agree"), (F.col("seconds") > 0).alias("timed"))
             for name, p in (("receipts", receipts), ("progress", progress), ("session", session))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
