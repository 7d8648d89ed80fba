"""The plans a large cluster would get: what is read, moved and sent to Python."""

import json
import re

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from taxaflow.operators.decode import decode_logits, decode_long, exact_rank, register_decode_function
from taxaflow.operators.duplicates import duplicate_keys, repeated_ids, suspects
from taxaflow.operators.integrity import content_digest, key_mismatch
from taxaflow.operators.memberships import EXPORTS
from taxaflow.operators.normalize import normalize
from taxaflow.operators.sharding import with_dense_position, with_stored_place
from taxaflow.operators.taxonomy import HeadContract, table_difference, taxonomy_table
from taxaflow.plans.prepare import numbered, shard_table, with_content_hash
from taxaflow.plans.run import label
from taxaflow.schemas import PREDICTION
from taxaflow.sources.jobs import JOB_DOCUMENTS, read_prediction_lines

HEAD = HeadContract(["S", "T"], ["S", "S.A", "T.B"], [0, 0, 1])


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stored(spark, tmp_path):
    """Empty tables on disk with the schemas of a job."""
    def write(name, schema):
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    return write


def test_decoding_and_memberships_move_nothing(spark, stored):
    logits = stored("logits", "sample_id string, logits array<float>")
    for export in ("exact_membership", "root_membership"):
        text = plan(EXPORTS[export](decode_logits(logits, HEAD)))
        assert "Exchange" not in text and "Python" not in text and "Join" not in text
        # The decoder is not repeated in a filter below the unfolding.
        assert not re.search(r"[)\-] Filter ", text.split("Generate")[1])


def test_scoring_is_narrow_with_one_python_stage(spark, stored):
    documents = stored("documents", JOB_DOCUMENTS)
    text = plan(label(documents.drop("row_bytes", "row_sha256"), object, HEAD, batch_size=8))
    assert "Exchange" not in text and text.count("MapInArrow") == 1 and "BatchEvalPython" not in text
    assert "ArrowEvalPython" not in text


def test_a_wave_prunes_by_shard(spark, stored):
    documents = stored("documents", JOB_DOCUMENTS)
    text = plan(documents.where(F.col("shard_index").between(10, 19)))
    assert "GreaterThanOrEqual(shard_index,10)" in text and "LessThanOrEqual(shard_index,19)" in text


def test_each_export_reads_its_own_columns(spark, stored):
    predictions = stored("predictions", PREDICTION)
    columns = {
        "exact_membership": ["exact", "exact_probabilities", "sample_id"],
        "root_membership": ["root_probabilities", "roots", "sample_id"],
        "review_queue": ["empty_exact", "raw_windowed", "sample_id", "truncated"],
    }
    for name, wanted in columns.items():
        text = plan(EXPORTS[name](predictions))
        schema = text.split("ReadSchema: struct<")[1].split("\n")[0]
        read = set(re.findall(r"(\w+):", schema)) & set(PREDICTION.fieldNames())
        assert sorted(read) == wanted and "Exchange" not in text


def test_shard_digests_do_not_read_the_texts(spark, stored):
    text = plan(shard_table(stored("documents", JOB_DOCUMENTS)))
    schema = text.split("ReadSchema: ")[1].split("\n")[0]
    assert "text_window" not in schema and text.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in text


def test_numbering_broadcasts_the_splits_only(spark, stored, tmp_path):
    rows = stored("rows", "sample_id string, text_window string, metadata_compact string, source_family string, source_locator string, raw_windowed boolean, file_path string, block_start bigint, seq bigint")
    text = plan(numbered(rows, rows, str(tmp_path / "work"), 10))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text


def test_plain_columns_need_no_json_parsing_and_no_python(spark, tmp_path):
    pq.write_table(pa.Table.from_pylist([dict(sample_id="a", text_window="t", metadata_compact=dict(title="x"), junk="j")]), tmp_path / "in.parquet")
    text = plan(normalize(spark.read.parquet(str(tmp_path / "in.parquet"))))
    assert "from_json" not in text and "Python" not in text and "junk" not in text


def test_committed_ids_stay_in_place(spark, stored):
    committed = stored("committed", PREDICTION)
    batch = stored("batch", "sample_id string")
    text = plan(repeated_ids(batch, committed, small_batch=True))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    schema = text.split("ReadSchema: ")[-1].split("\n")[0]
    assert schema.strip() == "struct<sample_id:string>"


def test_the_taxonomy_is_broadcast_by_its_known_size(spark, stored):
    logits = stored("logits", "sample_id string, logits array<float>")
    text = plan(exact_rank(logits, HEAD, taxonomy_table(spark, HEAD)))
    assert "BroadcastHashJoin" in text and text.count("Exchange hashpartitioning") == 1
    # Both steps of the long form share that one exchange.
    assert plan(decode_long(exact_rank(logits, HEAD, taxonomy_table(spark, HEAD)))).count("Exchange hashpartitioning") == 1


def test_counting_combines_before_the_shuffle(spark, stored):
    keys = stored("keys", "k string, sha string, n bigint")
    for text in (plan(duplicate_keys(keys, ["k"])), plan(content_digest(keys, ["k"], "sha", "n"))):
        assert text.index("Exchange") < text.rindex("partial_")  # printed from the top: partial is below


def test_only_awkward_prediction_lines_reach_python(spark, tmp_path):
    (tmp_path / "p.jsonl").write_text(json.dumps(dict(sample_id="a", roots=[], exact=[])) + "\n")
    read = read_prediction_lines(spark, str(tmp_path / "p.jsonl"))
    text = plan(read)
    # One column goes there: the line where the locator needs it, else NULL.
    assert text.count("ArrowEvalPython") == 1 and "walked_locator(CASE WHEN" in text.replace("pythonUDF", "")
    assert "Python" not in plan(read.select("sample_id", "roots"))


def test_hash_of_content_is_row_local(spark, stored):
    assert "Exchange" not in plan(with_content_hash(stored("documents", JOB_DOCUMENTS).drop("row_bytes", "row_sha256")))


def test_the_sql_decoder_moves_nothing(spark, stored):
    register_decode_function(spark, HEAD, "decode_plan")
    stored("logits", "sample_id string, logits array<float>").createOrReplaceTempView("plan_logits")
    text = plan(spark.sql("SELECT sample_id, m.* FROM (SELECT sample_id, decode_plan(logits) AS found FROM plan_logits) LATERAL VIEW OUTER inline(found) m AS kind, code, score WHERE kind IS NOT NULL"))
    assert "Exchange" not in text and "Join" not in text and "Python" not in text and text.count("FileScan") == 1


def test_two_sided_comparisons_read_and_shuffle_once(spark, stored):
    left, right = stored("left", "k string, v string"), stored("right", "k string, v string")
    for text in (plan(key_mismatch(left, right, "k")), plan(table_difference(left, right))):
        assert text.count("Exchange hashpartitioning") == 1 and text.count("FileScan") == 2
        assert "Join" not in text and "partial_sum" in text


def test_only_keys_that_share_a_hash_are_moved(spark, tmp_path):
    spark.range(1000).selectExpr("if(id = 7, 'k6', concat('k', id)) AS k", "repeat('x', 100) AS text").write.parquet(str(tmp_path / "keys"))
    text = plan(suspects(spark.read.parquet(str(tmp_path / "keys")), ["k"]))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and "text" not in text.split("ReadSchema")[-1]
    # The one exchange deals hashes, not keys.
    assert text.count("Exchange hashpartitioning") == 1 and "hashpartitioning(h" in text


def test_dense_positions_join_by_task_number(spark, tmp_path):
    spark.range(10).selectExpr("'f' AS file_path", "0L AS block_start", "id AS seq", "'t' AS text_window").write.parquet(str(tmp_path / "scan"))
    scanned = spark.read.parquet(str(tmp_path / "scan"))
    with_stored_place(scanned, F.col("seq") % 3 > 0).write.parquet(str(tmp_path / "clean"))
    placed = with_dense_position(spark.read.parquet(str(tmp_path / "clean")), ["file_path", "block_start"], 4)
    assert sorted(tuple(r) for r in placed.select("seq", "input_pos").collect()) == [(1, 0), (2, 1), (4, 2), (5, 3), (7, 4), (8, 5)]
    joins = [line for line in plan(placed).split("\n") if "Join [task" in line]
    assert joins and "[task" in joins[0]


def test_exports_of_jobs_and_streams_are_narrow(spark, stored):
    predictions = stored("all", PREDICTION)
    for project in EXPORTS.values():
        assert "Exchange" not in plan(project(predictions))
