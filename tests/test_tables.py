"""Parquet inputs whose files differ, and locators with awkward JSON."""

import datetime
import json
import uuid

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import taxaflow.sources.tables as tables
from taxaflow.errors import InvalidInput
from taxaflow.functions.metadata import exact_fields
from taxaflow.operators.normalize import normalize_fields
from taxaflow.operators.scoring import prediction_columns
from taxaflow.plans.export import write_prediction_lines
from taxaflow.plans.prepare import prepare
from taxaflow.sources.jobs import read_job, read_prediction_lines
from taxaflow.sources.records import fields_from_lines, read_records, with_scan_errors


def put(folder, name, columns):
    folder.mkdir(exist_ok=True)
    pq.write_table(columns if isinstance(columns, pa.Table) else pa.table(columns), folder / name)


def normalized(spark, path, **fields):
    rows = exact_fields(normalize_fields(read_records(spark, str(path), **fields)))
    names = ("sample_id", "text_window", "metadata_compact", "source_family", "source_locator", "raw_windowed", "violations")
    return {r["sample_id"]: tuple(r[n] for n in names[1:]) for r in rows.collect()}


@pytest.fixture
def drifting(tmp_path):
    folder = tmp_path / "drift.parquet"
    put(folder, "1.parquet", {"sample_id": ["a", "b"], "text_window": ["text a", "text b"]})
    put(folder, "2.parquet", {"sample_id": ["c"], "text_window": ["text c"], "seq": ["x"], "file_path": [1.5], "block_start": [True], "__in0": [1],
                              "raw_windowed": [True], "source_family": ["web"]})
    put(folder, "3.parquet", {"sample_id": ["d"], "text_window": ["text d"], "raw_windowed": pa.array([None], pa.null()), "source_locator": [{"q": 1.5, "r": "q"}]})
    put(folder, "4.parquet", {"sample_id": ["e"], "text_window": ["text e"], "source_locator": [7], "metadata_compact": ['{"title": "T"}']})
    # A time of day is a type Spark does not read; nobody uses the column.
    put(folder, "5.parquet", pa.table({"sample_id": ["f"], "text_window": ["text f"], "at": pa.array([datetime.time(1, 2)], pa.time32("ms")),
                                       "metadata_compact": [{"title": "U", "date": 2.5}]}))
    put(folder, "6.parquet", {"sample_id": [8], "text_window": ["its ID is a number"]})
    put(folder, "7 a%20b ü.parquet", {"text_window": pa.array(["large"], pa.large_string()), "sample_id": pa.array(["g"]).dictionary_encode(), "source_family": [3]})
    return folder


WANTED = {
    "a": ("text a", "", "unspecified", None, None, []),
    "b": ("text b", "", "unspecified", None, None, []),
    "c": ("text c", "", "web", None, True, []),
    "d": ("text d", "", "unspecified", '{"q": 1.5, "r": "q"}', None, []),
    "e": ("text e", '{"title": "T"}', "unspecified", "7", None, []),
    "f": ("text f", '{"date": 2.5, "title": "U"}', "unspecified", None, None, []),
    None: ("its ID is a number", "", "unspecified", None, None, ["bad_sample_id"]),
    "g": ("large", "", "unspecified", None, None, ["bad_source_family"]),
}


def test_files_of_any_shape_keep_their_values(spark, drifting):
    assert normalized(spark, drifting) == WANTED


def test_stores_that_tasks_cannot_open(spark, drifting, monkeypatch):
    """Footers are then read by Spark, on the driver; a file with a type Spark can't map can't be helped."""
    monkeypatch.setattr(tables, "can_open", lambda path: "/5.parquet" in path)
    assert normalized(spark, drifting) == WANTED


def test_prepare_numbers_drifting_files_in_order(spark, drifting, tmp_path):
    result = prepare(spark, str(drifting), str(tmp_path / "job"), shard_rows=2, on_error="quarantine")
    assert (result["documents"], result["rejected"]) == (6, 2)
    documents = read_job(spark, str(tmp_path / "job")).documents.orderBy("input_pos").collect()
    assert [r["sample_id"] for r in documents] == list("abcdef")
    assert [r["input_pos"] for r in documents] == list(range(6))


def test_columns_named_like_the_readers_own_can_be_used(spark, tmp_path):
    put(tmp_path / "own.parquet", "1.parquet", {"seq": ["one", "two"], "file_path": ["text 1", "text 2"], "block_start": [1, 2]})
    put(tmp_path / "own.parquet", "2.parquet", {"seq": ["three"], "file_path": ["text 3"], "_metadata": ["x"]})
    got = normalized(spark, tmp_path / "own.parquet", id_field="seq", text_field="file_path")
    assert {k: v[0] for k, v in got.items()} == {"one": "text 1", "two": "text 2", "three": "text 3"}
    with pytest.raises(InvalidInput):
        read_records(spark, str(tmp_path / "own.parquet"), id_field=tables.PLACE)


def test_one_column_may_serve_twice(spark, tmp_path):
    put(tmp_path / "t.parquet", "1.parquet", {"k": ["v"], "source_family": ["fam"]})
    assert normalized(spark, tmp_path / "t.parquet", id_field="k", text_field="k")["v"][0] == "v"
    assert normalized(spark, tmp_path / "t.parquet", id_field="source_family", text_field="k")["fam"][2] == "fam"


def test_a_single_shape_is_one_scan_of_the_used_columns(spark, tmp_path):
    for i in range(3):
        put(tmp_path / "same.parquet", f"{i}.parquet", {"sample_id": [f"s{i}"], "text_window": ["t"], "unused": [i]})
    plan = read_records(spark, str(tmp_path / "same.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "unused" not in plan and "Exchange" not in plan


def test_files_with_more_columns_join_the_scan_of_those_with_fewer():
    def kind(**types):
        return json.dumps({"type": "struct", "fields": [{"name": n, "type": t, "nullable": True, "metadata": {}} for n, t in types.items()]})

    scans = tables.reconciled({kind(a="string"): [0, 4], kind(a="string", b="long"): [1], kind(b="string"): [2], kind(a="void", b="long"): [3]})
    assert [(s.simpleString(), files) for s, files in scans] == [
        ("struct<a:string,b:bigint>", [0, 1, 4]), ("struct<b:bigint>", [3]), ("struct<b:string>", [2])]


def test_empty_folders_and_tables(spark, tmp_path):
    put(tmp_path / "none.parquet", "1.parquet", {"sample_id": pa.array([], pa.string()), "text_window": pa.array([], pa.string())})
    assert normalized(spark, tmp_path / "none.parquet") == {}
    with pytest.raises(InvalidInput):
        prepare(spark, str(tmp_path / "none.parquet"), str(tmp_path / "job"))


# ---------------------------------------------------------------- locators

NAMES = st.sampled_from(["a", "b", "é", "x:y", 'q"', "source_locator", "-0", " "])


class Pairs(list):
    """An object as written: keys may repeat."""


VALUES = st.recursive(
    st.one_of(
        st.none(), st.booleans(), st.integers(-10**40, 10**40), st.floats(allow_nan=False, allow_infinity=False),
        st.sampled_from(["", "x: y", "\\", "-0", "\u001f\t", "日本", '"'])),
    lambda inner: st.one_of(st.lists(inner, max_size=3), st.lists(st.tuples(NAMES, inner), max_size=4).map(Pairs)), max_leaves=8,
)


def written(value, gap):
    if isinstance(value, Pairs):
        return "{" + f",{gap}".join(f"{json.dumps(k)}{gap}:{written(v, gap)}" for k, v in value) + "}"
    if isinstance(value, list):
        return "[" + f"{gap},".join(written(v, gap) for v in value) + "]"
    return json.dumps(value, ensure_ascii=False)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(VALUES, VALUES, st.sampled_from(["", " "]), st.booleans()), min_size=20, max_size=20))
def test_locators_are_what_python_prints(spark, tmp_path, cases):
    lines = []
    for i, (first, second, gap, twice) in enumerate(cases):
        before = f'"source_locator":{gap}{written(first, gap)},' if twice else ""
        lines.append(f'{{{before}"sample_id":"s{i}","text_window":"t","source_locator":{gap}{written(second, gap)}}}')
    frame = spark.createDataFrame([(x, "f", 0, i) for i, x in enumerate(lines)], "value string, file_path string, block_start bigint, seq bigint")
    rows = exact_fields(normalize_fields(fields_from_lines(with_scan_errors(frame, 10**6), "sample_id", "text_window")))
    want = {}
    for i, line in enumerate(lines):
        value = json.loads(line)["source_locator"]
        want[f"s{i}"] = None if value is None else json.dumps(value, ensure_ascii=False)
    found = rows.where(F.size("violations") == 0).select("sample_id", "source_locator")
    assert {r["sample_id"]: r["source_locator"] for r in found.collect()} == want
    target = str(tmp_path / uuid.uuid4().hex)
    write_prediction_lines(prediction_columns(found.withColumn("exact", F.array().cast("array<string>"))), target)
    again = read_prediction_lines(spark, target)
    assert {r["sample_id"]: r["source_locator"] for r in again.collect()} == want
