"""Incremental scoring: resume, refusal, replay."""

import gzip
import json
import sys

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark import cloudpickle

from taxaflow.sources.jobs import commits, read_predictions, read_receipts
from taxaflow.streaming.incremental import score_new_files

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class FakeModel:
    def predict(self, rows):
        return [
            dict(sample_id=r["sample_id"], roots=[], exact=[], root_probabilities={}, exact_probabilities={},
                 truncated=False, empty_exact=True, raw_windowed=r["raw_windowed"], source_family=r["source_family"])
            for r in rows
        ]


class Unloadable:
    def __init__(self):
        raise AssertionError("a stream with nothing to do loaded the model")


class Dying(FakeModel):
    def predict(self, rows):
        if any(r["sample_id"] == "b1" for r in rows):
            raise RuntimeError("death before a commit")
        return super().predict(rows)


def put(folder, name, ids):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(dict(sample_id=i, text_window=f"text {i}")) + "\n" for i in ids))


def score(spark, folder, out, factory=FakeModel, **kwargs):
    options = dict(model_sha256="test", max_files_per_trigger=1)
    return score_new_files(spark, str(folder), out, factory, None, **{**options, **kwargs})


def ids(spark, out):
    return sorted(r["sample_id"] for r in read_predictions(spark, out).collect())


def test_new_files_are_scored_once(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    put(folder, "1.jsonl", ["a1", "a2"])
    put(folder, "2.jsonl", ["b1"])
    first = score(spark, folder, out)
    assert (first["batches"], first["scored"]) == (2, 3)
    assert score(spark, folder, out, factory=Unloadable)["state"] == "nothing_to_do"
    put(folder, "3.jsonl", ["c1"])
    assert score(spark, folder, out)["scored"] == 1
    assert ids(spark, out) == ["a1", "a2", "b1", "c1"]
    assert [r["rows"] for r in read_receipts(spark, out).orderBy("shard_index").collect()] == [2, 1, 1]


def test_tables_and_compressed_lines(spark, tmp_path):
    folder, out = tmp_path / "tables", str(tmp_path / "out")
    folder.mkdir()
    for name, rows in (("1", ["a", "b"]), ("2", ["c"])):
        pq.write_table(pa.Table.from_pylist([dict(key=i, body=f"text {i}") for i in rows]), folder / f"{name}.parquet")
    schema = spark.read.parquet(str(folder)).schema
    options = dict(table_schema=schema, id_field="key", text_field="body")
    assert score(spark, folder, out, **options)["scored"] == 3
    assert ids(spark, out) == ["a", "b", "c"]
    packed, out = tmp_path / "packed", str(tmp_path / "out2")
    packed.mkdir()
    (packed / "1.jsonl.gz").write_bytes(gzip.compress(b'{"sample_id":"z","text_window":"t"}\n\n'))
    assert score(spark, packed, out)["scored"] == 1


def test_death_before_and_after_a_commit(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    put(folder, "1.jsonl", ["a1", "a2"])
    put(folder, "2.jsonl", ["b1"])
    with pytest.raises(Exception, match="death before"):
        score(spark, folder, out, factory=Dying)
    assert ids(spark, out) == ["a1", "a2"] and len(commits(spark, out)) == 1

    def die(record):
        raise RuntimeError("death after")

    with pytest.raises(Exception, match="death after"):
        score(spark, folder, out, on_commit=die)
    assert ids(spark, out) == ["a1", "a2", "b1"]
    # The stream does not know that the batch was published; its receipt does.
    assert score(spark, folder, out, factory=Unloadable)["state"] == "nothing_to_do"
    assert ids(spark, out) == ["a1", "a2", "b1"]


def test_an_id_that_came_before_stops_the_stream(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    put(folder, "1.jsonl", ["a1"])
    score(spark, folder, out)
    put(folder, "2.jsonl", ["x1", "a1"])
    with pytest.raises(Exception, match="arrived twice"):
        score(spark, folder, out)
    assert ids(spark, out) == ["a1"]


def test_bad_records_and_doubled_ids_stop_the_stream(spark, tmp_path):
    for name, ids_in in (("double", ["a1", "a1"]), ("empty", [""])):
        folder = tmp_path / name
        put(folder, "1.jsonl", ids_in)
        with pytest.raises(Exception, match="arrived twice|bad_sample_id"):
            score(spark, folder, str(tmp_path / f"out-{name}"))
        assert commits(spark, str(tmp_path / f"out-{name}")) == []


def test_another_configuration_is_refused(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    put(folder, "1.jsonl", ["a1"])
    score(spark, folder, out)
    for change in (dict(model_sha256="other"), dict(batch_size=7), dict(code_sha256="other")):
        with pytest.raises(ValueError, match="other settings"):
            score(spark, folder, out, **change)
