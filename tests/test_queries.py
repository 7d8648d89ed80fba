"""Every registered query beside its SQL twin on the smallest tables."""

import os
import sys

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from compare import connect, differences  # noqa: E402
from taxaflow.queries import job_queries, source_queries  # noqa: E402
from taxaflow.sources import storage  # noqa: E402
from taxaflow.sources.jobs import commits  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")

# These give hashes of stored files, which no SQL twin can see.
UNCHECKED = {"file_inventory"}


@pytest.fixture(scope="module")
def tables():
    return connect(SF_DIR)


def test_every_query_has_a_check():
    assert set(entry.QUERIES) - set(entry.CHECKS) == UNCHECKED
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.QUERIES))
def test_query(spark, tables, name):
    frame = entry.queries()[name](spark, SF_DIR)
    if name in UNCHECKED:
        assert frame.collect()
    else:
        assert differences(frame, tables, entry.oracle_sql()[name]) is None


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["sample_id", "code", "score"] and frame.count() > 0


@pytest.fixture(scope="module")
def scattered(tmp_path_factory):
    """A table ``documents`` in files of rising size, which Spark reads largest first: no file stands where its IDs would."""
    folder = tmp_path_factory.mktemp("scattered")
    (folder / "documents.parquet").mkdir()
    first = 0
    for number, rows in enumerate((30, 200, 700)):
        ids = range(first, first + rows)
        first += rows
        pq.write_table(pa.table({
            "doc_id": pa.array(ids, pa.int64()), "text": [f"document {i} " + "word " * (i % 50) for i in ids],
            "lang": ["en" if i % 3 else "de" for i in ids], "source": [f"s{i % 4}" for i in ids], "n_chars": pa.array(ids, pa.int64()),
        }), folder / "documents.parquet" / f"part-{number}.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    return str(folder), con


def test_quarantined_shards_go_by_doc_id(spark, scattered):
    folder, con = scattered
    assert differences(entry.queries()["quarantined_shards"](spark, folder), con, entry.oracle_sql()["quarantined_shards"]) is None


def largest_share(spark, folder, pattern):
    """Rows of the largest of some written files, and all rows."""
    rows = [r["count"] for r in spark.read.text(folder, pathGlobFilter=pattern, recursiveFileLookup=True).groupBy("_metadata.file_path").count().collect()]
    return max(rows), sum(rows)


def test_arriving_files_grow_in_number(spark, scattered, monkeypatch):
    monkeypatch.setattr(job_queries, "ARRIVING_BYTES", 8_000)
    folder, con = scattered
    source, at_once = job_queries._arriving(spark, folder)
    largest, rows = largest_share(spark, source, "*.json")
    assert rows == 930 and largest < rows / 6 and at_once > 8
    for name in ("incremental_positions", "incremental_export", "incremental_resume"):
        assert differences(entry.queries()[name](spark, folder), con, entry.oracle_sql()[name]) is None
    assert len(commits(spark, job_queries._streamed(spark, folder))) == 2


def test_drifting_tables_are_written_by_several_tasks(spark, scattered, tmp_path):
    folder, con = scattered
    conf = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "0"}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        source_queries._drifting_tables(spark, folder, str(tmp_path / "drift"))
        assert len(list((tmp_path / "drift").glob("*.parquet"))) > 5
        assert differences(entry.queries()["table_drift"](spark, folder), con, entry.oracle_sql()["table_drift"]) is None
    finally:
        for key in conf:
            spark.conf.unset(key)


def test_locators_are_parsed_once(spark, scattered):
    """The lines are read by one scan, which writes what is found; nothing after it goes back to them."""
    folder, con = scattered
    frame = entry.queries()["locators"](spark, folder)
    assert not any("taxaflow-locators-" in f for f in frame.inputFiles())
    assert differences(frame, con, entry.oracle_sql()["locators"]) is None


def write_documents(folder, ids):
    pq.write_table(pa.table({
        "doc_id": pa.array(ids, pa.int64()), "text": [f"document {i} " + "word " * (i % 50) for i in ids],
        "lang": ["en" if i % 3 else "de" for i in ids], "source": [f"s{i % 4}" for i in ids], "n_chars": pa.array(ids, pa.int64()),
    }), folder / "documents.parquet")


def test_jobs_are_run_again_if_their_folder_or_their_table_has_changed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(job_queries, "_jobs", {})
    con = duckdb.connect()

    def ran(*names):
        """Folders of the jobs that queries have used, by what they hold; the queries' rows are those of their SQL."""
        for name in names:
            assert differences(entry.queries()[name](spark, str(tmp_path)), con, entry.oracle_sql()[name]) is None
        return {what: path for (_, what, _), (path, _) in job_queries._jobs.items()}

    write_documents(tmp_path, range(150))
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet'")
    first = ran("scoring_job", "incremental_positions")
    assert ran("scoring_job", "incremental_positions") == first  # nothing has changed, nothing is run again
    for what in ("job", "arriving"):
        path = first[what]
        storage.remove(spark, f"{path}/{storage.children(spark, path)[-1]}")
    second = ran("scoring_job", "incremental_positions")
    # What was made of a job that was run again is made again as well.
    assert {what for what in first if first[what] != second[what]} == {"job", "scored", "arriving", "stream"}
    write_documents(tmp_path, range(1000, 1070))  # another table under the same path
    third = ran("prepare_job")
    assert third["lines"] != second["lines"] and third["job"] != second["job"]
