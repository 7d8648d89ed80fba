"""The store of IDs a stream has committed."""

import re

from taxaflow.streaming import seen_ids
from taxaflow.streaming.seen_ids import BUCKETS, Run, add_run, bucketed, merge_runs, runs, seen_before


def frame(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "sample_id string")


def found(spark, folder, number, ids, small=True):
    return sorted(r[0] for r in seen_before(frame(spark, ids), folder, number, small_batch=small).collect())


def test_ids_of_earlier_batches_only(spark, tmp_path):
    folder = str(tmp_path / "ids")
    assert found(spark, folder, 0, ["a", "b", "b"]) == ["b"]
    add_run(frame(spark, ["a", "b"]), folder, 0)
    add_run(frame(spark, ["c"]), folder, 3)  # batches without documents leave no run
    for small in (True, False):
        assert found(spark, folder, 4, ["x", "b", "c", "x"], small) == ["b", "c", "x"]
    assert found(spark, folder, 3, ["a", "c"]) == ["a"]  # a batch done again does not meet itself
    add_run(frame(spark, ["d"]), folder, 3)
    assert found(spark, folder, 4, ["c", "d"]) == ["d"]


def test_runs_are_merged_level_by_level(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(seen_ids, "MERGED", 2)
    folder = str(tmp_path / "ids")
    for number in range(7):
        merge_runs(spark, folder, number)
        add_run(frame(spark, [f"id{number}", f"more{number}"]), folder, number)
    assert runs(spark, folder, 7) == [Run(0, 3, 2), Run(4, 5, 1), Run(6, 6, 0)]
    assert found(spark, folder, 7, [f"id{n}" for n in range(9)]) == [f"id{n}" for n in range(7)]
    # A merge that died before it was done, or before it tidied up, changes nothing.
    add_run(frame(spark, ["id4", "more4"]), folder, 4)
    assert runs(spark, folder, 7) == [Run(0, 3, 2), Run(4, 5, 1), Run(6, 6, 0)]
    assert found(spark, folder, 7, ["more4"]) == ["more4"]


def test_a_batch_reads_the_buckets_it_falls_into(spark, tmp_path):
    folder = str(tmp_path / "ids")
    add_run(frame(spark, [f"k{i}" for i in range(2000)]), folder, 0)
    batch = frame(spark, ["k1", "k2"])
    touched = {r["bucket"] for r in bucketed(batch).collect()}
    met = seen_before(batch, folder, 1, small_batch=True)
    text = met._jdf.queryExecution().executedPlan().toString()
    pruned = re.search(r"PartitionFilters: \[([^\]]*)\]", text).group(1)
    assert 0 < len(touched) <= 2 < BUCKETS and all(re.search(rf"\b{b}\b", pruned) for b in touched)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert sorted(r[0] for r in met.collect()) == ["k1", "k2"]


def test_the_work_for_a_batch_does_not_grow_with_their_number(spark, tmp_path, monkeypatch):
    """Folders read for the 50th batch are about as many as for the fifth."""
    monkeypatch.setattr(seen_ids, "_write", lambda ids, path: (ids.limit(1).write.mode("overwrite").partitionBy("bucket").parquet(path)))
    folder, read = str(tmp_path / "ids"), {}
    for number in range(50):
        merge_runs(spark, folder, number)
        read[number] = len(runs(spark, folder, number))
        add_run(frame(spark, [f"id{number}"]), folder, number)
    assert read[5] == 5 and max(read.values()) <= 2 * (seen_ids.MERGED - 1)
