"""Operators against plain Python statements of the same rules."""

import hashlib
import json
import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from taxaflow.errors import BindingMismatch, DuplicateDocuments, InvalidInput
from taxaflow.operators.decode import (
    decode_logits, decode_long, exact_rank, predict_sets, register_decode_function,
)
from taxaflow.functions.text import words
from taxaflow.operators import duplicates, integrity
from taxaflow.operators.duplicates import has_duplicates, repeated_ids, require_unique, suspects
from taxaflow.operators.integrity import (
    file_inventory, file_set_digest, hashed_files, is_safe_path, key_mismatch, manifest_faults, missing_required, receipt_audit,
    registry_audit, require_same_binding,
)
from taxaflow.operators.memberships import all_memberships, export_documents, label_metrics, membership, review_queue
from taxaflow.operators.normalize import normalize
from taxaflow.operators.pooling import last_pool, mean_pool
from taxaflow.operators.taxonomy import (
    HeadContract, STATE_LABELS, label_memberships, read_catalog, read_contract, table_difference, taxonomy_table,
)
from taxaflow.plans.export import write_prediction_lines
from taxaflow.sources.jobs import read_manifest_file, read_prediction_lines, read_registry


def wide_contract(n_roots=33, n_exact=1029, seed=1):
    """A head of full size with roots that are codes themselves and deep chains."""
    rng = random.Random(seed)
    roots = [f"R{i:02d}" for i in range(n_roots)]
    exact, owner = list(roots), list(range(n_roots))
    while len(exact) < n_exact:
        at = rng.randrange(len(exact))
        code = f"{exact[at]}.{rng.choice('ABCDEFGH')}{rng.choice('XYZ')}"
        if code not in exact:
            exact.append(code)
            owner.append(owner[at])
    return HeadContract(roots, exact, owner)


def brute_force(logits, contract, root_min=0.5, exact_min=0.95, roots=None):
    """The selection rule said once more, on plain lists."""
    score = [float(np.float32(1 / (1 + np.exp(-float(x))))) for x in logits]
    n = len(contract.roots)
    root_score, exact_score = score[:n], score[n:n + len(contract.exact)]
    if roots is None:
        roots = [c for c, s in zip(contract.roots, root_score) if s >= root_min]
    chosen = []
    for root in roots:
        ranked = sorted(
            (-s, c) for s, c, o in zip(exact_score, contract.exact, contract.exact_root_indices)
            if contract.roots[o] == root and s >= exact_min
        )
        kept = []
        for _, code in ranked:
            parts = code.split(".")
            if all(k.split(".")[:len(parts)] != parts and parts[:len(k.split("."))] != k.split(".") or k == code for k in kept):
                kept.append(code)
        chosen += kept
    at = n + len(contract.exact)
    primary = contract.exact[int(np.argmax(logits[at:at + len(contract.exact)]))]
    at += len(contract.exact)
    state = {}
    for name, labels in STATE_LABELS.items():
        state[name] = labels[int(np.argmax(logits[at:at + len(labels)]))]
        at += len(labels)
    return dict(roots=roots, exact=sorted(chosen), primary=primary, state=state, root_score=root_score, exact_score=exact_score)


def logit_frame(spark, rows):
    return spark.createDataFrame([(f"d{i}", [float(x) for x in r]) for i, r in enumerate(rows)], "sample_id string, logits array<float>")


def test_full_size_head_equals_brute_force(spark):
    contract = wide_contract()
    assert contract.width == 2100
    rng = np.random.default_rng(7)
    rows = [np.float32(np.round(rng.normal(0, 3, contract.width), 1)) for _ in range(25)]  # rounding makes ties
    rows[0][:] = -1  # no root selected
    got = {r["sample_id"]: r for r in decode_logits(logit_frame(spark, rows), contract).collect()}
    for i, row in enumerate(rows):
        want, found = brute_force(row, contract), got[f"d{i}"]
        assert found["roots"] == want["roots"] and found["exact"] == want["exact"]
        assert found["auxiliary_primary"] == want["primary"] and found["document_state"].asDict() == want["state"]
        roots = {c: want["root_score"][contract.roots.index(c)] for c in want["roots"]}
        exact = {c: want["exact_score"][contract.exact.index(c)] for c in want["exact"]}
        assert found["root_probabilities"] == pytest.approx(roots) and found["exact_probabilities"] == pytest.approx(exact)
    assert got["d0"]["roots"] == [] and got["d0"]["exact"] == []


def test_row_form_long_form_and_sql_function_agree(spark):
    contract = wide_contract(6, 120, seed=3)
    rng = np.random.default_rng(3)
    frame = logit_frame(spark, np.float32(np.round(rng.normal(1, 3, (60, contract.width)), 1)))
    row_form = {(r["sample_id"], r["code"]) for r in membership(decode_logits(frame, contract), "exact").collect()}
    ranked = exact_rank(frame, contract, taxonomy_table(spark, contract))
    long_form = [(r["sample_id"], r["code"]) for r in decode_long(ranked).select("sample_id", "code").collect()]
    assert row_form == set(long_form) and len(long_form) == len(row_form) > 100
    register_decode_function(spark, contract, "decode_small")
    frame.createOrReplaceTempView("small_logits")
    by_sql = spark.sql("SELECT sample_id, kind, code, score FROM (SELECT sample_id, decode_small(logits) AS found FROM small_logits) LATERAL VIEW OUTER inline(found) AS kind, code, score WHERE kind IS NOT NULL")
    both = all_memberships(decode_logits(frame, contract)).select("sample_id", "kind", "code", "score")
    assert both.exceptAll(by_sql.select("sample_id", "kind", "code", "score")).isEmpty() and both.count() == by_sql.count()


SMALL = HeadContract(["S", "T"], ["S", "S.A", "S.A.B", "S.AB", "T.A", "T.B"], [0, 0, 0, 0, 1, 1])


def sets(spark, root_scores, exact_scores, wanted=None, **kwargs):
    schema = "root_scores array<float>, exact_scores array<float>, wanted array<string>"
    values = [float(x) for x in root_scores], [float(x) for x in exact_scores], wanted
    row = predict_sets(spark.createDataFrame([values], schema), SMALL, **kwargs).first()
    return row["roots"], row["exact"]


def test_thresholds_are_inclusive_and_compared_as_doubles(spark):
    assert sets(spark, [0.5, 0.49999], [0.0, 0.96, 0.0, 0.0, 0.99, 0.99]) == (["S"], ["S.A"])
    # single-precision 0.95 is a little less than 0.95
    assert sets(spark, [0.9, 0.0], [0.95, 0.0, 0.0, 0.0, 0.0, 0.0]) == (["S"], [])
    assert sets(spark, [0.9, 0.0], [0.5, 0, 0, 0, 0, 0], exact_threshold=0.5) == (["S"], ["S"])


def test_ties_prefer_the_smaller_code_and_dots_matter(spark):
    assert sets(spark, [0.9, 0.9], [0.97, 0.97, 0.97, 0.97, 0.97, 0.97]) == (["S", "T"], ["S", "T.A", "T.B"])
    assert sets(spark, [0.9, 0.0], [0.0, 0.97, 0.98, 0.97, 0, 0]) == (["S"], ["S.A.B", "S.AB"])


def test_named_roots_replace_the_gate(spark):
    scores = [0.0, 0.97, 0.0, 0.0, 0.99, 0.0]
    assert sets(spark, [0.0, 0.9], scores, roots="wanted", wanted=["S"]) == (["S"], ["S.A"])
    assert sets(spark, [0.9, 0.9], scores, roots="wanted", wanted=[]) == ([], [])
    assert sets(spark, [0.9, 0.9], scores, roots="wanted", wanted=["T", "T", "X"]) == (["T", "T", "X"], ["T.A", "T.A"])


def test_bad_logits_stop_the_query(spark):
    good = [0.0] * SMALL.width
    for bad in (good[:-1], good[:-1] + [float("nan")], [float("inf")] + good[1:]):
        with pytest.raises(Exception, match="finite logits"):
            decode_logits(logit_frame(spark, [good, bad]), SMALL).collect()


def test_contract_is_checked_and_read(spark, tmp_path):
    with pytest.raises(InvalidInput):
        HeadContract(["A"], ["A.B"], [1])
    with pytest.raises(InvalidInput):
        HeadContract(["A"], ["A.B", "A.B"], [0, 0])
    path = tmp_path / "head.json"
    value = dict(roots=SMALL.roots, exact=SMALL.exact, exact_root_indices=SMALL.exact_root_indices)
    path.write_text(json.dumps(value, indent=2))
    assert read_contract(spark, str(path)) == SMALL
    path.write_text(json.dumps({**value, "output_labels": ["x"]}))
    with pytest.raises(InvalidInput):
        read_contract(spark, str(path))


def test_catalog_lookup_and_layout_difference(spark, tmp_path):
    path = tmp_path / "catalog.json"
    path.write_text(json.dumps({"S.A": {"label": "Alpha", "parent": "S", "prompt_definition": "d"}, "T.A": {"label": "Tau", "parent": "T"}}))
    table = taxonomy_table(spark, SMALL, read_catalog(spark, str(path)))
    rows = spark.createDataFrame([("x", "S.A", 0.9), ("x", "T.B", 0.9)], "sample_id string, code string, score double")
    got = {r["code"]: (r["label"], r["parent"], r["definition"]) for r in label_memberships(rows, table).collect()}
    assert got == {"S.A": ("Alpha", "S", "d"), "T.B": (None, None, None)}
    other = HeadContract(SMALL.roots, SMALL.exact[:-1] + ["T.C"], SMALL.exact_root_indices)
    plain = taxonomy_table(spark, SMALL)
    assert table_difference(plain, taxonomy_table(spark, SMALL)).isEmpty()
    assert sorted((r["code"], r["side"]) for r in table_difference(plain, taxonomy_table(spark, other)).collect()) == [
        ("T.B", "left"), ("T.C", "right"),
    ]


def test_normalize_typed_columns(spark):
    rows = [("a", "x", None, None, None), ("", "x", None, "", True), (None, "x", None, "s", False), ("b", " 　", None, "s", None)]
    frame = spark.createDataFrame(rows, "sample_id string, text_window string, metadata_compact map<string,string>, source_family string, raw_windowed boolean")
    got = normalize(frame).collect()
    assert [r["violations"] for r in got] == [[], ["bad_sample_id"], ["bad_sample_id"], ["bad_text"]]
    assert [r["source_family"] for r in got] == ["unspecified", "unspecified", "s", "s"]
    numbers = spark.createDataFrame([(1, "x", 1)], "sample_id int, text_window string, raw_windowed int")
    assert normalize(numbers).first()["violations"] == ["bad_sample_id", "bad_raw_windowed"]
    nested = spark.createDataFrame(
        [("a", "x", ("k", float("nan")), ("T", 2.5))],
        "sample_id string, text_window string, source_locator struct<z: string, a: double>, metadata_compact struct<title: string, date: double>",
    )
    row = normalize(nested, keep=[]).first()
    assert row["violations"] == ["bad_source_locator"] and row["exact_line"] is not None
    plain = normalize(nested.withColumn("source_locator", F.lit("docs/1"))).first()
    assert plain["source_locator"] == '"docs/1"'


def test_text_limit_counts_characters(spark):
    frame = spark.createDataFrame([("a", "é" * 8), ("b", "é" * 9)], "sample_id string, text_window string")
    assert [r["violations"] for r in normalize(frame, max_record_chars=8).collect()] == [[], ["text_too_long"]]


def test_duplicates(spark):
    one = spark.range(100).select(F.col("id").cast("string").alias("sample_id"))
    assert not has_duplicates(one, ["sample_id"])
    with pytest.raises(DuplicateDocuments):
        require_unique(one.unionByName(one.limit(1)), ["sample_id"])
    more = spark.createDataFrame([("5",), ("x",), ("x",), ("y",)], "sample_id string")
    for small in (True, False):
        assert sorted(r[0] for r in repeated_ids(more, one, small_batch=small).collect()) == ["5", "x"]


PREDICTION = "sample_id string, exact array<string>, roots array<string>, root_probabilities map<string,double>, exact_probabilities map<string,double>, empty_exact boolean, truncated boolean, raw_windowed boolean"


def test_review_reasons_keep_their_order(spark):
    rows = [("a", [], [], {}, {}, True, True, True), ("b", [], [], {}, {}, False, False, None), ("c", [], [], {}, {}, False, True, None)]
    got = [(r["sample_id"], r["reasons"]) for r in review_queue(spark.createDataFrame(rows, PREDICTION)).collect()]
    assert got == [("a", ["no_exact_label", "token_truncated", "raw_windowed"]), ("c", ["token_truncated"])]


def test_absent_fields_export_as_null(spark):
    rows = [("a", ["S.A"], ["S"], {"S": 0.8}, {"S.A": 0.96}, False, False, None)]
    frame = spark.createDataFrame(rows, PREDICTION)
    row = export_documents(frame).first()
    assert (row["source_locator_json"], row["document_state_json"], row["token_ids_sha256"]) == ("null", "null", None)
    with pytest.raises(Exception, match="without a score"):
        broken = frame.withColumn("exact", F.array(F.lit("S.B")))
        membership(broken, "exact").collect()


def test_metrics(spark):
    given = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), ("c", "x")], "sample_id string, code string")
    gold = spark.createDataFrame([("a", "x"), ("b", "y"), ("d", None)], "sample_id string, code string")
    row = label_metrics(given, gold).first()
    assert (row["tp"], row["fp"], row["fn"]) == (1, 2, 1)
    assert (row["precision"], row["recall"], row["micro_f1"]) == pytest.approx((1 / 3, 1 / 2, 2 / 5))


def test_pooling(spark):
    rng = np.random.default_rng(5)
    docs = {0: [1, 2, 0, 3, 0], 1: [0, 0, 0], 2: [4], 3: [0, 5]}
    rows = [(d, p, t, [float(x) for x in rng.normal(size=4)]) for d, ids in docs.items() for p, t in enumerate(ids)]
    frame = spark.createDataFrame(rows, "doc int, pos int, token_id int, vec array<float>")
    last = {r["doc"]: r["pooled"] for r in last_pool(frame, key="doc", pad=0).collect()}
    at = {0: 3, 1: 0, 2: 0, 3: 1}
    vectors = {(d, p): np.float32(v) for d, p, _, v in rows}
    for d, p in at.items():
        assert last[d] == pytest.approx(list(vectors[d, p]))
    end = {r["doc"]: r["pooled"] for r in last_pool(frame, key="doc").collect()}
    assert end[0] == pytest.approx(list(vectors[0, 4]))
    some = frame.where("doc <> 1").withColumn("mask", F.col("token_id") != 0)
    want = {d: np.mean([vectors[d, p] for p, t in enumerate(ids) if t], axis=0) for d, ids in docs.items() if any(ids)}
    mean = {r["doc"]: r["pooled"] for r in mean_pool(some, 4, key="doc").collect()}
    assert set(mean) == set(want) and all(mean[d] == pytest.approx(list(want[d]), abs=1e-6) for d in want)
    with pytest.raises(Exception, match="no unmasked token"):
        mean_pool(frame.withColumn("mask", F.col("token_id") != 0), 4, key="doc").collect()
    for dim in (3, 5):
        with pytest.raises(Exception, match="is not"):
            mean_pool(some, dim, key="doc").collect()
    holes = some.withColumn("vec", F.transform("vec", lambda x, i: F.when(i > 0, x)))
    with pytest.raises(Exception, match="is not"):
        mean_pool(holes, 4, key="doc").collect()


SAFE = ["file", "deep/er/file.txt", "x..y/z", "./here", "a//b", "...", "über/日本"]
UNSAFE = ["..", "up/..", "in/../../out", "/from/root", "", ".", "./.", "//", "back\\slash", None]


def test_paths_that_stay_inside_a_folder(spark):
    frame = spark.createDataFrame([(p,) for p in SAFE + UNSAFE], "p string")
    kept = [r["p"] for r in frame.where(is_safe_path(F.col("p"))).collect()]
    assert kept == SAFE and frame.where(is_safe_path(F.col("p")).isNull()).isEmpty()


def test_files_are_hashed_block_by_block(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(integrity, "BLOCK_BYTES", 1000)
    contents = {"empty.bin": b"", "one block.bin": b"x" * 1000, "a%20b/odd.bin": os.urandom(12_345)}
    for name, content in contents.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(content)
    want = {n: (len(c), hashlib.sha256(c).hexdigest()) for n, c in contents.items()}
    for opens in (True, False):  # in a store that tasks can't open, Spark reads the files
        monkeypatch.setattr(integrity, "can_open", lambda path: opens)
        assert {r["path"]: (r["bytes"], r["sha256"]) for r in file_inventory(spark, str(tmp_path)).collect()} == want


@pytest.mark.skipif("TAXAFLOW_LARGE" not in os.environ, reason="writes a sparse file of 3 GB")
def test_a_file_above_two_gigabytes(spark, tmp_path):
    size = 3 << 30
    with (tmp_path / "large.bin").open("wb") as out:
        out.truncate(size)
        out.seek(size - 3)
        out.write(b"end")
    total = hashlib.sha256()
    for _ in range(size // (1 << 20) - 1):
        total.update(bytes(1 << 20))
    total.update(bytes((1 << 20) - 3) + b"end")
    (row,) = file_inventory(spark, str(tmp_path)).collect()
    assert (row["bytes"], row["sha256"]) == (size, total.hexdigest())


def test_two_sided_comparisons_count_copies(spark):
    left = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), (None, 2), ("c", 3)], "k string, v int")
    right = spark.createDataFrame([("a", 1), ("b", None), (None, 2), ("d", 4), ("d", 4)], "k string, v int")
    rows = sorted(tuple(r) for r in table_difference(left, right).collect())
    assert rows == [("a", 1, "left"), ("c", 3, "left"), ("d", 4, "right"), ("d", 4, "right")]
    assert sorted(tuple(r) for r in key_mismatch(left, right, "k").collect()) == [("c", "left"), ("d", "right"), ("d", "right")]


def test_a_hash_collision_is_no_duplicate(spark, monkeypatch):
    monkeypatch.setattr(F, "xxhash64", lambda *keys: F.length(keys[0]).cast("bigint"))
    frame = spark.createDataFrame([("ab",), ("cd",), ("x",), ("longest",)], "sample_id string")
    assert sorted(r[0] for r in suspects(frame, ["sample_id"]).collect()) == ["ab", "cd"]
    assert not has_duplicates(frame, ["sample_id"])
    assert has_duplicates(frame.unionAll(frame.where("sample_id = 'cd'")), ["sample_id"])
    monkeypatch.setattr(duplicates, "MAX_BROADCAST_HASHES", 0)
    assert not has_duplicates(frame, ["sample_id"]) and suspects(frame.limit(0), ["sample_id"]) is None


def test_registry_audit_of_real_files(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name in ("a.txt", "sub/b.txt", "sub/c.txt"):
        (tmp_path / name).write_text(name)
    found = file_inventory(spark, str(tmp_path))
    want = {n: hashlib.sha256(n.encode()).hexdigest() for n in ("a.txt", "sub/b.txt", "sub/c.txt")}
    assert {r["path"]: r["sha256"] for r in found.collect()} == want
    registry = tmp_path.parent / (tmp_path.name + "-registry.json")
    entries = {n: dict(bytes=len(n), sha256=s) for n, s in want.items() if n != "a.txt"}
    entries["gone.txt"] = dict(bytes=1, sha256="0")
    entries["../out"] = dict(bytes=1, sha256="0")
    registry.write_text(json.dumps(dict(format="any", files=entries)))
    (tmp_path / "sub/b.txt").write_text("b changed")
    audit = {r["path"]: r["status"] for r in registry_audit(read_registry(spark, str(registry)), found).collect()}
    assert audit == {
        "a.txt": "unregistered", "sub/b.txt": "changed", "sub/c.txt": "ok", "gone.txt": "missing", "../out": "unsafe_path",
    }
    required = spark.createDataFrame([("sub/b.txt",), ("model.bin",)], "path string")
    assert [r[0] for r in missing_required(required, read_registry(spark, str(registry))).collect()] == ["model.bin"]


def test_file_set_digest_ignores_order_but_not_content(spark):
    rows = [(f"pkg/{i}.py", i, hashlib.sha256(str(i).encode()).hexdigest()) for i in range(20)]
    schema = "path string, bytes bigint, sha256 string"
    digest = lambda r: file_set_digest(spark.createDataFrame(r, schema)).first()["digest"]
    assert digest(rows) == digest(rows[::-1])
    assert digest(rows) != digest(rows[:-1] + [("pkg/nested/model.py", *rows[-1][1:])])
    assert digest(rows) != digest(rows[:-1] + [(*rows[-1][:2], "0" * 64)])


def test_manifest_rules(spark, tmp_path):
    def faults(shards, total):
        frame = spark.createDataFrame(shards, "id string, path string, rows bigint")
        return sorted((r["id"] or "", r["fault"]) for r in manifest_faults(frame, total).collect())

    good = [("shard-000000", "inputs/shard-000000.jsonl", 3), ("shard-1000000", "inputs/shard-1000000.jsonl", 4)]
    assert faults(good, 7) == []
    assert faults(good, 8) == [("", "row_count_mismatch")]
    assert faults([("shard-00000x", "inputs/shard-00000x.jsonl", 1)], 1) == [("shard-00000x", "invalid_id")]
    assert faults([("shard-000000", "../shard-000000.jsonl", 1)], 1) == [("shard-000000", "unexpected_path")]
    assert faults([("shard-000000", "inputs/shard-000000.jsonl", 0)], 0) == [("shard-000000", "invalid_rows")]
    assert ("shard-000000", "duplicate_id") in faults([good[0], good[0]], 6)
    path = tmp_path / "manifest.json"
    path.write_text(json.dumps(dict(format="any", rows=7, shard_rows=3, shards=[dict(id=i, path=p, rows=n, bytes=1, sha256="0") for i, p, n in good]), indent=2))
    record, shards = read_manifest_file(spark, str(path))
    assert record.first()["rows"] == 7 and manifest_faults(shards, 7).isEmpty()


def test_receipts_and_keys(spark):
    shards = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("c", 3, "z")], "id string, rows bigint, digest string")
    receipts = spark.createDataFrame([("a", 1, "x", "p"), ("b", 2, "other", "q"), ("d", 1, "w", "r")], "id string, rows bigint, input_digest string, predictions_digest string")
    observed = spark.createDataFrame([("a", 1, "changed"), ("b", 2, "q")], "id string, rows bigint, digest string")
    got = {r["id"]: r["status"] for r in receipt_audit(shards, receipts, observed).collect()}
    assert got == {"a": "corrupt", "b": "provenance_mismatch", "c": "pending", "d": "unknown_shard"}
    assert sorted((r["id"], r["side"]) for r in key_mismatch(shards, receipts, "id").collect()) == [("c", "left"), ("d", "right")]
    require_same_binding(dict(a=1), dict(a=1))
    with pytest.raises(BindingMismatch, match="a, b"):
        require_same_binding(dict(a=1), dict(a=2, b=1))


def test_prediction_lines_round_trip(spark, tmp_path):
    lines = [
        dict(sample_id="a", roots=["S"], exact=["S.A"], root_probabilities={"S": 0.8}, exact_probabilities={"S.A": 0.96},
             auxiliary_primary="S.A", document_state={"topic_structure": "multi_topic"}, input_tokens=5, visible_tokens=5,
             truncated=False, empty_exact=False, source_locator={"z": 1, "a": "x,y"}, raw_windowed=None),
        dict(sample_id="b", roots=[], exact=[], root_probabilities={}, exact_probabilities={}, truncated=False, empty_exact=True,
             source_locator="plain"),
    ]
    path = tmp_path / "predictions.jsonl"
    path.write_text("".join(json.dumps(line) + "\n" for line in lines))
    got = read_prediction_lines(spark, str(path))
    by_id = {r["sample_id"]: r for r in got.collect()}
    assert by_id["a"]["source_locator"] == '{"z": 1, "a": "x,y"}' and by_id["b"]["source_locator"] == '"plain"'
    assert by_id["a"]["exact_probabilities"] == {"S.A": 0.96} and by_id["b"]["auxiliary_primary"] is None
    write_prediction_lines(got, str(tmp_path / "out"))
    again = {r["sample_id"]: r.asDict() for r in read_prediction_lines(spark, str(tmp_path / "out")).collect()}
    assert again == {k: r.asDict() for k, r in by_id.items()}
    path.write_text('{"sample_id": "a"} trailing\n')
    with pytest.raises(Exception, match="Malformed prediction"):
        read_prediction_lines(spark, str(path)).collect()


def test_many_small_files_share_tasks(spark, tmp_path):
    for i in range(200):
        (tmp_path / f"{i:03d}.txt").write_text(f"text {i}")
    files = hashed_files(spark, [str(tmp_path)])
    assert files.rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism
    assert {(r["bytes"], r["sha256"]) for r in files.collect()} == {
        (len(f"text {i}"), hashlib.sha256(f"text {i}".encode()).hexdigest()) for i in range(200)
    }


def test_words_are_cut_without_trimming(spark, capsys):
    texts = ["", " ", "a", " a", "a ", "\t a\n\nb\x0b\x0c", "a\u00a0b \u2028", None]
    found = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", words(F.col("t")).alias("w"))
    wanted = [None if t is None else [w for w in re.split("[ \t\n\r\f\x0b]+", t) if w] for t in texts]
    assert [r["w"] for r in found.orderBy("i").collect()] == wanted
    found.explain()
    assert "trim(" not in capsys.readouterr().out
