"""Inputs that must stop a query instead of giving labels or empty tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from taxaflow.operators.decode import exact_rank, register_decode_function, selected
from taxaflow.operators.taxonomy import HeadContract, read_catalog, taxonomy_table
from taxaflow.plans.run import code_digest
from taxaflow.sources.jobs import read_registry


@pytest.fixture(scope="module")
def small_contract():
    return HeadContract(["P", "Q"], ["P.X", "Q.Y"], [0, 1])


def test_cut_off_registry_and_catalog_stop(spark, tmp_path):
    path = tmp_path / "cut.json"
    path.write_text('{"files": {"a": {"bytes": 1, "sha')
    with pytest.raises(Exception, match="Not a registry"):
        read_registry(spark, str(path)).collect()
    with pytest.raises(Exception, match="Not a code catalog"):
        read_catalog(spark, str(path)).collect()


def test_nan_scores_select_nothing(spark):
    frame = spark.createDataFrame([([float("nan"), 0.9],)], "s array<double>")
    assert [e["code"] for e in frame.select(selected(F.col("s"), ["a", "b"], 0.5).alias("e")).first()["e"]] == ["b"]


@pytest.mark.parametrize("wrong", ["nan", "short"])
def test_every_decoder_refuses_bad_logits(spark, small_contract, wrong):
    values = np.ones(small_contract.width)
    logits = [float("nan"), *values[1:].tolist()] if wrong == "nan" else values[:-1].tolist()
    frame = spark.createDataFrame([("d", logits)], "sample_id string, logits array<float>")
    with pytest.raises(Exception, match="finite logits"):
        exact_rank(frame, small_contract, taxonomy_table(spark, small_contract)).collect()
    register_decode_function(spark, small_contract, "decode_guarded")
    frame.createOrReplaceTempView("guarded")
    with pytest.raises(Exception, match="finite logits"):
        spark.sql("SELECT decode_guarded(logits) AS m FROM guarded").collect()


def test_code_digest_is_stable():
    assert code_digest() == code_digest() and len(code_digest()) == 64
