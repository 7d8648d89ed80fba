"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import SparkSession

import taxaflow

# Python stages carry their own code, so executors need no installed package.
cloudpickle.register_pickle_by_value(taxaflow)

# Needed for right results: the last of two equal JSON keys wins, as in Python.
REQUIRED_CONF = {"spark.sql.variant.allowDuplicateKeys": "true"}

# Sensible defaults for large jobs; a cluster's own values are kept.
TUNING_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows with long texts: bound Arrow batches by size, not by row count alone.
    "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings right results depend on to a running session."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "taxaflow", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**TUNING_CONF, **REQUIRED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def _configured_dir(spark: SparkSession) -> str | None:
    value = spark.conf.get("spark.checkpoint.dir", None)
    return value or spark.sparkContext.getConf().get("spark.checkpoint.dir")


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the folder every executor can reach.

    The cluster names the folder in ``spark.checkpoint.dir``.  Only a local
    session may fall back to a temporary folder of this machine.
    """
    base = _configured_dir(spark)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("Set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="taxaflow-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/taxaflow-{purpose}-{uuid.uuid4().hex}"
