"""Head contract: which logit belongs to which code."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaflow.errors import InvalidInput
from taxaflow.operators.integrity import signed_counts, surplus
from taxaflow.schemas import TAXONOMY

# Document-state outputs and their labels in logit order.
STATE_LABELS = {
    "document_integrity": ["boilerplate", "coherent", "fragment", "stitched"],
    "topic_structure": ["indeterminate", "multi_topic", "single_topic"],
    "labelability": ["insufficient_evidence", "labelable"],
}

# Inclusive selection thresholds.
ROOT_THRESHOLD = 0.5
EXACT_THRESHOLD = 0.95

# Codes are written into plans and broadcast; beyond this a contract is refused.
MAX_CODES = 100_000


@dataclass(frozen=True)
class HeadContract:
    """Logit layout: roots, exact codes, one primary logit per exact code, states."""

    roots: list[str]
    exact: list[str]
    exact_root_indices: list[int]
    states: dict[str, list[str]] = field(default_factory=lambda: dict(STATE_LABELS))

    def __post_init__(self):
        if not self.roots or not self.exact or len(self.exact) != len(self.exact_root_indices):
            raise InvalidInput("A head contract needs roots, exact codes and one root index per exact code")
        if len(set(self.roots)) != len(self.roots) or len(set(self.exact)) != len(self.exact):
            raise InvalidInput("Codes of a head contract must be distinct")
        if not all(0 <= i < len(self.roots) for i in self.exact_root_indices):
            raise InvalidInput("Root index out of range")
        if any("\n" in code for code in [*self.roots, *self.exact]):
            raise InvalidInput("A code must not hold a line break")
        if len(self.roots) + len(self.exact) > MAX_CODES:
            raise InvalidInput("Too many codes for a head contract")

    @property
    def exact_offset(self) -> int:
        return len(self.roots)

    @property
    def primary_offset(self) -> int:
        return len(self.roots) + len(self.exact)

    @property
    def state_offsets(self) -> dict[str, int]:
        offsets, at = {}, self.primary_offset + len(self.exact)
        for name, labels in self.states.items():
            offsets[name] = at
            at += len(labels)
        return offsets

    @property
    def width(self) -> int:
        return self.primary_offset + len(self.exact) + sum(map(len, self.states.values()))

    def to_json(self) -> str:
        return json.dumps(
            dict(roots=self.roots, exact=self.exact, exact_root_indices=self.exact_root_indices, states=self.states),
            ensure_ascii=False, sort_keys=True,
        )


def read_contract(spark: SparkSession, path: str) -> HeadContract:
    """Head contract from its JSON file (``roots, exact, exact_root_indices``)."""
    text = spark.read.text(path, wholetext=True).first()
    if text is None:
        raise InvalidInput(f"Empty head contract: {path}")
    value = json.loads(text[0])
    contract = HeadContract(value["roots"], value["exact"], value["exact_root_indices"])
    labels = value.get("output_labels")
    if labels is not None and len(labels) != contract.width:
        raise InvalidInput("Output labels do not fit the head layout")
    return contract


def taxonomy_table(spark: SparkSession, contract: HeadContract, catalog: DataFrame | None = None) -> DataFrame:
    """One row per root and exact code; ``catalog`` adds parent, label and definition."""
    rows = [("root", i, code, code) for i, code in enumerate(contract.roots)]
    rows += [
        ("exact", i, code, contract.roots[contract.exact_root_indices[i]]) for i, code in enumerate(contract.exact)
    ]
    names = ["head", "idx", "code", "root_code"]
    # An Arrow table becomes a local relation: Spark knows its size and may broadcast it.
    table = spark.createDataFrame(pa.table(dict(zip(names, map(list, zip(*rows))))))
    table = table.withColumn("idx", F.col("idx").cast("int"))
    if catalog is None:
        empty = [F.lit(None).cast("string").alias(c) for c in ("parent", "label", "definition")]
        return table.select("*", *empty)
    return table.join(catalog.select("code", "parent", "label", "definition"), "code", "left").select(
        TAXONOMY.fieldNames()
    )


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Code catalog (JSON map of code to ``label, parent, prompt_definition``) as rows."""
    entry = "struct<label: string, parent: string, prompt_definition: string>"
    codes = F.from_json("value", f"map<string, {entry}>")
    listed = F.when(codes.isNotNull(), codes).otherwise(F.raise_error(F.lit(f"Not a code catalog: {path}")))
    return (
        spark.read.text(path, wholetext=True)
        .select(F.explode(listed).alias("code", "entry"))
        .select("code", "entry.parent", "entry.label", F.col("entry.prompt_definition").alias("definition"))
    )


def label_memberships(memberships: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Memberships with label, parent and definition.

    No broadcast is forced: Spark does it when the taxonomy's measured size allows.
    """
    names = taxonomy.select("code", "parent", "label", "definition").dropDuplicates(["code"])
    return memberships.join(names, "code", "left")


def table_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows only one side has, duplicates counted; empty if the tables are equal."""
    more = F.col("in_left") - F.col("in_right")
    return surplus(signed_counts(left, right, left.columns), left.columns, more, -more)
