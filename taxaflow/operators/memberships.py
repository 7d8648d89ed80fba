"""The four published tables, each a narrow projection of the predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaflow.functions.arrays import unfold
from taxaflow.functions.json_text import json_string
from taxaflow.operators.taxonomy import STATE_LABELS
from taxaflow.schemas import EXPORT_DOCUMENTS

# Review reasons in their order, each with the flag that gives it.
REVIEW_REASONS = {"no_exact_label": "empty_exact", "token_truncated": "truncated", "raw_windowed": "raw_windowed"}

KINDS = {"root": ("roots", "root_probabilities"), "exact": ("exact", "exact_probabilities")}


def state_json(state: Column, fields: list[str] | None = None) -> Column:
    """Document state as JSON text spaced like Python prints it; absent labels are left out."""
    pieces = [
        F.when(state[name].isNotNull(), F.concat(F.lit(f'"{name}": '), json_string(state[name])))
        for name in fields or list(STATE_LABELS)
    ]
    text = F.concat(F.lit("{"), F.concat_ws(", ", *pieces), F.lit("}"))
    return F.when(state.isNull(), F.lit("null")).otherwise(text)


def export_documents(predictions: DataFrame) -> DataFrame:
    """One row per document.  Fields a prediction lacks become NULL."""
    have = set(predictions.columns)
    columns = []
    for wanted in EXPORT_DOCUMENTS.fields:
        if wanted.name == "source_locator_json":
            value = F.coalesce(F.col("source_locator"), F.lit("null")) if "source_locator" in have else F.lit("null")
        elif wanted.name == "document_state_json":
            value = state_json(F.col("document_state")) if "document_state" in have else F.lit("null")
        elif wanted.name in have:
            value = F.col(wanted.name)
        else:
            value = F.lit(None)
        columns.append(value.cast(wanted.dataType).alias(wanted.name))
    return predictions.select(*columns)


def membership(predictions: DataFrame, kind: str) -> DataFrame:
    """One row per document and code of one kind (``root`` or ``exact``)."""
    codes, scores = KINDS[kind]
    unfolded = unfold(predictions, ["sample_id", F.col(scores).alias("scores")], F.col(codes), "code")
    score = F.try_element_at("scores", F.col("code"))
    missing = F.raise_error(F.concat(F.lit("Selected code without a score: "), F.col("code"))).cast("double")
    return unfolded.select("sample_id", "code", F.coalesce(score, missing).alias("score"))


def all_memberships(predictions: DataFrame) -> DataFrame:
    """Both kinds in one table, told apart by ``kind``; one scan of the predictions."""
    def entries(kind: str) -> Column:
        codes, scores = KINDS[kind]
        return F.transform(
            codes,
            lambda c: F.struct(F.lit(kind).alias("kind"), c.alias("code"), F.try_element_at(scores, c).alias("score")),
        )

    both = F.concat(entries("root"), entries("exact"))
    return unfold(predictions, ["sample_id"], both, "m").select("sample_id", "m.*")


def review_reasons() -> Column:
    return F.array_compact(F.array(*[F.when(F.col(flag), reason) for reason, flag in REVIEW_REASONS.items()]))


def review_queue(predictions: DataFrame) -> DataFrame:
    empty, cut, windowed = (F.coalesce(F.col(flag), F.lit(False)) for flag in REVIEW_REASONS.values())
    return predictions.where(empty | cut | windowed).select("sample_id", review_reasons().alias("reasons"))


EXPORTS = {
    "documents": export_documents,
    "exact_membership": lambda p: membership(p, "exact"),
    "root_membership": lambda p: membership(p, "root"),
    "review_queue": review_queue,
}


def source_rollup(documents: DataFrame) -> DataFrame:
    """Operational counts per source; map-side combined, so a dominant source is cheap."""
    def count(condition: Column) -> Column:
        return F.count(F.when(condition, 1))

    return documents.groupBy("source_family").agg(
        F.count(F.lit(1)).alias("documents"),
        count(F.col("empty_exact")).alias("without_exact"),
        count(F.col("truncated")).alias("token_truncated"),
        count(F.col("raw_windowed")).alias("raw_windowed"),
        F.sum(F.size("exact")).cast("bigint").alias("exact_labels"),
    )


def label_metrics(predicted: DataFrame, gold: DataFrame) -> DataFrame:
    """Micro precision, recall and F1 of ``(sample_id, code)`` pairs over the documents in ``gold``.

    A gold row without a code marks a checked document with no label.
    """
    checked = gold.select("sample_id").distinct()
    wanted = gold.where("code is not null").select("sample_id", "code").distinct().withColumn("g", F.lit(1))
    given = (
        predicted.select("sample_id", "code").distinct().join(checked, "sample_id", "left_semi").withColumn("p", F.lit(1))
    )
    sums = given.join(wanted, ["sample_id", "code"], "full_outer").agg(
        F.count(F.when(F.col("p").isNotNull() & F.col("g").isNotNull(), 1)).alias("tp"),
        F.count(F.when(F.col("p").isNotNull() & F.col("g").isNull(), 1)).alias("fp"),
        F.count(F.when(F.col("p").isNull() & F.col("g").isNotNull(), 1)).alias("fn"),
    )
    ratio = lambda a, b: F.try_divide(a.cast("double"), b.cast("double"))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return sums.select(
        "tp", "fp", "fn",
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("micro_f1"),
    )
