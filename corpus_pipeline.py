"""From raw documents to a training mix: five stages, each written as a table before the next one reads it.

Stages keep the columns of ``documents``; only the last one adds what the mix takes of each.  Toxicity, contamination and
secrets are judged by a row's text.  Near-duplicates are told apart by doc_id: rows without one are kept, and so are all
rows of a doc_id that is kept.  Columns of other names go through; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaflow.llm.common import stored, table, text_or_empty
from taxaflow.llm.decontamination import find_contamination
from taxaflow.llm.minhash import near_duplicates
from taxaflow.llm.mixing import mix_sources, with_keys
from taxaflow.llm.secret_scan import fit_formats, redact_texts
from taxaflow.llm.toxicity import held_out, learn_lexicon, toxicity_score

SHINGLE_WORDS = 5
SIMILARITY = 0.8
TOXIC_FROM = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under TOXIC_FROM."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label")).where(~held_out())
    lexicon = learn_lexicon(docs, labels)
    return docs.where(toxicity_score(text_or_empty("text"), lexicon, spark) < TOXIC_FROM)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest doc_id of each group; of several rows with that doc_id, all."""
    groups = near_duplicates(docs, width=SHINGLE_WORDS, threshold=SIMILARITY)
    gone = stored(groups.where(~F.col("kept")).select("doc_id").distinct(), "gone")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of the benchmark."""
    matches = find_contamination(docs, table(spark, sf_dir, "benchmark"))
    gone = stored(matches.where("exact").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct(), "contaminated")
    # The text decides: rows of one doc_id may differ, and rows without one count too.
    same = docs["doc_id"].eqNullSafe(gone["_id"]) & (F.xxhash64(docs["text"]) == gone["_hash"])
    return docs.join(gone, same, "left_anti").select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret in their texts replaced; n_chars follows the text."""
    flag = "_redacted"
    while flag in docs.columns:
        flag += "_"
    changed = redact_texts(docs, fit_formats(docs), into=flag)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = changed.withColumn("n_chars", F.when(F.col(flag), F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return changed.select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the mix takes words from, with size, target of their source and words taken."""
    small = stored(with_keys(docs.select("doc_id", "source", "text"), table(spark, sf_dir, "labels")).drop("text"), "mixing")
    mixed = mix_sources(small).where("taken > 0")
    return mixed.select("doc_id", "source", "size", "source_size", "target", "taken")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("mixing", mix),
]

# Learned scores, min-hashes and inferred formats have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
