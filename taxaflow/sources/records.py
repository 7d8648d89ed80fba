"""Record sources: JSONL (plain, gzip, zstd), Parquet, or any DataFrame.

Every reader returns the same *field* columns, so one normalization serves all
of them.  ``file_path, block_start, seq`` order the rows as they stand in the
input: ``seq`` rises within one input split and splits order by offset.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxaflow.errors import InvalidInput
from taxaflow.functions.json_text import (
    json_string, has_fraction, python_spacing, strict_json, unpaired_surrogate, variant_type,
)
from taxaflow.functions.locators import locator_parts
from taxaflow.functions.metadata import ALLOWED_KEYS, OVERLAY_KEY, canonical_strings, with_canonical_metadata
from taxaflow.functions.scores import is_finite
from taxaflow.functions.text import is_nonblank
from taxaflow.session import configure
from taxaflow.sources.tables import PLACE, scan_tables

MAX_RECORD_CHARS = 8_000_000
RUN_LINES = 16_384
# Suffixes that Spark unpacks but takes for plain text when it cuts files into splits.
WHOLE_SUFFIXES = (".zstd", ".gzip")
WHOLE_FILE_BYTES = 1 << 40
RECORD_COLUMNS = ["metadata_compact", "source_family", "source_locator", "raw_windowed"]
ORDER = ["file_path", "block_start", "seq"]
FIELDS = [
    "scan_error", "sample_id", "text_window", "metadata_compact", "source_family", "family_error",
    "source_locator", "locator_error", "raw_windowed", "flag_error", "exact_line", "exact_layers",
]


def _paths(path: str | Iterable[str]) -> list[str]:
    return [path] if isinstance(path, str) else list(path)


def is_parquet(path: str, input_format: str = "auto") -> bool:
    """Whether a path is read as Parquet: by its suffix, or as the caller says."""
    if input_format not in ("auto", "parquet", "lines"):
        raise InvalidInput(f"Unknown input format: {input_format}")
    return input_format == "parquet" or (input_format == "auto" and path.rstrip("/").endswith(".parquet"))


def read_records(
    spark: SparkSession,
    path: str | Iterable[str],
    *,
    id_field: str = "sample_id",
    text_field: str = "text_window",
    max_record_chars: int = MAX_RECORD_CHARS,
    input_format: str = "auto",
    spread: int | None = None,
) -> DataFrame:
    """Field columns of all records below ``path`` (files, folders or globs).

    A ``.parquet`` suffix selects the Parquet reader, everything else is read
    as JSONL unless ``input_format`` says otherwise; Spark unpacks ``.gz``, ``.zst`` and ``.zstd`` by suffix.

    A compressed text file is read by one task.  ``spread`` hands its lines, in
    runs of :data:`RUN_LINES`, to that many tasks before they are parsed; use it
    if a few large files would keep the rest of the cluster waiting.
    """
    configure(spark)
    paths = _paths(path)
    tables = [p for p in paths if is_parquet(p, input_format)]
    lines = [p for p in paths if not is_parquet(p, input_format)]
    parts = []
    if lines:
        scanned = scan_lines(spark, lines, max_record_chars)
        if spread:
            scanned = scanned.repartition(spread, F.floor(F.col("seq") / RUN_LINES)).sortWithinPartitions(*ORDER)
        parts.append(fields_from_lines(scanned, id_field, text_field))
    for scan in scan_tables(spark, tables, [id_field, text_field, *RECORD_COLUMNS]) if tables else []:
        parts.append(fields_from_columns(scan, id_field, text_field, place=PLACE))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def scan_lines(spark: SparkSession, paths: str | list[str], max_record_chars: int = MAX_RECORD_CHARS) -> DataFrame:
    """Non-blank lines with their place in the input and a ``scan_error``.

    The limit counts the line break, and a blank line over the limit is an
    error too.
    """
    listing = spark.read.text(paths)
    whole = F.lower("_metadata.file_name").rlike("|".join(f"\\{s}$" for s in WHOLE_SUFFIXES))
    if any(f.lower().endswith(WHOLE_SUFFIXES) for f in listing.inputFiles()):
        # Both conditions are about names only, so each scan leaves the other's files alone.
        lines = _lines_of(listing.where(~whole)).union(_lines_of(_uncut(spark).read.text(paths).where(whole)))
    else:
        lines = _lines_of(listing)
    return with_scan_errors(lines, max_record_chars).withColumn("seq", F.monotonically_increasing_id())


def _lines_of(scan: DataFrame) -> DataFrame:
    return scan.select(
        "value", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("block_start")
    )


def _uncut(spark: SparkSession) -> SparkSession:
    """A session that reads each file in one task; what is done with its scans goes by the caller's settings."""
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if session.conf.get(key, None) != value:  # set in the running session, stores' keys among them
            session.conf.set(key, value)
    for name in ("maxPartitionBytes", "openCostInBytes"):
        session.conf.set(f"spark.sql.files.{name}", str(WHOLE_FILE_BYTES))
    return session


def with_scan_errors(lines: DataFrame, max_record_chars: int) -> DataFrame:
    """Skip blank lines and mark unreadable ones."""
    value = F.col("value")
    too_large = F.length(value) + 1 > max_record_chars
    return lines.where(is_nonblank(value) | too_large).withColumn(
        "scan_error",
        F.when(too_large, "record_too_large")
        .when(~F.is_valid_utf8(value), "invalid_utf8")
        .when(unpaired_surrogate(value), "unpaired_surrogate"),
    )


def _get(record: Column, field: str) -> Column:
    return F.try_variant_get(record, f"$['{field}']", "variant")


def _text_of(value: Column) -> Column:
    """The string a VARIANT holds, NULL if it holds anything else."""
    return F.when(variant_type(value) == "STRING", F.try_variant_get(value, "$", "string"))


def fields_from_lines(lines: DataFrame, id_field: str, text_field: str) -> DataFrame:
    """Field columns of JSON lines (columns ``value, scan_error`` and the order columns)."""
    value = F.col("value")
    parsed = lines.withColumn("record", F.when(F.col("scan_error").isNull(), strict_json(value)))
    record = F.col("record")
    kind = variant_type(record)
    opened = parsed.select(
        *ORDER,
        value,
        F.coalesce(
            F.col("scan_error"),
            F.when(record.isNull(), "malformed_json").when(~kind.startswith("OBJECT"), "not_an_object"),
        ).alias("scan_error"),
        _text_of(_get(record, id_field)).alias("sample_id"),
        _text_of(_get(record, text_field)).alias("text_window"),
        _get(record, "metadata_compact").alias("metadata"),
        _get(record, "source_family").alias("family"),
        _get(record, "source_locator").alias("locator"),
        _get(record, "raw_windowed").alias("flag"),
    )
    family, locator, flag = F.col("family"), F.col("locator"), F.col("flag")
    family_kind, locator_kind, flag_kind = variant_type(family), variant_type(locator), variant_type(flag)
    falsy = (
        family_kind.isin("VOID", "OBJECT<>")
        | ((family_kind == "BOOLEAN") & ~F.coalesce(F.try_variant_get(family, "$", "boolean"), F.lit(False)))
        | (family_kind.startswith("ARRAY") & F.try_variant_get(family, "$[0]", "variant").isNull())
        | (
            ((family_kind == "BIGINT") | (family_kind == "DOUBLE") | family_kind.startswith("DECIMAL"))
            & (F.coalesce(F.try_variant_get(family, "$", "double"), F.lit(1.0)) == 0)
        )
    )
    number = F.try_variant_get(locator, "$", "double")
    not_finite = F.coalesce((locator_kind == "DOUBLE") & ~is_finite(number), F.lit(False))
    fields = opened.select(
        *ORDER,
        value,
        "scan_error", "sample_id", "text_window", "metadata",
        _text_of(family).alias("source_family"),
        F.coalesce((family_kind != "STRING") & ~falsy, F.lit(False)).alias("family_error"),
        locator_parts(value, locator).alias("locator_parts"),
        not_finite.alias("locator_error"),
        F.when(flag_kind == "BOOLEAN", F.try_variant_get(flag, "$", "boolean")).alias("raw_windowed"),
        F.coalesce(~flag_kind.isin("BOOLEAN", "VOID"), F.lit(False)).alias("flag_error"),
    )
    fields = with_canonical_metadata(fields, "metadata")
    parts = F.col("locator_parts")
    return fields.select(
        *ORDER,
        "scan_error", "sample_id", "text_window", "metadata_compact", "source_family", "family_error",
        parts["text"].alias("source_locator"), "locator_error", "raw_windowed", "flag_error",
        F.when(F.col("scan_error").isNull() & (F.col("metadata_inexact") | parts["reprint"]), value).alias("exact_line"),
        F.col("metadata_layers").alias("exact_layers"),
    )


def _holds(kind: T.DataType, leaves: tuple[type, ...]) -> bool:
    """True if a type is, or contains, one of the given types."""
    if isinstance(kind, T.StructType):
        return any(_holds(f.dataType, leaves) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _holds(kind.elementType, leaves)
    if isinstance(kind, T.MapType):
        return _holds(kind.keyType, leaves) or _holds(kind.valueType, leaves)
    return isinstance(kind, leaves)


_FLOATING = (T.FloatType, T.DoubleType)
_FRACTIONS = (T.FloatType, T.DoubleType, T.DecimalType, T.VariantType)


def _plain_metadata(kind: T.DataType | None) -> bool:
    """True for a struct of strings: printed without any JSON parsing."""
    if not isinstance(kind, T.StructType):
        return False
    members = {f.name: f.dataType for f in kind.fields}
    used = [v for k, v in members.items() if k in ALLOWED_KEYS]
    return OVERLAY_KEY not in members and all(isinstance(v, T.StringType) for v in used)


def may_be_inexact(schema: T.StructType) -> bool:
    """True if some row of such records may need :func:`exact_fields`."""
    types = {f.name: f.dataType for f in schema.fields}
    metadata, locator = types.get("metadata_compact"), types.get("source_locator")
    parsed = isinstance(metadata, (T.StructType, T.VariantType, T.StringType)) and not _plain_metadata(metadata)
    return parsed or (locator is not None and _holds(locator, _FRACTIONS))


def fields_from_columns(
    df: DataFrame, id_field: str, text_field: str, keep: Iterable[str] = (), place: str | None = None
) -> DataFrame:
    """Field columns of a typed DataFrame; a column of the wrong type is an error in every row.

    ``place`` names a struct of the order columns; ``keep`` names columns that pass through.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    keep = list(keep)
    if place:
        # Only columns in use go on, so that the order columns clash with nothing.
        inputs = list(dict.fromkeys(n for n in (id_field, text_field, *RECORD_COLUMNS) if n in types))
        renamed = {n: f"__in{i}" for i, n in enumerate(inputs)}
        df = df.select(*[F.col(f"`{n}`").alias(renamed[n]) for n in inputs], *[F.col(f"`{place}`")[n].alias(n) for n in ORDER])
        types = {renamed[n]: types[n] for n in inputs}
        id_field, text_field = renamed.get(id_field, id_field), renamed.get(text_field, text_field)
        columns = {n: renamed.get(n, n) for n in RECORD_COLUMNS}
        keep = ORDER
    else:
        columns = {n: n for n in RECORD_COLUMNS}

    def string_column(name: str) -> Column:
        return F.col(f"`{name}`") if isinstance(types.get(name), T.StringType) else F.lit(None).cast("string")

    metadata_name, family_name, locator_name, flag_name = (columns[n] for n in RECORD_COLUMNS)
    family_type = types.get(family_name)
    family = string_column(family_name)
    family_error = F.lit(False)
    if family_type is not None and not isinstance(family_type, (T.StringType, T.NullType)):
        family_error = F.col(family_name).isNotNull()

    flag_type = types.get(flag_name)
    flag, flag_error = F.lit(None).cast("boolean"), F.lit(False)
    if isinstance(flag_type, T.BooleanType):
        flag = F.col(flag_name)
    elif flag_type is not None and not isinstance(flag_type, T.NullType):
        flag_error = F.col(flag_name).isNotNull()

    locator_type = types.get(locator_name)
    locator, locator_error, locator_exact = F.lit(None).cast("string"), F.lit(False), F.lit(False)
    if isinstance(locator_type, T.StringType):
        locator = json_string(F.col(locator_name))
    elif isinstance(locator_type, T.VariantType):
        compact = F.to_json(F.col(locator_name))
        locator, locator_exact = F.when(compact != "null", python_spacing(compact)), has_fraction(compact)
    elif isinstance(locator_type, (T.StructType, T.ArrayType, T.MapType)):
        compact = F.to_json(F.col(locator_name), {"ignoreNullFields": "false"})
        locator, locator_exact = python_spacing(compact), has_fraction(compact)
        if _holds(locator_type, _FLOATING):
            locator_error = F.coalesce(compact.rlike(r'"(NaN|-?Infinity)"'), F.lit(False))
    elif locator_type is not None and not isinstance(locator_type, T.NullType):
        wrapped = F.to_json(F.struct(F.col(locator_name).alias("v")))
        compact = F.regexp_extract(wrapped, r'^\{"v":(.*)\}$', 1)
        locator, locator_exact = F.nullif(compact, F.lit("")), has_fraction(compact)
        if _holds(locator_type, _FLOATING):
            locator_error = F.coalesce(F.isnan(locator_name) | F.abs(locator_name).cast("double").isin(float("inf")), F.lit(False))

    fields = df.select(
        *keep,
        F.lit(None).cast("string").alias("scan_error"),
        string_column(id_field).alias("sample_id"),
        string_column(text_field).alias("text_window"),
        *([F.col(metadata_name).alias("metadata_compact")] if metadata_name in types else []),
        family.alias("source_family"),
        family_error.alias("family_error"),
        locator.alias("source_locator"),
        locator_error.alias("locator_error"),
        F.coalesce(locator_exact, F.lit(False)).alias("locator_exact"),
        flag.alias("raw_windowed"),
        flag_error.alias("flag_error"),
        *([F.col(locator_name).alias("raw_locator")] if locator_type is not None else []),
    )
    fields = _column_metadata(fields, types.get(metadata_name))
    record = [F.col("raw_metadata").alias("metadata_compact")]
    if locator_type is not None:
        record.append(F.col("raw_locator").alias("source_locator"))
    marked = F.col("metadata_inexact") | F.col("locator_exact")
    line = F.to_json(F.struct(*record), {"ignoreNullFields": "false"})
    fields = fields.withColumn("exact_line", F.when(marked, line)).withColumnRenamed("metadata_layers", "exact_layers")
    return fields.select(*keep, *FIELDS)


def _column_metadata(df: DataFrame, kind: T.DataType | None) -> DataFrame:
    """Turn a typed ``metadata_compact`` column into canonical text."""
    if _plain_metadata(kind):
        column = F.col("metadata_compact")
        text = canonical_strings({f.name: column[f.name] for f in kind.fields if f.name in ALLOWED_KEYS})
        return (
            df.withColumn("metadata_compact", F.when(column.isNotNull(), text).otherwise(F.lit("")))
            .withColumn("metadata_inexact", F.lit(False))
            .withColumn("metadata_layers", F.lit(None).cast("string"))
            .withColumn("raw_metadata", F.lit(None).cast("string"))
        )
    if isinstance(kind, T.StructType):
        raw, variant = F.col("metadata_compact"), F.to_variant_object(F.col("metadata_compact"))
    elif isinstance(kind, T.VariantType):
        raw = variant = F.col("metadata_compact")
    elif isinstance(kind, T.StringType):
        raw, variant = F.col("metadata_compact"), strict_json(F.col("metadata_compact"))
        variant = F.when(variant_type(variant) != "STRING", variant)
    else:
        # Lists, maps and scalars are no JSON objects: no metadata.
        return (
            df.withColumn("metadata_compact", F.lit(""))
            .withColumn("metadata_inexact", F.lit(False))
            .withColumn("metadata_layers", F.lit(None).cast("string"))
            .withColumn("raw_metadata", F.lit(None).cast("string"))
        )
    df = df.withColumn("raw_metadata", raw).withColumn("_metadata_value", variant).drop("metadata_compact")
    return with_canonical_metadata(df, "_metadata_value")
