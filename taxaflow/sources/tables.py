"""Parquet inputs whose files differ: every file is read with its own column types, and only the columns in use.

Footers are read in tasks.  Files whose used columns agree are scanned together, each group once; a column that
nobody reads may have any type, and a file may lack columns.  What the scan adds itself (file, offset, row number)
travels in one struct, so no column of the input can clash with it.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxaflow.errors import InvalidInput
from taxaflow.sources.remote import can_open, open_file

PLACE = "__place"
SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"
FOOTERS_PER_TASK = 64
DRIVER_READERS = 16


def _types_in(path: str, used: list[str]) -> str | None:
    """Spark types of the used columns of one file, as schema JSON; None if its footer can't be read here."""
    from pyspark.sql.pandas.types import from_arrow_type

    try:
        with open_file(path) as handle:
            schema = pq.read_schema(handle)
    except (OSError, pa.ArrowException, ValueError):
        return None
    written = (schema.metadata or {}).get(SPARK_SCHEMA)
    if written:
        fields = {f.name: f for f in T.StructType.fromJson(json.loads(written)).fields}
    else:
        fields = {}
        for field in schema:
            if field.name in used:
                try:
                    kind = T.NullType() if pa.types.is_null(field.type) else from_arrow_type(field.type)
                except Exception:  # a type only Spark's reader may know how to map
                    return None
                fields[field.name] = T.StructField(field.name, kind)
    return T.StructType([T.StructField(n, fields[n].dataType) for n in used if n in fields]).json()


def _by_spark(spark: SparkSession, path: str, used: list[str]) -> str:
    found = {f.name: f for f in spark.read.parquet(path).schema.fields}
    return T.StructType([T.StructField(n, found[n].dataType) for n in used if n in found]).json()


def file_types(spark: SparkSession, files: list[str], used: list[str]) -> dict[str, list[int]]:
    """Schema JSON of the used columns -> numbers of the files that have it."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = [_types_in(path, used) for path in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kinds, pa.string())], ["i", "kind"])

    here = [(i, path) for i, path in enumerate(files) if can_open(path)]
    groups: dict[str | None, list[int]] = {}
    if here:
        listed = spark.createDataFrame(here, "i int, path string").repartition(-(-len(here) // FOOTERS_PER_TASK))
        found = listed.mapInArrow(read, "i int, kind string").groupBy("kind").agg(F.sort_array(F.collect_list("i")).alias("files"))
        groups = {r["kind"]: r["files"] for r in found.collect()}
    left = groups.pop(None, []) + [i for i, path in enumerate(files) if not can_open(path)]
    with ThreadPoolExecutor(DRIVER_READERS) as pool:
        for i, kind in zip(left, pool.map(lambda i: _by_spark(spark, files[i], used), left)):
            groups.setdefault(kind, []).append(i)
    return groups


def reconciled(kinds: dict[str, list[int]]) -> list[tuple[T.StructType, list[int]]]:
    """Files that can be scanned together: no column has two types among them.  Large groups come first."""
    scans: list[tuple[dict[str, T.DataType], list[int]]] = []
    for kind, files in sorted(kinds.items(), key=lambda k: (-len(k[1]), k[0])):
        mine = {f.name: f.dataType for f in T.StructType.fromJson(json.loads(kind)).fields}
        for types, members in scans:
            if all(types.get(name, dtype) == dtype for name, dtype in mine.items()):
                types.update(mine)
                members.extend(files)
                break
        else:
            scans.append((mine, list(files)))
    # A type that holds nothing but NULL (as pandas writes an empty column) is no type to read with: its files have a scan without the column.
    return [
        (T.StructType([T.StructField(n, d) for n, d in types.items() if not isinstance(d, T.NullType)]), sorted(members))
        for types, members in scans
    ]


def _placed(scan: DataFrame, used: list[str]) -> DataFrame:
    hidden = scan.metadataColumn("_metadata")
    place = F.struct(
        hidden["file_path"].alias("file_path"), F.lit(0).cast("bigint").alias("block_start"), hidden["row_index"].alias("seq")
    )
    return scan.select(*[scan[f"`{n}`"] for n in scan.columns if n in used], place.alias(PLACE))


def scan_tables(spark: SparkSession, paths: list[str], used: list[str]) -> list[DataFrame]:
    """One frame for each group of files: the used columns it has, and the struct :data:`PLACE`."""
    if PLACE in used:
        raise InvalidInput(f"No column may be called {PLACE}")
    used = list(dict.fromkeys(used))
    # No column is read here; Spark lists the files as it would for a scan and looks into none of them.
    listing = spark.read.schema(T.StructType([T.StructField(used[0], T.StringType())])).parquet(*paths)
    files = [unquote(f) for f in listing.inputFiles()]  # Spark shows them encoded, and takes them plain
    if not files:
        return [_placed(listing.limit(0), used)]
    scans = reconciled(file_types(spark, files, used))
    frames = []
    for types, members in scans:
        whole = len(scans) == 1
        reader = spark.read.schema(types if types.fields else T.StructType([T.StructField(used[0], T.StringType())]))
        if not whole and len(paths) == 1 and not any(c in paths[0] for c in "*?[{") and files != paths:
            reader = reader.option("basePath", paths[0])
        frames.append(_placed(reader.parquet(*(paths if whole else [files[i] for i in members])), used))
    return frames
