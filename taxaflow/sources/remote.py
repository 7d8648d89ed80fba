"""Files seen from tasks: ranged reads through pyarrow, for stores it can open.

Spark's own readers reach any store.  What they don't offer (a footer alone, a file in blocks) is read here; callers
fall back to Spark's readers for a store that can't be opened this way.
"""

from __future__ import annotations

import posixpath

from pyarrow import fs

# Hadoop's names of stores that pyarrow knows under another one.
SCHEMES = {"s3a": "s3", "s3n": "s3", "gcs": "gs", "wasbs": "abfss"}
OPENED = {"file", "s3", "gs", "gcs", "hdfs", "abfs", "abfss"}


def _uri(path: str) -> str:
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return path
    if scheme == "file":
        return "file://" + posixpath.normpath("/" + rest.lstrip("/"))
    return f"{SCHEMES.get(scheme, scheme)}:{rest}"


def can_open(path: str) -> bool:
    """Whether a path belongs to a store that tasks may open; says nothing about rights."""
    scheme, colon, _ = _uri(path).partition(":")
    return not colon or "/" in scheme or scheme in OPENED


def _system(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path; ``file:`` paths hold percent signs as they are."""
    uri = _uri(path)
    if uri.startswith("file://"):
        return fs.LocalFileSystem(), uri[len("file://"):]
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def open_file(path: str):
    """A file of any supported store, for ranged reads."""
    system, where = _system(path)
    return system.open_input_file(where)


def create_file(path: str):
    """A stream into a new file, as the bytes are whatever its suffix; a file of that name is replaced."""
    system, where = _system(path)
    return system.open_output_stream(where, compression=None)
