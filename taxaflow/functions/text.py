"""Text predicates, model input and token windows as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from taxaflow.functions.json_text import strict_json, variant_type

# They decide what the model sees and must stay as they are.
VISIBLE_TOKENS = 768
INPUT_SCOPE = "supplied_window_prefix_768"
METADATA_CHARS = 1200
METADATA_MARK = "[DOCUMENT METADATA]\n"
DOCUMENT_MARK = "\n\n[DOCUMENT]\n"

# Everything Python's str.strip() does not remove, U+001C..U+001F included.
NONBLANK = r"[^\s\x1c-\x1f\x85\p{Z}]"

# Words are separated by ASCII white space.
SPACES = " \t\n\r\f\x0b"


def is_nonblank(text: Column) -> Column:
    return text.rlike(NONBLANK)


def document_text(text: Column, metadata: Column) -> Column:
    """Model input: cleaned metadata and body, and nothing else of the record."""
    return F.concat(F.lit(METADATA_MARK), F.coalesce(metadata, F.lit("")), F.lit(DOCUMENT_MARK), text)


def reread_metadata(stored: Column) -> Column:
    """Clean stored metadata a second time.

    Canonical text comes back unchanged.  Text that was clipped is no longer
    JSON, and the document then goes to the model without metadata.
    """
    clipped = F.length(stored) >= METADATA_CHARS
    whole = F.coalesce(variant_type(strict_json(stored)).startswith("OBJECT"), F.lit(False))
    return F.when(clipped & ~whole, F.lit("")).otherwise(F.coalesce(stored, F.lit("")))


def words(text: Column) -> Column:
    # Only the ends can give empty pieces.  Trimming a text first takes several integers for each of its bytes.
    return F.array_remove(F.split(text, f"[{SPACES}]+"), "")


def hashed_token_ids(tokens: Column, limit: int = VISIBLE_TOKENS) -> Column:
    """CRC-32 of the first tokens of a document, as token IDs.

    Hashing needs no vocabulary table, hence no join and no shuffle over the
    tokens of the corpus.
    """
    return F.transform(F.slice(tokens, 1, limit), lambda t: F.crc32(t))


def token_ids_sha256(ids: Column) -> Column:
    """SHA-256 of the ID list as compact JSON."""
    return F.sha2(F.concat(F.lit("["), F.array_join(ids.cast("array<string>"), ","), F.lit("]")), 256)
