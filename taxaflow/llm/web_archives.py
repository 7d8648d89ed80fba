"""Web archives: WARC records of pages in ZIP packages, and a reader that takes single records out of them.

A package is a ZIP file whose members are stored as they are: ``archive/data.warc.gz`` (one gzip member per
record), ``indexes/index.cdxj`` (one line per record: where it lies in the archive member) and
``datapackage.json``.  The reader never unpacks a package.  It reads the end of the file, follows the end-of-central-directory
record and its ZIP64 form to the central directory, finds where the stored members begin, reads the index, and
then fetches ranges of the archive member, each holding some records, in tasks of their own.

Packages are written by tasks into the folder all executors share, under a name of their own for every attempt;
only those a finished task reports are read, so what a lost executor leaves behind does no harm.

Defined results: NULL html is an empty payload; NULL url writes no WARC-Target-URI.  All rows of a payload's
smallest page_id are responses, also if that row is repeated.  Rows without page_id revisit the smallest page_id of
their payload; if it has none, they are responses.  An empty table gives an empty result and no package.  Only
page_id, url and html are read, so no other column can clash.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaflow.llm.common import stored, with_group_value
from taxaflow.session import shared_dir

# Marks and sizes of the ZIP format, names of WARC fields.
END, END64, LOCATOR64, ENTRY, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
END_BYTES, LOCATOR64_BYTES, ENTRY_BYTES, LOCAL_BYTES = 22, 20, 46, 30
UNKNOWN32, UNKNOWN16, ZIP64_FIELD = 0xFFFFFFFF, 0xFFFF, 1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PACKAGE_BYTES = 256 << 20
SPAN_BYTES = 4 << 20  # archive bytes fetched by one read
DATE = "2000-01-01T00:00:00Z"  # pages carry no time; a fixed one keeps reruns equal
PAGE_URN = "urn:page:"

PACKAGES = "package string, bytes bigint, records bigint"
SPANS = "package string, begin bigint, offsets array<bigint>, lengths array<bigint>"
RECORDS = (
    "package string, position bigint, record_type string, record_id string, refers_to string, target_uri string, "
    "payload_digest string, payload_bytes bigint, payload binary"
)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or not path.startswith("file:") else "file://" + path[len("file:"):])


# ---------------------------------------------------------------- writing


def _record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, is_first: bool) -> bytes:
    """One WARC record.  A revisit keeps the HTTP header, with the length of the payload it leaves out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if is_first else http
    fields = [
        ("WARC-Type", "response" if is_first else "revisit"),
        ("WARC-Record-ID", f"<{PAGE_URN}{'none' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        *([("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~"))] if url else []),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
        *([] if is_first else [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{PAGE_URN}{refers_to}>")]),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def _sort_key(url: str | None) -> str:
    """Host labels from the right, then the path: the order of index lines."""
    try:
        parts = urlsplit(url or "")
        host = parts.hostname or ""
    except ValueError:
        return quote(url or "", safe="/:")
    return quote(",".join(reversed(host.split("."))) + ")" + parts.path, safe="/:,)")


class PackageWriter:
    """One package file: records first, then the index, written as a stream."""

    def __init__(self, path: str):
        self.path = path
        system, where = _open(path)
        self.out = system.open_output_stream(where)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(ARCHIVE, "w", force_zip64=True)
        self.offset, self.lines = 0, []

    def add(self, url: str | None, record: bytes, digest: str) -> None:
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        packed = packer.compress(record) + packer.flush()
        self.member.write(packed)
        place = {"url": url, "digest": f"sha1:{digest}", "filename": ARCHIVE, "offset": str(self.offset), "length": str(len(packed))}
        self.lines.append(f"{_sort_key(url)} {DATE[:4]}0101000000 {json.dumps(place)}\n")
        self.offset += len(packed)

    def close(self) -> tuple[str, int, int]:
        self.member.close()
        with self.zip.open(INDEX, "w", force_zip64=True) as index:
            for line in sorted(self.lines):
                index.write(line.encode())
        listed = {"profile": "data-package", "resources": [{"path": ARCHIVE, "bytes": self.offset}, {"path": INDEX}]}
        self.zip.writestr("datapackage.json", json.dumps(listed))
        self.zip.close()
        size = self.out.tell()
        self.out.close()
        return self.path, size, len(self.lines)


def with_record_types(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, first_id``: first_id is the page a row revisits, its own if it is a response."""
    own = pages.select("page_id", "url", F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8").alias("payload"))
    own = own.withColumn("content", F.sha2("payload", 256))
    large = own.where(F.octet_length("payload") >= least_bytes)
    firsts = large.groupBy("content").agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first_id"))
    # Payloads that occur once have nothing to look up; only the others' digests are joined.
    shared = firsts.where("n > 1")
    found = with_group_value(own, shared, "content", "first_id").drop("content")
    return found.withColumn("first_id", F.coalesce(F.when(F.octet_length("payload") >= least_bytes, F.col("first_id")), F.col("page_id")))


def write_packages(pages: DataFrame, folder: str, *, least_bytes: int = 0, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Write every page as a WARC record into packages below ``folder``; returns ``package, bytes, records``."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer: PackageWriter | None = None
        done: list[tuple[str, int, int]] = []
        for batch in batches:
            page_ids, urls, payloads, firsts = batch.columns
            for i in range(batch.num_rows):
                page_id, url, payload, first = (c[i].as_py() for c in (page_ids, urls, payloads, firsts))
                digest = base32_sha1(payload)
                record = _record(page_id, url, payload, digest, first, page_id == first)
                writer = writer or PackageWriter(f"{folder}/{uuid.uuid4().hex}.wacz")
                writer.add(url, record, digest)
                if writer.offset >= package_bytes:
                    done.append(writer.close())
                    writer = None
        if writer:
            done.append(writer.close())
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[0] for d in done], pa.string()), *(pa.array([d[k] for d in done], pa.int64()) for k in (1, 2))], ["package", "bytes", "records"]
        )

    system, where = _open(folder)
    system.create_dir(where)
    typed = with_record_types(pages, least_bytes).select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), "payload", F.col("first_id").cast("bigint"))
    return stored(typed.mapInArrow(write, PACKAGES), "packages")


# ---------------------------------------------------------------- reading


@dataclass
class Member:
    """A file inside a package; ``begin`` is where its bytes start if they are stored as they are."""

    name: str
    method: int
    size: int
    begin: int


def _end_of_directory(read: Callable[[int, int], bytes], size: int) -> tuple[int, int, int]:
    """Entries, bytes and place of the central directory; a comment may follow the record that says so."""
    tail_bytes = min(size, END_BYTES + UNKNOWN16 + LOCATOR64_BYTES)
    tail = read(size - tail_bytes, tail_bytes)
    at = tail.rfind(END)
    while at >= 0 and at + END_BYTES + int.from_bytes(tail[at + 20:at + 22], "little") != len(tail):
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise ValueError("No end of a ZIP directory")
    entries, length, place = struct.unpack("<HII", tail[at + 10:at + 20])
    if tail[at - LOCATOR64_BYTES:at][:4] == LOCATOR64 and at >= LOCATOR64_BYTES:
        end64 = struct.unpack("<Q", tail[at - LOCATOR64_BYTES + 8:at - LOCATOR64_BYTES + 16])[0]
        record = read(end64, 56)
        if record[:4] != END64:
            raise ValueError("No ZIP64 directory where its locator points")
        entries, length, place = struct.unpack("<QQQ", record[32:56])
    return entries, length, place


def members(read: Callable[[int, int], bytes], size: int) -> list[Member]:
    """Members of a package, from its central directory; ``read(begin, length)`` gives bytes of the file."""
    entries, length, place = _end_of_directory(read, size)
    directory, at, found = read(place, length), 0, []
    for _ in range(entries):
        if directory[at:at + 4] != ENTRY:
            raise ValueError("Broken ZIP directory")
        method, packed, plain = struct.unpack("<H8xII", directory[at + 10:at + 28])
        name_bytes, extra_bytes, comment_bytes = struct.unpack("<HHH", directory[at + 28:at + 34])
        header = struct.unpack("<I", directory[at + 42:at + 46])[0]
        name = directory[at + ENTRY_BYTES:at + ENTRY_BYTES + name_bytes].decode("utf-8", "replace")
        extra = directory[at + ENTRY_BYTES + name_bytes:at + ENTRY_BYTES + name_bytes + extra_bytes]
        large = iter(_zip64_values(extra))
        # The ZIP64 field holds only the values that didn't fit, in this order.
        plain, packed, header = (next(large) if v == UNKNOWN32 else v for v in (plain, packed, header))
        found.append((name, method, packed, header))
        at += ENTRY_BYTES + name_bytes + extra_bytes + comment_bytes
    return [Member(name, method, packed, _begin(read, header)) for name, method, packed, header in found]


def _zip64_values(extra: bytes) -> list[int]:
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack("<HH", extra[at:at + 4])
        if kind == ZIP64_FIELD:
            return list(struct.unpack(f"<{length // 8}Q", extra[at + 4:at + 4 + length // 8 * 8]))
        at += 4 + length
    return []


def _begin(read: Callable[[int, int], bytes], header: int) -> int:
    """Where a member's bytes start: its local header may be longer than its directory entry says."""
    local = read(header, LOCAL_BYTES)
    if local[:4] != LOCAL:
        raise ValueError("No member where the ZIP directory points")
    name_bytes, extra_bytes = struct.unpack("<HH", local[26:30])
    return header + LOCAL_BYTES + name_bytes + extra_bytes


def _index_places(read: Callable[[int, int], bytes], index: Member) -> Iterator[tuple[str, int, int]]:
    """Member name, offset and length of every indexed record; the index is read in blocks."""
    rest, at = b"", 0
    unpack = zlib.decompressobj(31) if index.name.endswith(".gz") else None
    while at < index.size:
        block = read(index.begin + at, min(SPAN_BYTES, index.size - at))
        at += len(block)
        *lines, rest = (rest + (unpack.decompress(block) if unpack else block)).split(b"\n")
        if at >= index.size:
            lines.append(rest)
        for line in lines:
            if b"{" in line:
                place = json.loads(line[line.index(b"{"):])
                yield place["filename"].rsplit("/", 1)[-1], int(place["offset"]), int(place["length"])


def record_spans(read: Callable[[int, int], bytes], size: int) -> Iterator[tuple[int, list[int], list[int]]]:
    """Where the records of a package lie: first byte in the file, then offsets from there and lengths."""
    inside = members(read, size)
    archives = {m.name.rsplit("/", 1)[-1]: m for m in inside if m.name.startswith("archive/")}
    indexes = [m for m in inside if m.name.startswith("indexes/") and m.name.endswith((".cdx", ".cdxj", ".cdx.gz", ".cdxj.gz"))]
    if any(m.method for m in [*archives.values(), *indexes]):
        raise ValueError("Only stored members can be read by range")
    if archives and not indexes:
        raise ValueError("A package without an index")
    places = sorted({(archives[name].begin + offset, length) for index in indexes for name, offset, length in _index_places(read, index)})
    begin, offsets, lengths = 0, [], []
    for place, length in places:
        if offsets and place + length - begin > SPAN_BYTES:
            yield begin, offsets, lengths
            offsets, lengths = [], []
        if not offsets:
            begin = place
        offsets.append(place - begin)
        lengths.append(length)
    if offsets:
        yield begin, offsets, lengths


def _headers(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").split("\r\n")[1:]
    return {name.strip().lower(): value.strip() for name, _, value in (x.partition(":") for x in lines)}


def parse_record(packed: bytes) -> dict:
    """Fields of one record; digests of what it holds are checked."""
    record = zlib.decompress(packed, 31) if packed[:2] == b"\x1f\x8b" else packed
    head, _, rest = record.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/"):
        raise ValueError("No WARC record where the index points")
    fields = _headers(head)
    block = rest[:int(fields["content-length"])]
    if "warc-block-digest" in fields and fields["warc-block-digest"] != f"sha1:{base32_sha1(block)}":
        raise ValueError(f"Record {fields.get('warc-record-id')} differs from its block digest")
    kind, payload, length = fields["warc-type"], block, len(block)
    if fields.get("content-type", "").startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
        length = int(_headers(http).get("content-length", len(payload)))
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if kind == "response" and digest is not None and (digest != base32_sha1(payload) or length != len(payload)):
        raise ValueError(f"Record {fields.get('warc-record-id')} differs from its payload digest")
    return dict(
        record_type=kind, record_id=fields.get("warc-record-id", "").strip("<>"), refers_to=fields.get("warc-refers-to", "").strip("<>") or None,
        target_uri=fields.get("warc-target-uri"), payload_digest=digest, payload_bytes=length, payload=payload if kind != "revisit" else None,
    )


def read_packages(packages: DataFrame, *, with_payload: bool = True) -> DataFrame:
    """Records of all packages (columns ``package, bytes``), fetched by range; a revisit has no payload of its own."""
    def reader(path: str) -> Callable[[int, int], bytes]:
        system, where = _open(path)
        handle = system.open_input_file(where)
        return lambda begin, length: handle.read_at(length, begin)

    def list_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                spans = list(record_spans(reader(path), size))
                columns = [[path] * len(spans), *([s[k] for s in spans] for k in range(3))]
                kinds = [pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["package", "begin", "offsets", "lengths"])

    names = [c.split()[0] for c in RECORDS.split(", ")]
    kinds = [pa.binary() if c.endswith("binary") else pa.int64() if c.endswith("bigint") else pa.string() for c in RECORDS.split(", ")]

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, read = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["package"] != path:
                    path, read = row["package"], reader(row["package"])
                span = read(row["begin"], row["offsets"][-1] + row["lengths"][-1])
                found = []
                for offset, length in zip(row["offsets"], row["lengths"]):
                    record = parse_record(span[offset:offset + length])
                    record["payload"] = record["payload"] if with_payload else None
                    found.append({"package": path, "position": row["begin"] + offset, **record})
                yield pa.RecordBatch.from_arrays([pa.array([f[n] for f in found], k) for n, k in zip(names, kinds)], names)

    spark = packages.sparkSession
    listed = stored(packages.select("package", "bytes").repartition(_tasks(spark, packages), "package").mapInArrow(list_spans, SPANS), "spans")
    spans = max(listed.count(), 1)
    return listed.repartition(min(spans, max(spark.sparkContext.defaultParallelism, spans // 16)), "package", "begin").mapInArrow(fetch, RECORDS)


def _tasks(spark: SparkSession, packages: DataFrame) -> int:
    return max(1, min(packages.count(), 100_000))


def archive_digest(pages: DataFrame) -> DataFrame:
    """Write all pages and read them back: ``page_id, payload_bytes, payload_digest, record_type, refers_to``."""
    packages = write_packages(pages, shared_dir(pages.sparkSession, "archives"))
    records = read_packages(packages, with_payload=False)

    def page(urn: str):
        return F.expr(f"try_cast(substring({urn}, {len(PAGE_URN) + 1}) AS bigint)")

    return records.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"))
