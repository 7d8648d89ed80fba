"""Resampling, vector codes and web archives against plain versions, with awkward rows."""

import base64
import collections
import hashlib
import io
import json
import math
import re
import zipfile
import zlib

import numpy as np
import pytest

from taxaflow.llm import resampling, vector_codes, web_archives

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(text, longest):
    words = WORD.findall((text or "").translate(LOWER))
    return [" ".join(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)], len(words)


def plain_resampling(documents, target, longest, buckets, least, percent):
    def hashed(text):
        return [zlib.crc32(g.encode()) % buckets for g in grams(text, longest)[0]]

    s = collections.Counter(b for _, t in documents for b in hashed(t))
    t = collections.Counter(b for x in target for b in hashed(x))
    ss, tt = sum(s.values()) + buckets, sum(t.values()) + buckets
    rows = []
    for i, text in documents:
        found = hashed(text)
        total = sum(math.floor(1000 * math.log(((t[b] + 1.0) * ss) / ((s[b] + 1.0) * tt))) for b in found)
        weight = total // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((i, grams(text, longest)[1], len(found), weight, score))
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0], r[2], r[1]))
    drawn = len(able) * percent // 100
    return [(*r, k + 1) for k, r in enumerate(able[:drawn])] + [(*r, None) for r in able[drawn:] + [r for r in rows if r[1] < least]]


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(11)
    words = ["Alpha", "beta", "gamma3", "Äther", "日本", "x", "long-word", "b" * 40, "ÉTÉ"]
    rows = [(i, " ".join(rng.choice(words, rng.integers(0, 60)))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, "\x00 .,;\x7f"), (203, "one"), (None, rows[5][1]), (None, None)]
    rows += [(7, rows[7][1])] * 30  # one row that is repeated
    rows += [(300, "very long, " * 4000 + "end"), (301, rows[9][1]), (302, "a" * 9000)]
    return rows


@pytest.mark.parametrize("longest", [1, 2, 3])
def test_resampling(spark, monkeypatch, texts, longest):
    monkeypatch.setattr(resampling, "PIECE", 1000)
    target = ["gamma3 Äther beta", None, "very long", "x x x", ""]
    documents = spark.createDataFrame([(i, t, 1, "c", 0.5) for i, t in texts], "doc_id bigint, text string, rank int, bucket string, score double")
    wanted = spark.createDataFrame([(k, t, 1) for k, t in enumerate(target)], "item_id bigint, text string, n int")
    got = resampling.importance_resample(documents, wanted, longest=longest, buckets=50, least_words=5, percent=30)
    want = plain_resampling(texts, target, longest, 50, 5, 30)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert sorted(r["rank"] for r in got.where("rank is not null").collect()) == list(range(1, sum(r[5] is not None for r in want) + 1))


def test_resampling_reruns_and_empty_tables(spark, texts):
    documents = spark.createDataFrame(texts, "doc_id bigint, text string")
    none = spark.createDataFrame([], "doc_id bigint, text string")
    first = sorted(resampling.resampling_digest(documents, none).collect(), key=repr)
    assert first == sorted(resampling.resampling_digest(documents.repartition(7), none).collect(), key=repr)
    assert resampling.resampling_digest(none, documents).collect() == []
    assert [f"{n} {t}" for n, t in resampling.resampling_digest(none, none).dtypes] == [
        "doc_id bigint", "n_features bigint", "weight bigint", "score bigint", "rank bigint"]


def plain_codes(rows, parts, entries, rounds):
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2] is not None, r[2] or 0))
    width = len(kept[0][1])
    kept = [(i, [math.floor(np.float32(x).item() * 4096) if abs(x) < 1e15 else int(np.float32(x).item()) * 4096 for x in v], label) for i, v, label in kept if len(v) == width]
    step = width // parts
    cut = [[v[p * step:(p + 1) * step] for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(point, book):
        return min((sum((a - b) ** 2 for a, b in zip(point, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            chosen = collections.defaultdict(list)
            for c in cut:
                chosen[nearest(c[p], books[p])[1]].append(c[p])
            for k, mine in chosen.items():
                books[p][k] = [sum(x) // len(mine) for x in zip(*mine)]
    result, totals = [], collections.Counter()
    for (i, _, label), c in zip(kept, cut):
        best = [nearest(c[p], books[p]) for p in range(parts)]
        error = min(2**63 - 1, sum(b[0] for b in best))
        totals[label] += error
        result.append((i, "".join(f"{b[1]:02x}" for b in best), error, label))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(i, code, error, min(2**63 - 1, totals[label]), digest) for i, code, error, label in result]


def vector_rows(spread=1.0):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=16) * spread).astype(np.float32).tolist(), int(rng.integers(0, 4))) for i in range(150)]
    rows += [(i, rows[3][1], 9) for i in range(500, 560)]  # a common vector
    rows += [(600, None, 1), (601, [None] + [0.5] * 15, 1), (602, [float("nan")] * 16, 1), (603, [float("inf")] * 16, 1), (604, [], 1), (605, [0.0] * 8, 1)]
    rows += [(None, rows[4][1], None), (700, [0.0] * 16, None), (20, rows[20][1], rows[20][2]), (701, [0.5] * 16, 77)]
    return rows


@pytest.mark.parametrize("spread", [0.25, 3000.0])
def test_vector_codes(spark, spread):
    rows = vector_rows(spread)
    if spread > 1:
        rows.append((702, [1e20] * 16, 1))
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id bigint, embedding array<float>, label int, code string, n int")
    got = vector_codes.vector_codes(table, parts=4, entries=16, rounds=3)
    if spread > 1:  # beyond what 64 bits hold, components are clipped: only rows and saturation are promised
        found = {r["vec_id"]: r for r in got.collect()}
        assert found[702]["error"] >= 0 and len(found) == len({r[0] for r in rows if r[0] not in range(600, 606)})
        rows = [r for r in rows if r[0] != 702]
        got = vector_codes.vector_codes(table.where("vec_id <> 702 or vec_id is null"), parts=4, entries=16, rounds=3)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(plain_codes(rows, 4, 16, 3), key=repr)


def test_vector_codes_of_few_or_no_rows(spark):
    schema = "vec_id bigint, embedding array<float>, label int"
    assert vector_codes.vector_codes(spark.createDataFrame([], schema)).collect() == []
    assert vector_codes.vector_codes(spark.createDataFrame([(1, [0.5] * 7, 1)], schema)).collect() == []
    few = [(1, [0.25] * 8, None), (2, [0.5] * 8, None)]
    got = vector_codes.vector_codes(spark.createDataFrame(few, schema), parts=2).collect()
    assert sorted((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in got) == [(1, "0000", 0, 0), (2, "0101", 0, 0)]
    with pytest.raises(ValueError):
        vector_codes.vector_codes(spark.createDataFrame(few, schema), entries=300)


@pytest.mark.parametrize("count", [1, 16, 64, 150])
def test_masks_find_the_nearest_entry(count):
    rng = np.random.default_rng(count)
    entries = rng.integers(-40, 40, (count, 5))
    points = np.concatenate([rng.integers(-60, 60, (800, 5)), entries])
    index, error = vector_codes.Codebook(entries.tolist()).nearest(points)
    squares = ((points[:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert (index == squares.argmin(axis=1)).all() and (error == squares.min(axis=1)).all()


def test_masks_leave_out_far_entries():
    book = vector_codes.Codebook([[0, 0], [100, 0], [0, 100], [100, 100]])
    mask = book.candidates(np.array([[1, 1], [50, 50], [99, 2]]), np.array([3, 50, 5]))
    assert mask[:, 0].tolist() == [0b0001, 0b1111, 0b0010]


PAGES = "page_id bigint, url string, html string, payload string, n int, content string"


@pytest.fixture(scope="module")
def page_rows():
    rows = [(i, f"https://host{i % 5}.example.com/a/{i}?q=ü", f"<html>{i}</html>" * (i % 7 + 1)) for i in range(60)]
    rows += [(i, "http://copies.example.org/", "<p>the same</p>") for i in range(100, 140)]
    rows += [(150, None, None), (151, "http://e.example/", ""), (152, "no\r\nurl: x", "<p>äöü日本\r\n\r\nx</p>"), (153, "http://[", "z" * 300_000)]
    rows += [(None, "http://copies.example.org/", "<p>the same</p>"), (None, "u", "only without id"), (100, "http://copies.example.org/", "<p>the same</p>")]
    return rows


def plain_pages(rows, least=0):
    firsts = {}
    for i, _, html in rows:
        if i is not None:
            firsts[html or ""] = min(firsts.get(html or "", i), i)
    want = []
    for i, _, html in rows:
        payload = (html or "").encode()
        first = firsts.get(html or "") if len(payload) >= least else i
        response = first is None or i == first
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        want.append((i, len(payload), digest, "response" if response else "revisit", None if response else first))
    return want


def test_archives_round_trip(spark, page_rows):
    pages = spark.createDataFrame([(*r, "x", 1, "y") for r in page_rows], PAGES)
    got = web_archives.archive_digest(pages)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(plain_pages(page_rows), key=repr)
    assert web_archives.archive_digest(pages.limit(0)).collect() == []


def test_archives_of_small_packages_keep_payloads(spark, page_rows, tmp_path):
    pages = spark.createDataFrame(page_rows, "page_id bigint, url string, html string")
    packages = web_archives.write_packages(pages, str(tmp_path / "out"), least_bytes=16, package_bytes=2000)
    assert packages.count() > 5 and packages.agg({"records": "sum"}).first()[0] == len(page_rows)
    records = web_archives.read_packages(packages).collect()
    want = plain_pages(page_rows, least=16)
    assert sorted((r["record_id"], r["record_type"], r["payload_bytes"]) for r in records) == sorted(
        (f"urn:page:{'none' if w[0] is None else w[0]}", w[3], w[1]) for w in want)
    texts = {r["record_id"]: bytes(r["payload"]).decode() for r in records if r["record_type"] == "response"}
    for (i, _, html), w in zip(page_rows, want):
        if w[3] == "response" and i is not None:
            assert texts[f"urn:page:{i}"] == (html or "")
    assert all(r["payload"] is None for r in records if r["record_type"] == "revisit")
    with zipfile.ZipFile(packages.first()["package"]) as package:  # any ZIP reader can open them
        assert package.testzip() is None and {m.filename for m in package.infolist()} == {web_archives.ARCHIVE, web_archives.INDEX, "datapackage.json"}


def reader(content):
    return lambda begin, length: content[begin:begin + length]


def package_of(members, comment=b"", method=zipfile.ZIP_STORED):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as package:
        for name, content in members:
            package.writestr(name, content)
        package.comment = comment
    return out.getvalue()


@pytest.mark.parametrize("limit", [None, 10])
def test_directories_with_and_without_zip64(monkeypatch, limit):
    if limit:  # sizes and offsets above it go to the ZIP64 fields, and so does the directory's end
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", limit)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    contents = [("archive/a.warc", b"x" * 50), ("small", b"y"), ("empty", b""), ("indexes/ü.cdx", b"z" * 2000)]
    content = package_of(contents, comment=b"a comment with PK\x05\x06 in it and more than 22 bytes behind")
    assert (web_archives.END64 in content) == bool(limit)
    found = web_archives.members(reader(content), len(content))
    assert [(m.name, content[m.begin:m.begin + m.size]) for m in found] == contents


def test_broken_packages_are_refused(tmp_path):
    path = str(tmp_path / "one.wacz")
    writer = web_archives.PackageWriter(path)
    for i in range(5):
        payload = f"text {i} ".encode() * 50
        digest = web_archives.base32_sha1(payload)
        writer.add(f"http://h/{i}", web_archives._record(i, f"http://h/{i}", payload, digest, i, True), digest)
    writer.close()
    content = (tmp_path / "one.wacz").read_bytes()
    (begin, offsets, lengths), = web_archives.record_spans(reader(content), len(content))
    packed = [content[begin + o:begin + o + n] for o, n in zip(offsets, lengths)]
    assert [web_archives.parse_record(p)["record_id"] for p in packed] == [f"urn:page:{i}" for i in range(5)]
    record = zlib.decompress(packed[2], 31)
    with pytest.raises(ValueError, match="digest"):
        web_archives.parse_record(record.replace(b"text 2", b"text 3", 1))
    with pytest.raises(ValueError, match="No WARC record"):
        web_archives.parse_record(b"other")
    with pytest.raises(ValueError, match="directory"):
        web_archives.members(reader(content[:-30]), len(content) - 30)
    squeezed = package_of([("archive/a.warc", b"x" * 500), ("indexes/i.cdx", b"")], method=zipfile.ZIP_DEFLATED)
    with pytest.raises(ValueError, match="stored"):
        list(web_archives.record_spans(reader(squeezed), len(squeezed)))
    with pytest.raises(ValueError, match="index"):
        list(web_archives.record_spans(reader(package_of([("archive/a.warc", b"x")])), len(package_of([("archive/a.warc", b"x")]))))


def test_index_of_many_lines_is_read_in_blocks(monkeypatch):
    monkeypatch.setattr(web_archives, "SPAN_BYTES", 64)
    lines = [json.dumps({"filename": "archive/a.warc", "offset": str(7 * i), "length": "7"}) for i in range(40)]
    body = "".join(f"key{i} 2000 {x}\n" for i, x in enumerate(lines)).encode().rstrip(b"\n")
    content = package_of([("archive/a.warc", b"1234567" * 40), ("indexes/i.cdxj", body)])
    spans = list(web_archives.record_spans(reader(content), len(content)))
    assert len(spans) > 3 and sum(len(s[1]) for s in spans) == 40
    assert all(content[b + o:b + o + n] == b"1234567" for b, offsets, lengths in spans for o, n in zip(offsets, lengths))
