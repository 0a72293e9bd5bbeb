"""ZIP-packaged archives: exact round trips, ZIP64, ranges and damage."""

import hashlib
import io
import random
import zipfile

import pytest

from hearth.llm import warc
from tests.conftest import SF_SMALL


def plain(rows):
    """[(page_id, html)] -> sorted contract rows."""
    body = [(h or "").encode() for _, h in rows]
    out = []
    for (p, _), b in zip(rows, body):
        same = [q for (q, _), c in zip(rows, body) if c == b and q is not None]
        top = max(same, default=None)
        again = len(b) >= 1000 and top is not None and p != top and body.count(b) > 1
        out.append((p, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", top if again else None))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


def edge_rows():
    big, rnd = "é" * 600, random.Random(1)
    rows = [(1, None), (2, ""), (3, "x" * 999), (4, "x" * 999), (5, "y" * 1000), (9, "y" * 1000), (7, "y" * 1000), (None, "y" * 1000), (10, big), (11, big),
            (12, "solo" * 500), (13, "r" * 2000), (13, "r" * 2000), (None, "n" * 3000), (None, "n" * 3000), (14, "\r\n\r\nWARC/1.1\x00" * 200),
            (15, "".join(rnd.choice("abcdefghij") for _ in range(3_000_000)))]
    return rows + [(100 + i, "copy " * 300) for i in range(200)]


SCHEMA = "page_id long, url string, html string, refers_to string"


def test_edges(spark):
    rows = edge_rows()
    df = spark.createDataFrame([(p, f"http://x/{p}?é\r\nq" if i % 2 else None, h, "clash") for i, (p, h) in enumerate(rows)], SCHEMA).repartition(3)
    assert got(warc.round_trip(df, archive_bytes=20_000)) == plain(rows)
    assert warc.round_trip(df.limit(0)).count() == 0


def test_payloads_come_back(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    rows = [(r.page_id, r.html) for r in pages.collect()]
    archives = warc.write_archives(warc.plan_records(pages), 30_000)
    back = warc.read_archives(archives, payload=True).collect()
    assert got(warc.round_trip(pages)) == plain(rows)
    assert {r.page_id: bytes(r.payload).decode() for r in back if r.record_type == "response"} == {p: h for p, h in rows if ("response" in [x[3] for x in plain(rows) if x[0] == p])}


def test_files(spark, scratch):
    data = warc.gzip.compress(warc.record(5, "http://a/", "<p>hi", 5, hashlib.sha1(b"<p>hi").hexdigest(), None))
    with open(f"{scratch}/a.wacz", "wb") as f:
        f.write(warc.package(data, [{"id": 5, "offset": 0, "length": len(data)}]))
    r = warc.read_files(spark, scratch, payload=True).first()
    assert (r.page_id, r.url, bytes(r.payload)) == (5, "http://a/", b"<p>hi")


def archive(n=50, index=True, comment=b"", method=zipfile.ZIP_STORED):
    data, places = b"", []
    for i in range(n):
        t = f"page {i} " * (i + 1)
        z = warc.gzip.compress(warc.record(i, None, t, len(t), hashlib.sha1(t.encode()).hexdigest(), None))
        places.append({"id": i, "offset": len(data), "length": len(z)})
        data += z
    raw = warc.package(data, places)
    out = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(raw)) as a, zipfile.ZipFile(out, "w", method) as b:
        for m in a.namelist():
            if index or m != warc.INDEX:
                b.writestr(m, a.read(m))
        b.comment = comment
    return out.getvalue()


def pages_of(raw, log=None):
    def read_at(at, n):
        if log is not None:
            log.append(n)
        return raw[at:at + n]
    return [warc.parse(warc.gzip.decompress(read_at(at, n))).page_id for at, n in warc.places(read_at, len(raw))]


@pytest.mark.parametrize("how", [{}, {"index": False}, {"comment": b"PK\x05\x06 not the end" * 9}])
def test_plain_archives(how):
    assert pages_of(archive(**how)) == list(range(50))


@pytest.mark.parametrize("index", [True, False])
def test_zip64(monkeypatch, index):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 100)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    raw = archive(index=index)
    assert b"PK\x06\x06" in raw and b"PK\x06\x07" in raw
    assert pages_of(raw) == list(range(50))


def test_only_ranges_are_read():
    raw, log = archive(400), []

    def read_at(at, n):
        log.append((at, n))
        return raw[at:at + n]
    at, n = list(warc.places(read_at, len(raw)))[7]
    start = len(log)
    assert warc.parse(warc.gzip.decompress(read_at(at, n))).page_id == 7
    assert log[start:] == [(at, n)] and n < 300


def foreign():
    """Records as other writers make them: other types, UUID ids, chunks, no digest."""
    def rec(kind, i, block, *more):
        head = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{i}>", *more, f"Content-Length: {len(block)}"]
        return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    chunks = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n3\r\nabc\r\n2\r\nde\r\n0\r\n\r\n"
    digest = f"WARC-Payload-Digest: sha1:{hashlib.sha1(b'abcde').hexdigest()}"
    http = "content-type: application/http; msgtype=response"
    return [rec("warcinfo", "a", b"software: x\r\n", "Content-Type: application/warc-fields"),
            rec("request", "b", b"GET / HTTP/1.1\r\nHost: x\r\n\r\n", "Content-Type: application/http; msgtype=request"),
            rec("response", "c", chunks, http, digest), rec("response", "d", b"HTTP/1.1 200 OK\r\n\r\n" + b"z" * 9000, http),
            rec("revisit", "e", b"HTTP/1.1 200 OK\r\n\r\n", http, "WARC-Refers-To: <urn:uuid:c>"), rec("metadata", "f", b"via: x")]


@pytest.mark.parametrize("name", ["archive/a.warc", "archive/a.warc.gz"])
@pytest.mark.parametrize("index", ["none", "cdxj", "placeless"])
def test_archives_of_other_writers(spark, scratch, name, index):
    parts = [warc.gzip.compress(r) if name.endswith(".gz") else r for r in foreign()]
    lines = ['!meta {"format": "x"}']
    for i, x in enumerate(parts):
        more = f', "offset": "{sum(map(len, parts[:i]))}", "length": "{len(x)}", "filename": "a"' if index == "cdxj" else ""
        lines.append('com,x)/ 20200101000000 {"url": "http://x/"' + more + "}")
    with zipfile.ZipFile(f"{scratch}/a.wacz", "w") as z:
        z.writestr(name, b"".join(parts))
        if index != "none":
            z.writestr("indexes/index.cdxj", "\n".join(lines) + "\n")
    rows = warc.read_files(spark, scratch, payload=True).collect()
    assert [(r.record_type, r.record_id[-2], r.page_id) for r in rows] == [
        (k, i, None) for k, i in zip(("warcinfo", "request", "response", "response", "revisit", "metadata"), "abcdef")]
    assert rows[4].refers_to_id == "<urn:uuid:c>" and rows[4].payload is None and bytes(rows[3].payload) == b"z" * 9000
    assert bytes(rows[5].payload) == b"via: x" and rows[2].payload_digest == hashlib.sha1(b"abcde").hexdigest()


def test_files_above_four_gigabytes(spark, scratch):
    """Only places are read: the archive stands behind 4.5 GB of nothing, so its offsets are in ZIP64 fields."""
    for name, index in (("a", True), ("b", False)):
        with open(f"{scratch}/{name}.wacz", "wb") as f:
            f.truncate(4500 << 20)
        raw = archive(60, index)
        with zipfile.ZipFile(io.BytesIO(raw)) as a, zipfile.ZipFile(f"{scratch}/{name}.wacz", "a") as b:
            for m in a.namelist():
                b.writestr(m, a.read(m))
    rows = warc.read_files(spark, scratch, payload=True, block=2000).collect()
    assert sorted((r.page_id, bytes(r.payload)) for r in rows) == sorted(2 * [(i, f"page {i} ".encode() * (i + 1)) for i in range(60)])
    assert warc.read_files(spark, scratch, block=2000).count() == 120


def test_files_are_listed_without_contents_and_read_by_blocks(spark, scratch):
    for i in range(3):
        with open(f"{scratch}/{i} %41é.wacz", "wb") as f:
            f.write(archive(40))
    df = warc.read_files(spark, scratch, block=1000)
    assert sorted(r.page_id for r in df.collect()) == sorted(3 * list(range(40)))
    assert "content" not in df._jdf.queryExecution().executedPlan().toString()


def test_damaged_records():
    good = warc.record(1, None, "abc", 3, hashlib.sha1(b"abc").hexdigest(), None)
    for old, new in ((b"WARC-Type: response\r\n", b""), (b"Payload-Digest: sha1:", b"Payload-Digest: sha1:1!"), (b"response\r\nContent-Length: ", b"response\r\nContent-Length: x")):
        assert old in good
        with pytest.raises(ValueError):
            warc.parse(good.replace(old, new))


def test_damage():
    with pytest.raises(ValueError):
        pages_of(b"not a zip file")
    with pytest.raises(ValueError):
        pages_of(archive(method=zipfile.ZIP_DEFLATED))
    good = warc.record(1, None, "abc", 3, hashlib.sha1(b"abc").hexdigest(), None)
    assert warc.parse(good).payload == b"abc"
    with pytest.raises(ValueError):
        warc.parse(good.replace(b"\r\n\r\nabc", b"\r\n\r\nabd"))
