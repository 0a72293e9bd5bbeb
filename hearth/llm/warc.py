"""Web archives packaged as ZIP files, written and read by range (operator 6).

An archive is a ZIP file with stored members: ``archive/data.warc.gz`` (WARC records, each
a gzip member of its own), ``indexes/index.cdxj`` (one line per record with its place) and
``datapackage.json``.  Reading starts at the end of the file: the end record, where it
is there the ZIP64 one, the central directory, the index, and then only the
bytes of the records asked for.  Nothing is unpacked as a whole.

Spark holds archives as rows ``(archive, content)`` of a table, or lists archive files
and reads ranges of them where they lie.  Of equal payloads one record is the response; the others
revisit it and carry no payload.
"""

from __future__ import annotations

import base64
import binascii
import gzip
import io
import json
import re
import struct
import zipfile
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import sha1
from itertools import islice
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.llm.common import cut, text_or_empty
from hearth.session import ship_package

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: Payloads of fewer bytes are never revisited; an archive is closed at this many bytes of records.
LEAST_BYTES, ARCHIVE_BYTES = 1000, 4 << 20
DATE = "1970-01-01T00:00:00Z"


# --- writing -----------------------------------------------------------------------------------

def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                 least: int = LEAST_BYTES) -> DataFrame:
    """``(page_id, url, html, payload_bytes, payload_digest, record_type, refers_to)``, native.

    Payload and digest are of the UTF-8 bytes; null reads as empty.  Among payloads of
    ``least`` bytes or more with one digest, those with the largest page id are the response
    (all of them, if rows repeat that id) and the rest revisit it, without their html; a null id
    is the smallest, and null ids alone are all responses.
    """
    p = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), text_or_empty(html_col).alias("html"))
    p = p.select("*", F.octet_length("html").cast("long").alias("payload_bytes"), F.sha1(F.encode("html", "UTF-8")).alias("payload_digest"))
    # slim and pre-aggregated: only digests that occur again travel back to the pages
    same = (p.filter(F.col("payload_bytes") >= least).groupBy("payload_digest", "payload_bytes")
            .agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).filter("n > 1 and last is not null")
            .select("payload_digest", "payload_bytes", "last"))
    j = p.join(same, ["payload_digest", "payload_bytes"], "left")
    again = F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    return j.select("page_id", "url", F.when(~again, F.col("html")).alias("html"), "payload_bytes", "payload_digest",
                    F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("last")).alias("refers_to"))


def record(page_id: int | None, url: str | None, html: str | None, n: int, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; ``html`` is None for a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()
    block = http + (html or "").encode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if html is not None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=''.join(map(chr, range(33, 127))))}")
    head.append(f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}")
    if html is None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def package(data: bytes, index: list[dict]) -> bytes:
    """The ZIP file; every member is stored."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        z.writestr(DATA, data)
        z.writestr(INDEX, "".join(json.dumps(x, separators=(",", ":")) + "\n" for x in index))
        z.writestr("datapackage.json", json.dumps({"profile": "data-package", "resources": [{"path": DATA}, {"path": INDEX}]}))
    return out.getvalue()


def write_archives(records: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Rows of ``plan_records`` -> archives ``(archive, content)``, packed within each task."""
    ship_package(records.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task, count = TaskContext.get().partitionId(), 0
        data, index = bytearray(), []

        def close() -> pa.RecordBatch:
            nonlocal data, index, count
            out = pa.RecordBatch.from_arrays([pa.array([f"part-{task:06d}-{count:06d}.wacz"]), pa.array([package(bytes(data), index)], pa.binary())],
                                             names=["archive", "content"])
            data, index, count = bytearray(), [], count + 1
            return out
        for batch in batches:
            for i in range(batch.num_rows):
                page, url, html, n, digest, refers = (batch.column(k)[i].as_py() for k in range(6))
                z = gzip.compress(record(page, url, html, n, digest, refers), 6, mtime=0)
                index.append({"id": page, "offset": len(data), "length": len(z)})
                data += z
                if len(data) >= archive_bytes:
                    yield close()
        if index:
            yield close()
    return (records.select("page_id", "url", "html", "payload_bytes", "payload_digest", "refers_to")
            .mapInArrow(run, "archive string, content binary"))


# --- reading -----------------------------------------------------------------------------------

@dataclass(frozen=True)
class Member:
    name: str
    offset: int  # of the local header
    size: int
    stored: bool


ReadAt = Callable[[int, int], bytes]


def members(read_at: ReadAt, size: int) -> list[Member]:
    """The central directory, ZIP64 or not, found from the end of a file of ``size`` bytes."""
    span = min(size, 22 + 65535)
    tail = read_at(size - span, span)
    at = tail.rfind(b"PK\x05\x06")
    while at >= 0 and (at + 22 > span or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != span):
        at = tail.rfind(b"PK\x05\x06", 0, at)
    if at < 0:
        raise ValueError("no end of central directory")
    count, length, start = struct.unpack_from("<HII", tail, at + 10)
    end = size - span + at
    if count == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF:
        mark, place = struct.unpack("<4s4xQ4x", read_at(end - 20, 20))
        if mark != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        mark, count, length, start = struct.unpack("<4s28xQQQ", read_at(place, 56))
        if mark != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of central directory")
    raw, at, out = read_at(start, length), 0, []
    for _ in range(count):
        if raw[at:at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        flags, method = struct.unpack_from("<HH", raw, at + 8)
        packed, full, n, extra, comment = struct.unpack_from("<IIHHH", raw, at + 20)
        offset, = struct.unpack_from("<I", raw, at + 42)
        name = raw[at + 46:at + 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
        more = raw[at + 46 + n:at + 46 + n + extra]
        while len(more) >= 4:
            kind, m = struct.unpack_from("<HH", more)
            if kind == 1:  # the ZIP64 field holds, in this order, what did not fit
                wide = list(struct.unpack_from(f"<{m // 8}Q", more, 4))
                full = wide.pop(0) if full == 0xFFFFFFFF else full
                packed = wide.pop(0) if packed == 0xFFFFFFFF else packed
                offset = wide.pop(0) if offset == 0xFFFFFFFF else offset
            more = more[4 + m:]
        out.append(Member(name, offset, packed, method == 0 and not flags & 1))
        at += 46 + n + extra + comment
    return out


def place(read_at: ReadAt, member: Member) -> int:
    """Where a stored member's bytes begin."""
    if not member.stored:
        raise ValueError(f"{member.name} is not stored")
    mark, n, extra = struct.unpack("<4s22xHH", read_at(member.offset, 30))
    if mark != b"PK\x03\x04":
        raise ValueError("no local header")
    return member.offset + 30 + n + extra


def indexed(raw: bytes) -> list[tuple[int, int]] | None:
    """``(offset, length)`` of each line of an index: bare JSON or CDXJ (key, timestamp, JSON); None if a line names no place."""
    out = []
    for line in raw.splitlines():
        if not line.strip() or line.startswith(b"!"):  # CDXJ header lines start with "!"
            continue
        x = json.loads(line[line.index(b"{"):])
        if "offset" not in x or "length" not in x:
            return None
        out.append((int(x["offset"]), int(x["length"])))
    return out


def _packed(read_at: ReadAt, at: int, end: int) -> int:
    """Where the gzip member at ``at`` ends."""
    z, pos = zlib.decompressobj(31), at
    while not z.eof:
        piece = read_at(pos, min(65536, end - pos))
        if not piece:
            raise ValueError("a record is cut off")
        z.decompress(piece)
        pos += len(piece)
    return pos - len(z.unused_data)


def _plain(read_at: ReadAt, at: int, end: int) -> int:
    """Where the record at ``at`` of a WARC file that is not packed ends, with the two line ends after it."""
    head, pos = b"", at
    while b"\r\n\r\n" not in head:
        piece = read_at(pos, min(4096, end - pos))
        if not piece:
            raise ValueError("a record is cut off")
        head, pos = head + piece, pos + len(piece)
    size = head.index(b"\r\n\r\n") + 4
    stop = at + size + int(fields(head[:size - 4])["content-length"]) + 4
    if stop > end:
        raise ValueError("a record is cut off")
    return stop


def places(read_at: ReadAt, size: int) -> Iterator[tuple[int, int]]:
    """``(offset, length)`` in the file of each record of its WARC members, from the indexes.

    A file without an index, with one that names no places or with several WARC members is
    read through, record by record; an index that names places says which records count.
    """
    found = members(read_at, size)
    data = [m for m in found if m.name.startswith("archive/") and m.name.endswith((".warc.gz", ".warc"))]
    index = [m for m in found if m.name.startswith("indexes/") and m.name.endswith(".cdxj")]
    if len(data) == 1 and index:
        start = place(read_at, data[0])
        lines = [indexed(read_at(place(read_at, m), m.size)) for m in index]
        if None not in lines:
            yield from ((start + at, n) for part in lines for at, n in part)
            return
    for m in data:
        at = start = place(read_at, m)
        step = _packed if m.name.endswith(".gz") else _plain
        while at < start + m.size:
            end = step(read_at, at, start + m.size)
            yield at, end - at
            at = end


@dataclass(frozen=True)
class Record:
    page_id: int | None  # of this module's own records
    url: str | None
    kind: str
    payload_bytes: int
    payload_digest: str | None  # of SHA-1 the hex digits, of others as it stands
    refers_to: int | None
    payload: bytes | None  # None for a revisit
    record_id: str | None = None
    refers_to_id: str | None = None


def fields(head: bytes) -> dict[str, str]:
    """Header fields by their lower-case names, without the first line; folded lines are joined."""
    lines = head.decode(errors="replace").replace("\r\n ", " ").replace("\r\n\t", " ").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def _page(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?[0-9]+)>", urn or "")
    return int(found[1]) if found else None


def _digest(text: str | None) -> str | None:
    """A digest header's value: SHA-1, in base 32 or hex, as hex digits."""
    name, _, value = (text or "").partition(":")
    if name.lower() != "sha1":
        return text
    try:
        return value.lower() if len(value) == 40 else base64.b32decode(value.upper()).hex()
    except binascii.Error as e:
        raise ValueError(f"digest {text} is damaged") from e


def _joined(body: bytes) -> bytes | None:
    """The body that chunks make up; None if they are broken."""
    out, at = [], 0
    while found := re.compile(rb"([0-9A-Fa-f]+)[^\r\n]*\r\n").match(body, at):
        n = int(found[1], 16)
        if not n:
            return b"".join(out)
        out.append(body[found.end():found.end() + n])
        at = found.end() + n + 2
    return None


def parse(raw: bytes) -> Record:
    """A record of any type from its bytes, packed or not; a payload is held against its digest.

    The payload is what follows the HTTP header, where the block has one, else the whole
    block.  A digest of chunked content may be of the chunks or of what they make up.
    """
    if raw[:2] == b"\x1f\x8b":
        raw = gzip.decompress(raw)
    head, _, rest = raw.partition(b"\r\n\r\n")
    field = fields(head)
    name = field.get("warc-record-id")
    if "warc-type" not in field or not field.get("content-length", "").isdigit():
        raise ValueError(f"record {name} is damaged")
    kind, size = field["warc-type"], int(field["content-length"])
    payload, http = rest[:size], {}
    if len(payload) != size:
        raise ValueError(f"record {name} is cut off")
    if field.get("content-type", "").lower().replace(" ", "").startswith("application/http"):
        top, _, payload = payload.partition(b"\r\n\r\n")
        http = fields(top)
    n, digest = len(payload), _digest(field.get("warc-payload-digest"))
    if kind == "revisit":
        n = int(http["content-length"]) if http.get("content-length", "").isdigit() else n
    else:
        bodies = [payload] + ([_joined(payload)] if "chunked" in http.get("transfer-encoding", "").lower() else [])
        own = [sha1(b).hexdigest() for b in bodies if b is not None]
        if re.fullmatch("[0-9a-f]{40}", digest or "") and "warc-truncated" not in field and digest not in own:
            raise ValueError(f"record {name} is damaged")
        digest = digest or own[0]
    url = field.get("warc-target-uri")
    return Record(_page(name), url, kind, n, digest, _page(field.get("warc-refers-to")), None if kind == "revisit" else payload, name, field.get("warc-refers-to"))


def _schema(payload: bool) -> str:
    return ("page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, record_id string, refers_to_id string"
            + ", payload binary" * payload)


def _batches(records: Iterator[Record], payload: bool) -> Iterator[pa.RecordBatch]:
    """Batches of at most 2000 records or, with payloads, about 8 MB."""
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()] + [pa.binary()] * payload
    names, rows, held = [x.split()[0] for x in _schema(payload).split(", ")], [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)
    for r in records:
        rows.append((r.page_id, r.url, r.kind, r.payload_bytes, r.payload_digest, r.refers_to, r.record_id, r.refers_to_id, r.payload)[:8 + payload])
        held += len(r.payload or b"") if payload else 0
        if len(rows) >= 2000 or held > 8 << 20:
            yield batch()
            rows, held = [], 0
    if rows:
        yield batch()


def read_archives(archives: DataFrame, payload: bool = False) -> DataFrame:
    """``(archive, content)`` -> one row per record; ``payload`` adds the responses' bytes.

    Records of other writers have their ids in ``record_id`` and ``refers_to_id``; ``page_id``
    and ``refers_to`` are null there.  Every record type is returned.  An empty table of
    archives gives no rows; a damaged archive raises an error.
    """
    ship_package(archives.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell in batch.column(0):
                view = memoryview(cell.as_buffer())

                def read_at(at: int, n: int) -> bytes:
                    return bytes(view[at:at + n])
                yield from _batches((parse(read_at(at, n)) for at, n in places(read_at, len(view))), payload)
    return archives.select("content").mapInArrow(run, _schema(payload))


def open_file(path: str) -> BinaryIO:
    """A file by the path Spark gives it, for reading at places: local ones, and those of the stores that Arrow knows."""
    from pyarrow import fs
    if re.match("file:/", path):
        return fs.LocalFileSystem().open_input_file(re.sub("^file:/+", "/", path))
    store, inside = fs.FileSystem.from_uri(path)
    return store.open_input_file(inside)


def read_files(spark: SparkSession, path: str, payload: bool = False, opener: Callable[[str], BinaryIO] = open_file,
               block: int = 64 << 20) -> DataFrame:
    """The records of the archive files under ``path``, of any size, read by ranges where the files lie.

    Spark lists the files without their contents.  One pass finds the places of the records
    from directories and indexes; then the ranges of each ``block`` bytes of a file go to a task,
    which seeks and reads those alone.  ``opener`` opens a path for reading where Arrow does not
    know the store; its files have ``seek`` and ``read``.  Results and errors are those of ``read_archives``.
    """
    ship_package(spark)

    def reader(f: BinaryIO) -> ReadAt:
        def read_at(at: int, n: int) -> bytes:
            f.seek(at)
            return f.read(n)
        return read_at

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(name: str, some: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([name] * len(some)), pa.array([x for x, _ in some], pa.int64()), pa.array([x for _, x in some], pa.int64())],
                                              names=["path", "at", "n"])
        for batch in batches:
            for name, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with opener(name) as f:
                    found = places(reader(f), size)
                    while some := list(islice(found, 10_000)):
                        yield rows(name, some)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[Record]:
            name, f = None, None
            try:
                for batch in batches:
                    for p, at, n in zip(*(batch.column(k).to_pylist() for k in range(3))):
                        if p != name:
                            if f is not None:
                                f.close()
                            name, f = p, opener(p)
                        yield parse(reader(f)(at, n))
            finally:
                if f is not None:
                    f.close()
        yield from _batches(records(), payload)
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    found = files.mapInArrow(find, "path string, at long, n long")
    return (found.repartition("path", F.floor(F.col("at") / block)).sortWithinPartitions("path", "at")
            .mapInArrow(read, _schema(payload)))


def round_trip(pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES, **names) -> DataFrame:
    """Pages written to archives in the shared folder, and read back."""
    return read_archives(cut(write_archives(plan_records(pages, **names), archive_bytes)))
