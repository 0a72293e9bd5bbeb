"""Image files told whole, cut off or damaged by their own parts."""

import struct
import time
import zlib

import pytest
from pyspark.sql import functions as F

from hearth import schema
from hearth.functions.imagemeta import Meta, read_meta, with_meta
from hearth.operators import gallery
from hearth.plans import jobs
from hearth.sources import files


def chunk(name, body):
    return struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))


def png(width=3, height=2, body=b"pixels"):
    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0))
            + chunk(b"tEXt", b"IEND") + chunk(b"IDAT", zlib.compress(body)) + chunk(b"IEND", b""))


def gif(width=3, height=2, version=b"GIF89a"):
    comment = b"\x21\xfe" + b"\x05a;b;c" + b"\x00"  # the trailer's byte inside a comment
    image = b"\x2c" + struct.pack("<HHHHB", 0, 0, width, height, 0x80) + b"\0" * 6 + b"\x02" + b"\x03\x3b\x3b\x3b" + b"\x00"
    return version + struct.pack("<HHBBB", width, height, 0x91, 0, 0) + b"\0" * 12 + comment + image + b"\x3b"


def segment(mark, body):
    return bytes([0xFF, mark]) + struct.pack(">H", len(body) + 2) + body


def jpeg(width=3, height=2, scan=b"\x12\xff\x00\x34\xff\xd0\x56"):
    thumb = b"Exif\0\0" + b"\xff\xd8\xff\xd9"  # an end mark inside a thumbnail
    frame = segment(0xC2, struct.pack(">BHHB", 8, height, width, 1) + b"\x01\x11\x00")
    scans = b"".join(segment(0xDA, b"\x01\x01\x00\x00\x3f\x00") + s for s in (scan, scan))
    return b"\xff\xd8" + segment(0xE1, thumb) + segment(0xC4, b"\x00" * 5) + b"\xff\xff" + frame + scans + b"\xff\xd9"


@pytest.mark.parametrize("kind,data", [("png", png()), ("gif", gif()), ("gif", gif(version=b"GIF87a")), ("jpeg", jpeg())])
def test_every_prefix_is_cut_and_only_the_file_is_whole(kind, data):
    assert read_meta(data) == Meta(kind, 3, 2, "whole")
    assert read_meta(data + b"behind the end") == Meta(kind, 3, 2, "whole")
    for n in range(1, len(data)):
        got = read_meta(data[:n])
        assert (got.kind, got.state) == (kind, "cut"), n
        assert got.width in (None, 3) and got.height in (None, 2)


def test_damage_and_other_bytes():
    broken = bytearray(png())
    broken[-20] ^= 1
    assert read_meta(bytes(broken)).state == "damaged"
    assert read_meta(png()[:8] + chunk(b"IDAT", b"")) == Meta("png", state="damaged")
    assert read_meta(gif()[:25] + b"\x07" + gif()[25:]).state == "damaged"
    assert read_meta(b"\xff\xd8\xff\xd9") == Meta("jpeg", state="damaged")  # no frame, so no size
    assert read_meta(b"\xff\xd8no marker").state == "damaged"
    assert read_meta(None) == read_meta(b"") == Meta(state="empty")
    assert read_meta(b"BM....") == read_meta(b"<html>404</html>") == Meta(state="unknown")


def test_time_grows_with_the_bytes():
    """Hostile bytes: very many empty parts, and scans that are almost ended at every byte."""
    def seconds(n):
        bodies = [b"\xff\xd8" + b"\xff\xe0\x00\x02" * n, jpeg(scan=b"\xff\x00" * n), gif()[:25] + b"\x21\xfe\x00" * n, png(body=b"\xff" * n)]
        t = time.perf_counter()
        for b in bodies:
            read_meta(b)
        return time.perf_counter() - t
    small, large = min(seconds(20_000) for _ in range(3)), min(seconds(200_000) for _ in range(3))
    assert large < 20 * small


def test_columns_on_spark(spark):
    rows = [(1, png(70000, 9)), (2, gif()[:-1]), (3, jpeg()), (3, jpeg()), (4, None), (5, b""), (6, b"II*\0"), (None, png())]
    df = spark.createDataFrame(rows, "k int, content binary").withColumn("meta", F.lit("old"))
    got = sorted(((r.k, *r.meta) for r in with_meta(df).select("k", "meta").collect()), key=str)
    assert got == sorted([(1, "png", 70000, 9, "whole"), (2, "gif", 3, 2, "cut"), (3, "jpeg", 3, 2, "whole"), (3, "jpeg", 3, 2, "whole"),
                          (4, None, None, None, "empty"), (5, None, None, None, "empty"), (6, None, None, None, "unknown"),
                          (None, "png", 3, 2, "whole")], key=str)
    assert with_meta(spark.createDataFrame([], schema.IMAGES)).collect() == []


def test_broken_images_count_as_failed(spark, scratch):
    """Prompts go without images that are cut off, and the counters tell how many."""
    root, dt = f"{scratch}/stages", "20240101"
    urls = ["http://i/a.jpg", "http://i/b.jpg", "http://i/c.jpg"]
    final = spark.createDataFrame([(7, 0, [(i, u, "") for i, u in enumerate(urls)])],
                                  "house_id bigint, seq bigint, gallery array<struct<pos:int,url:string,descr:string>>")
    files.write_stage(final, root, "final", dt)
    images = spark.createDataFrame([(urls[0], jpeg()), (urls[1], jpeg()[:-4]), (urls[2], b"II*\0"), ("http://i/d.jpg", None)], schema.IMAGES)
    assert sorted(r.url for r in gallery.sound_images(images).collect()) == [urls[0], urls[2]]
    jobs.prompts_stage(spark, root, dt, *jobs.score_all_requests(spark, root, dt, "两居"), images, check_images=True)
    parts = files.read_stage(spark, root, "prompts", dt=dt).first().messages[1].content
    assert len([p for p in parts if p.type == "image_url"]) == 2
    counts = {r["name"]: r.value for r in jobs.read_metrics(spark, root, dt).filter("stage = 'images'").collect()}
    assert counts == {"landed": 4, "whole": 1, "cut": 1, "empty": 1, "damaged": 0, "unknown": 1}
