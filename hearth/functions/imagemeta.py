"""What an image file's own bytes tell: its type, its size in pixels and whether it is whole.

A download that broke off leaves a file that starts like an image and lacks its end.  Each
format says where it ends: PNG by its ``IEND`` chunk, GIF by its trailer, JPEG by
the end marker after its last scan.  The readers here walk the parts of a file from its start
(so an end mark inside a thumbnail or a comment doesn't count) and never decode pixels;
each byte is passed at most once.

``state`` is one of

* ``whole``: the walk reached the format's end (bytes behind it are ignored);
* ``cut``: the file ends before;
* ``damaged``: a part contradicts the format (a wrong PNG checksum, an unknown GIF block, no size);
* ``empty``: no bytes, or null;
* ``unknown``: none of the three formats.

``kind``, ``width`` and ``height`` are null where the bytes don't tell them.

SURVEY IDs: S9, F7.
"""

from __future__ import annotations

import re
from typing import NamedTuple
from zlib import crc32

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.session import ship_package

META = "kind string, width int, height int, state string"

# What files of a format start with.
PNG, GIF, JPEG = b"\x89PNG\r\n\x1a\n", (b"GIF87a", b"GIF89a"), b"\xff\xd8"
#: JPEG markers that start a frame (and so hold its size), and those that stand without a length.
_FRAMES = frozenset(range(0xC0, 0xD0)) - {0xC4, 0xC8, 0xCC}
_BARE = frozenset({0x01, *range(0xD0, 0xD8)})
#: In a scan's data only 0xFF before another byte than 0 or a restart marker ends the data.
_SCAN_END = re.compile(rb"\xff[^\x00\xff\xd0-\xd7]")


class Meta(NamedTuple):
    kind: str | None = None
    width: int | None = None
    height: int | None = None
    state: str = "unknown"


def read_meta(content: bytes | None) -> Meta:
    if not content:
        return Meta(state="empty")
    for start, reader in ((PNG, _png), (GIF, _gif), (JPEG, _jpeg)):
        if content.startswith(start):
            return reader(content)
    for name, start in (("png", PNG), ("gif", GIF[0]), ("gif", GIF[1]), ("jpeg", JPEG)):
        if start.startswith(content):  # too short even for the signature
            return Meta(name, state="cut")
    return Meta()


def _png(data: bytes) -> Meta:
    at, size = len(PNG), (None, None)
    while at + 8 <= len(data):
        n, name = int.from_bytes(data[at:at + 4], "big"), data[at + 4:at + 8]
        end = at + 8 + n
        if end + 4 > len(data):
            return Meta("png", *size, "cut")
        if crc32(memoryview(data)[at + 4:end]) != int.from_bytes(data[end:end + 4], "big"):
            return Meta("png", *size, "damaged")
        if size[0] is None:
            if name != b"IHDR" or n != 13:
                return Meta("png", state="damaged")
            size = int.from_bytes(data[at + 8:at + 12], "big") & 0x7FFFFFFF, int.from_bytes(data[at + 12:at + 16], "big") & 0x7FFFFFFF
        if name == b"IEND":
            return Meta("png", *size, "whole")
        at = end + 4
    return Meta("png", *size, "cut")


def _gif(data: bytes) -> Meta:
    if len(data) < 13:
        return Meta("gif", state="cut")
    size = int.from_bytes(data[6:8], "little"), int.from_bytes(data[8:10], "little")

    def colours(flags: int) -> int:
        return 3 << ((flags & 7) + 1) if flags & 0x80 else 0
    at = 13 + colours(data[10])
    while at < len(data):
        mark = data[at]
        if mark == 0x3B:
            return Meta("gif", *size, "whole")
        if mark == 0x21:
            at += 2
        elif mark == 0x2C:
            if at + 10 > len(data):
                return Meta("gif", *size, "cut")
            at += 11 + colours(data[at + 9])
        else:
            return Meta("gif", *size, "damaged")
        while at < len(data) and data[at]:  # blocks of up to 255 bytes, up to one of none
            at += 1 + data[at]
        at += 1
    return Meta("gif", *size, "cut")


def _jpeg(data: bytes) -> Meta:
    at, size = len(JPEG), (None, None)
    while at + 2 <= len(data):
        if data[at] != 0xFF:
            return Meta("jpeg", *size, "damaged")
        mark = data[at + 1]
        if mark == 0xFF:  # any number of these may fill up before a marker
            at += 1
        elif mark in _BARE:
            at += 2
        elif mark == 0xD9:
            return Meta("jpeg", *size, "whole" if size[0] is not None else "damaged")
        else:
            n = int.from_bytes(data[at + 2:at + 4], "big")
            if at + 4 > len(data) or at + 2 + n > len(data):
                return Meta("jpeg", *size, "cut")
            if n < 2 or mark in _FRAMES and n < 8:
                return Meta("jpeg", *size, "damaged")
            if mark in _FRAMES:
                size = int.from_bytes(data[at + 7:at + 9], "big"), int.from_bytes(data[at + 5:at + 7], "big")
            at += 2 + n
            if mark == 0xDA:
                end = _SCAN_END.search(data, at)
                if end is None:
                    return Meta("jpeg", *size, "cut")
                at = end.start()
    return Meta("jpeg", *size, "cut")


def with_meta(images: DataFrame, content: str = "content", name: str = "meta") -> DataFrame:
    """``images`` and a struct column of what each one's bytes tell (in place of a column of that name).

    Only the bytes go through Python, in Arrow batches that Spark bounds by size; nothing is shuffled.
    """
    ship_package(images.sparkSession)

    @F.pandas_udf(META)
    def meta(content: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame([read_meta(c) for c in content], columns=list(Meta._fields))
        return out.astype({"width": "Int32", "height": "Int32"})
    return images.withColumn(name, meta(F.col(content)))
