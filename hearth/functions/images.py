"""Image URL and data-URI helpers (all JVM-side expressions).

SURVEY IDs: P11, P12, M2.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hearth.functions.text import col_, let, py_strip

# Thumbnail sizes in image URLs.
THUMB_SMALL = "120x80"
THUMB_MEDIUM = "450x300"
THUMB_PREVIEW = "210x140"

# base64 prefixes that identify an image type, tested in this order.
# Prefixes are on the base64 text, so a BMP is recognised only when its third
# byte is 0x80-0xBF and only GIF89a (not GIF87a) is a gif; anything else gets an
# empty type, as in 'data:image/;base64,...'.
SNIFF_PREFIXES = [
    ("/9j/", "jpeg"),
    ("iVBORw0KGgo", "png"),
    ("R0lGODlh", "gif"),
    ("Qk2", "bmp"),
    ("SUkq", "tiff"),
]


def tidy_url(c) -> Column:
    """``s.strip().strip('`')``: blanks first, then backticks at both ends."""
    return F.btrim(py_strip(c), F.lit("`"))


def resize_thumb(c, origin: str = THUMB_SMALL, dest: str = THUMB_MEDIUM) -> Column:
    """Rewrite the size token of an image URL (every occurrence, like str.replace)."""
    return F.replace(col_(c), F.lit(origin), F.lit(dest))


def b64(content) -> Column:
    """Plain base64 without line breaks (Spark's base64 wraps lines at 76 characters)."""
    return F.replace(F.base64(col_(content)), F.lit("\r\n"), F.lit(""))


def sniff_type(b64_text) -> Column:
    t = col_(b64_text)
    out = None
    for prefix, kind in SNIFF_PREFIXES:
        cond = F.startswith(t, F.lit(prefix))
        out = F.when(cond, F.lit(kind)) if out is None else out.when(cond, F.lit(kind))
    return out.otherwise(F.lit(""))


def data_uri(content) -> Column:
    """Image bytes -> ``data:image/<type>;base64,<data>``; '' when there are no bytes."""
    uri = let(b64(content), lambda t: F.concat(F.lit("data:image/"), sniff_type(t),
                                                F.lit(";base64,"), t))
    return F.when(col_(content).isNull(), F.lit("")).otherwise(uri)


def data_uri_bytes(uri) -> Column:
    """Inverse of ``data_uri``: ``b64decode(uri.split(',')[1])``."""
    return F.unbase64(F.get(F.split(col_(uri), ",", -1), 1))
