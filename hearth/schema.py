"""Declared schemas of every stage table (never inferred).

Canonical column spelling is used throughout; ``LEGACY_NAMES`` maps the
misspelt names found in older stage files onto it when they are read.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, L, I = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()


def _f(name, typ, nullable=True):
    return T.StructField(name, typ, nullable)


# Ordered listing columns as the collect stage produces them.
LISTING_FIELDS = [
    _f("house_id", L, False), _f("title", S), _f("district", S),
    _f("community", S), _f("position", S), _f("tax", S),
    _f("total_price", D, False), _f("unit_price", D, False), _f("link", S),
    _f("house_type", S), _f("house_size", D, False), _f("direction", S),
    _f("fitment", S), _f("level", S), _f("build_type", S),
]
LISTINGS = T.StructType(LISTING_FIELDS + [_f("seq", L), _f("dt", S)])

FLAG_COLUMNS = ["is_high_level", "is_unit_price_high", "is_total_price_high"]
SCREENED = T.StructType(LISTINGS.fields + [_f(c, I) for c in FLAG_COLUMNS])

GALLERY_ENTRY = T.StructType([_f("pos", I), _f("url", S), _f("descr", S)])
GALLERY = T.ArrayType(GALLERY_ENTRY, False)

DETAILS = T.StructType([_f("house_id", L, False), _f("link", S), _f("gallery", GALLERY)])
# text interchange form of DETAILS (url lists joined by ';', entries 'url##descr')
DETAILS_TEXT = T.StructType([_f("house_id", L), _f("link", S), _f("urls", S), _f("url_dict", S)])

IMAGES = T.StructType([_f("url", S), _f("content", T.BinaryType())])

WISHES = T.StructType([_f("wish_id", L, False), _f("user_input", S)])
REQUESTS = T.StructType([_f("house_id", L, False), _f("wish_id", L, False)])

CONTENT_PART = T.StructType([
    _f("type", S), _f("text", S),
    _f("image_url", T.StructType([_f("url", S)])),
])
MESSAGE = T.StructType([_f("role", S), _f("content", T.ArrayType(CONTENT_PART))])
PROMPTS = T.StructType([_f("house_id", L), _f("wish_id", L),
                        _f("messages", T.ArrayType(MESSAGE))])
REPLIES = T.StructType([_f("house_id", L), _f("wish_id", L), _f("reply", S), _f("score", I)])

PAGES = T.StructType([_f("page_id", L), _f("url", S), _f("html", S)])
REJECTS = T.StructType([_f("page_id", L), _f("pos", I), _f("card", S), _f("reject_reason", S)])
PROFILES = T.StructType([_f("profile", S), _f("value", S), _f("n", L), _f("rank", I)])
FINAL = T.StructType([f for f in SCREENED.fields if f.name != "dt"] + [_f("gallery", GALLERY)])
STORED_REPLIES = T.StructType(REPLIES.fields + [_f("outcome", S)])
SHORTLIST_GROUPS = T.StructType([_f("wish_id", L), _f("community", S), _f("house_type", S),
                                 _f("n_listings", L), _f("max_score", I), _f("avg_score", D)])
SHORTLIST = T.StructType([_f("wish_id", L), _f("reply", S), _f("score", I)]
                         + [f for f in FINAL.fields if f.name != "gallery"])
METRICS = T.StructType([_f("stage", S), _f("name", S), _f("value", L), _f("run", S)])

# Column names written by older stage files -> canonical names.
LEGACY_NAMES = {
    "hourse_type": "house_type",
    "hourse_size": "house_size",
}
# Index column written by a CSV export that kept its row index.
INDEX_COLUMNS = ("Unnamed: 0", "_c0", "")

#: What each stage table holds, besides its ``dt``; readers never infer it, so a stage
#: without rows reads as an empty table.
STAGES = {
    "listings": LISTINGS, "rejects": REJECTS, "screened": SCREENED, "profiles": PROFILES,
    "details": DETAILS, "final": FINAL, "prompts": PROMPTS, "replies": STORED_REPLIES,
    "shortlist_groups": SHORTLIST_GROUPS, "shortlist": SHORTLIST, "metrics": METRICS,
}


def stage_schema(stage: str) -> T.StructType:
    return T.StructType([f for f in STAGES[stage].fields if f.name != "dt"] + [_f("dt", S)])
