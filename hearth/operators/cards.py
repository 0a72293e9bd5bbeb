"""Listing cards kept up to date day by day, instead of being made again from all rows.

A card is a listing's first row by ``(dt, seq)`` and its first non-empty gallery.  Both are
least values, and the least value of all days is the least of each day's: so a day stores
the *state* of its own keys (one row per key, no more), and a card is the least state of
its key.  A day that is added or replaced touches its own states alone; nothing of other days is read
or written, and the cards equal those made from all rows at any time, also after a
day lost rows.  Reading costs one row per key and day, aggregated before the shuffle.

Equal ``(dt, seq)`` of one key go by the row's other fields, so cards never depend on the order
in which rows are read.  Rows without ``dt`` or ``seq`` come after all others; rows without a key make no card.

SURVEY IDs: W1, W2.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.operators.prompt import FIELD_LABELS, base_info

FIELDS = tuple(name for name, _ in FIELD_LABELS)


def _place() -> list:
    """What a key's rows are ordered by: nulls last, then the day and the place in it."""
    return [(F.col("dt").isNull() | F.col("seq").isNull()).alias("unplaced"), F.col("dt").alias("day"), F.col("seq").cast("bigint").alias("seq")]


def day_states(rows: DataFrame, key: str = "house_id", fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """``rows`` (with ``dt``, ``seq`` and ``gallery``) -> one state per key and day: ``key, first, pictures, dt``.

    ``pictures`` is null where none of the key's rows has a gallery with entries.
    """
    own = [F.col(f"`{c}`") for c in fields if c in rows.columns]
    pictures = F.when(F.size("gallery") > 0, F.struct(*_place(), F.col("gallery")))
    return (rows.filter(F.col(key).isNotNull()).groupBy(key, "dt")
            .agg(F.min(F.struct(*_place(), *own)).alias("first"), F.min(pictures).alias("pictures"))
            .select(key, "first", "pictures", "dt"))


def merged(states: DataFrame, key: str = "house_id") -> DataFrame:
    """States of any days -> one per key: ``key, first, pictures``."""
    return states.groupBy(key).agg(F.min("first").alias("first"), F.min("pictures").alias("pictures"))


def cards(states: DataFrame, key: str = "house_id", requests: DataFrame | None = None) -> DataFrame:
    """States -> ``key, info, gallery``, as ``prompt.listing_cards`` gives them from rows (null gallery: none has entries).

    With ``requests`` only the keys in it; other states are dropped before they are merged.
    """
    if requests is not None:
        states = states.join(requests.select(key).distinct(), key, "left_semi")
    flat = merged(states, key).select(key, "first.*", F.col("pictures.gallery").alias("gallery"))
    return flat.select(key, base_info(flat).alias("info"), "gallery")


def state_schema(rows: T.StructType, key: str = "house_id", fields: tuple[str, ...] = FIELDS) -> T.StructType:
    """Schema of ``day_states`` of rows of this schema, as stored."""
    kinds = {f.name: f.dataType for f in rows.fields}
    place = [T.StructField("unplaced", T.BooleanType()), T.StructField("day", T.StringType()), T.StructField("seq", T.LongType())]
    first = T.StructType(place + [T.StructField(c, kinds[c]) for c in fields if c in kinds])
    pictures = T.StructType(place + [T.StructField("gallery", kinds["gallery"])])
    return T.StructType([T.StructField(key, kinds[key]), T.StructField("first", first), T.StructField("pictures", pictures),
                         T.StructField("dt", T.StringType())])
