"""Ordered key/value arrays and their ``k##v;k##v`` text form.

A gallery is ``ARRAY<STRUCT<pos INT, url STRING, descr STRING>>`` - an ordered
dict kept as an array, because Spark maps have no contractual order and
duplicate map keys raise.  Dict assignment semantics (a repeated key keeps
its first position and takes the last value) are rebuilt per row with
higher-order functions, so no shuffle is needed; a row's array is bounded
by the one page or text it came from.

SURVEY IDs: P13, P14, P15, P18.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hearth.functions.text import col_, let, py_strip, split_parts

# Separators of the text form.
ENTRY_SEP = ";"
KV_SEP = "##"


def entries(keys, values, key_name="url", value_name="descr") -> Column:
    """Zip two arrays into ``ARRAY<STRUCT<key, value>>``."""
    return F.arrays_zip(col_(keys).alias(key_name), col_(values).alias(value_name))


def dict_assign(arr, key="url", value="descr") -> Column:
    """Ordered-dict semantics over an array of (key, value) structs.

    First occurrence fixes a key's position, the last occurrence supplies its
    value; positions are renumbered 0..n-1 (``pos``).  O(n log n) per row: the
    entries are sorted by (key, position), each key's first and last entries
    are found by comparing neighbours, and the keys are put back in order of
    first position.  (``sort_array`` compares structs directly; ``array_sort`` would
    evaluate a comparator expression per comparison.)
    """
    def by_key(sorted_):
        def edge(step):
            return lambda x, j: ~F.coalesce(F.get(sorted_, j + step)["k"].eqNullSafe(x["k"]) & (j + step >= 0)
                                            & (j + step < F.size(sorted_)), F.lit(False))
        merged = F.zip_with(F.filter(sorted_, edge(-1)), F.filter(sorted_, edge(1)), lambda f, last: F.struct(
            f["i"].alias("i"), f["k"].alias("k"), last["v"].alias("v")))
        return F.transform(F.sort_array(merged), lambda x, pos: F.struct(
            pos.alias("pos"), x["k"].alias(key), x["v"].alias(value)))

    indexed = F.transform(col_(arr), lambda x, i: F.struct(x[key].alias("k"), i.alias("i"), x[value].alias("v")))
    return let(F.sort_array(indexed), by_key)


def encode_keys(gallery, key="url") -> Column:
    """``';'.join(keys)``."""
    return F.array_join(F.transform(col_(gallery), lambda x: x[key]), ENTRY_SEP)


def encode_pairs(gallery, key="url", value="descr") -> Column:
    """``';'.join(f'{k}##{v}')`` in array order."""
    return F.array_join(
        F.transform(col_(gallery),
                    lambda x: F.concat(x[key], F.lit(KV_SEP), F.coalesce(x[value], F.lit("")))),
        ENTRY_SEP)


def split_entries(text) -> Column:
    """Entries of ``a##b;c##d``; blank entries dropped.  Null or '' text gives none (never an error)."""
    return F.array_remove(split_parts(F.coalesce(col_(text), F.lit("")), ENTRY_SEP), "")


def _pair(entry, strip: bool) -> Column:
    """``(ok, k, v)`` of one entry; ok says that it has exactly one '##'."""
    def parts(at):
        tidy = py_strip if strip else (lambda c: c)
        rest = F.substring(entry, at + len(KV_SEP), F.length(entry))
        return F.struct(((at > 0) & ~F.contains(rest, F.lit(KV_SEP))).alias("ok"),
                        tidy(F.substring(entry, F.lit(1), at - 1)).alias("k"), tidy(rest).alias("v"))
    return let(F.locate(KV_SEP, entry), parts)


def decode(text, key="url", value="descr", strip: bool = False) -> Column:
    """``k##v;k##v`` -> ``(gallery, malformed)``: the ordered dict array, and the number of non-blank
    entries without exactly one '##', which are left out.  The text is taken apart once."""
    def build(entries_):
        good = F.filter(entries_, lambda e: e["ok"])
        kv = F.transform(good, lambda e: F.struct(e["k"].alias(key), e["v"].alias(value)))
        return let(kv, lambda a: F.struct(dict_assign(a, key, value).alias("gallery"),
                                          (F.size(entries_) - F.size(a)).alias("malformed")))
    return let(F.transform(split_entries(text), lambda e: _pair(e, strip)), build)


def decode_pairs(text, key="url", value="descr", strip: bool = False) -> Column:
    """``k##v;k##v`` -> ordered dict array; malformed entries are dropped (``decode`` counts them)."""
    return decode(text, key, value, strip)["gallery"]


def malformed_pairs(text) -> Column:
    """Number of non-blank entries that are not ``k##v``."""
    return F.size(F.filter(split_entries(text), lambda e: ~_pair(e, False)["ok"]))


def decode_model_list(text) -> Column:
    """Model list ``name##model; name ## model`` -> ARRAY<STRUCT<pos, name, model>>.

    Each entry is stripped before splitting and both parts after it; entries
    that do not split into two parts are skipped; a repeated name keeps its
    first position and takes the last model.
    """
    raw = F.coalesce(col_(text), F.lit(""))
    parts = F.transform(split_parts(raw, ENTRY_SEP), lambda x: split_parts(py_strip(x), KV_SEP))
    kv = F.transform(F.filter(parts, lambda p: F.size(p) == 2),
                     lambda p: F.struct(py_strip(p[0]).alias("name"), py_strip(p[1]).alias("model")))
    return dict_assign(kv, "name", "model")


def first_model(text) -> Column:
    """The model of the first entry: ``s.split(';')[0].split('##')[1]`` (null if absent)."""
    return F.get(split_parts(F.get(split_parts(col_(text), ENTRY_SEP), 0), KV_SEP), 1)
