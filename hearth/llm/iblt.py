"""Document fingerprints by invertible Bloom lookup tables (operator 7), native.

A text is cut into its paragraphs (lines), and those at sentence ends; its
fingerprint is a small table of cells.  Each distinct piece's digest falls into one
cell of each of three sub-tables, and a cell keeps a count and the XOR of its
digests and of their check sums.  Subtracting two tables leaves only the pieces
that differ.  Peeling takes cells that hold a single digest, counts it, and
removes it from its other cells until the table is empty.

If peeling gets stuck, larger tables are made of the digests: one small table for each
group of about twelve digests (grouped by hash), and for a group that gets stuck again one of
more cells, and so on.  Everything is built from array functions on a row, so
memory is bounded by a document, and texts move only to meet their neighbours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearth.functions.text import let
from hearth.llm.common import cut, row_key, text_or_empty

#: Cells of each of the three sub-tables of a fingerprint, and of the larger ones that are tried in turn.
WIDTH, LARGER, GROUP = 4, (8, 16, 64, 256), 12
PIECES = r"[.!?\n]"


def digests(text: Column) -> Column:
    """The distinct 64-bit digests of a text's pieces, blanks around them aside; blank pieces have none."""
    return F.array_distinct(F.transform(F.filter(F.transform(F.split(text, PIECES), lambda x: F.trim(x)), lambda x: x != ""), lambda x: F.xxhash64(x)))


def _check(k: Column) -> Column:
    return F.xxhash64(F.lit("check"), k)


def _entry(k: Column, width: int, sign: Column) -> Column:
    spot = [(F.shiftrightunsigned(k, 13 * t).bitwiseAND(F.lit(width - 1)).cast("int") + t * width).alias(f"c{t}") for t in range(3)]
    return F.struct(sign.alias("c"), k.alias("k"), _check(k).alias("h"), *spot)


def _put(cells: Column, entries: Column) -> Column:
    """Each cell with the entries that fall into it added."""
    def fill(x: Column, i: Column) -> Column:
        return F.aggregate(F.filter(entries, lambda e: (e["c0"] == i) | (e["c1"] == i) | (e["c2"] == i)), x,
                           lambda a, e: F.struct((a["c"] + e["c"]).alias("c"), a["k"].bitwiseXOR(e["k"]).alias("k"), a["h"].bitwiseXOR(e["h"]).alias("h")))
    return F.transform(cells, fill)


def table(keys: Column, width: int = WIDTH) -> Column:
    """The table of an array of digests: cells ``(c, k, h)``."""
    zero = F.struct(F.lit(0).alias("c"), F.lit(0).cast("long").alias("k"), F.lit(0).cast("long").alias("h"))
    empty = F.array_repeat(zero, 3 * width)
    return let(F.transform(keys, lambda k: _entry(k, width, F.lit(1))), lambda e: _put(empty, e))


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.struct((x["c"] - y["c"]).alias("c"), x["k"].bitwiseXOR(y["k"]).alias("k"), x["h"].bitwiseXOR(y["h"]).alias("h")))


def peel(cells: Column, width: int = WIDTH) -> Column:
    """The digests left in a subtracted table, or null if peeling gets stuck."""
    def step(state: Column, _: Column) -> Column:
        pure = F.filter(state["cells"], lambda x: (F.abs(x["c"]) == 1) & (x["h"] == _check(x["k"])))
        # taken out again: the entry with the opposite sign
        keys = F.array_distinct(F.transform(pure, lambda x: _entry(x["k"], width, -x["c"])))
        return let(keys, lambda e: F.when(F.size(e) == 0, state).otherwise(
            F.struct(_put(state["cells"], e).alias("cells"), F.concat(state["found"], F.transform(e, lambda x: x["k"])).alias("found"))))
    rounds = F.sequence(F.lit(1), F.lit(6 + width // 2 if width < 16 else 20))
    start = F.struct(cells.alias("cells"), F.array().cast("array<long>").alias("found"))
    return F.aggregate(rounds, start, step, lambda s: F.when(
        F.forall(s["cells"], lambda x: (x["c"] == 0) & (x["k"] == 0) & (x["h"] == 0)), s["found"]))


def difference(a: Column, b: Column, table_a: Column, table_b: Column) -> Column:
    """How many pieces two texts do not share, from their fingerprints or, if stuck, larger tables."""
    def grouped(keys: Column, of: Column) -> Column:
        return F.transform(keys, lambda k: F.struct(F.pmod(F.shiftrightunsigned(k, 40), of).cast("int").alias("g"), k.alias("k")))

    def group(keys: Column, g: Column) -> Column:
        return F.transform(F.filter(keys, lambda x: x["g"] == g), lambda x: x["k"])

    def grown(x: Column, y: Column) -> Column:
        tries = [F.array_size(peel(subtract(table(x, w), table(y, w)), w)) for w in LARGER]
        exact = F.size(F.array_except(x, y)) + F.size(F.array_except(y, x))
        return F.coalesce(*tries, exact)
    of = F.ceil((F.size(a) + F.size(b)) / GROUP).cast("int")
    total = let(F.struct(of.alias("of"), grouped(a, of).alias("x"), grouped(b, of).alias("y")), lambda p: F.aggregate(
        F.sequence(F.lit(0), p["of"] - 1), F.lit(0), lambda s, g: s + let(
            F.struct(group(p["x"], g).alias("x"), group(p["y"], g).alias("y")), lambda q: grown(q["x"], q["y"]))))
    return F.coalesce(F.array_size(peel(subtract(table_a, table_b))), total)


def likeness(a: Column, b: Column, table_a: Column, table_b: Column) -> Column:
    """Share of pieces that two texts have in common (0 to 1, counted on both sides); 1 for two texts without pieces."""
    n = F.size(a) + F.size(b)
    return F.when(n == 0, F.lit(1.0)).otherwise(1 - difference(a, b, table_a, table_b) / n)


def shown(keys: Column, cells: Column) -> Column:
    """A fingerprint as text: the number of pieces, then each cell's count, digests and check sums in hex."""
    one = F.transform(cells, lambda x: F.concat_ws(".", F.hex(x["c"].cast("long")), F.hex(x["k"]), F.hex(x["h"])))
    return F.concat(F.size(keys).cast("string"), F.lit(":"), F.array_join(one, " "))


def neighbours(ids: DataFrame) -> DataFrame:
    """Distinct ``(id, row, ...)`` -> also ``next_id, next_row``: the row that follows by descending id.

    Rows that share an id follow by text hash; null ids come last; after the last row
    follows the first.  Rows are cut into ranges of ids, each in a task of its own, and
    only the ends of the ranges meet.
    """
    n = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = cut(ids.repartitionByRange(n, "id", "row").withColumn("range", F.spark_partition_id()))
    order = [F.col("id").asc_nulls_first(), F.col("row")]
    me = F.struct("id", "row")
    inside = part.withColumn("prev", F.lag(me).over(Window.partitionBy("range").orderBy(*order)))
    last = F.max(F.struct(F.col("id").isNotNull().alias("z"), "id", "row"))
    ends = part.groupBy("range").agg(last.alias("m")).select("range", F.struct("m.id", "m.row").alias("end"))
    # one row per range: the range before it, or for the lowest the highest
    every = Window.orderBy("range")
    top = F.last("end").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ends = ends.select("range", F.coalesce(F.lag("end").over(every), top).alias("before"))
    both = inside.join(F.broadcast(ends), "range").withColumn("next", F.coalesce("prev", "before"))
    return both.select(*ids.columns, F.col("next.id").alias("next_id"), F.col("next.row").alias("next_row"))


def compare_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text, its edited text and the next one, by fingerprint.

    The edited text has the last half (rounded down, in code points) replaced by as many
    of the next document's first code points, or all it has.  One row per input row:
    ``id, row, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next``.

    Null reads as empty.  A lone document is its own next.  Equal rows count once in the
    order and give equal results; further columns are ignored; an empty table
    gives no rows.
    """
    t = docs.select(F.col(id_col).cast("long").alias("id"), row_key(text_col).alias("row"), text_or_empty(text_col).alias("t"))
    near = cut(neighbours(t.select("id", "row", F.floor(F.length("t") / 2).cast("int").alias("half")).dropDuplicates(["id", "row"])))
    full = t.select("id", "row", "t", digests(F.col("t")).alias("d"))
    ask = near.select(F.col("id").alias("to_id"), F.col("row").alias("to_row"), "half", F.col("next_id").alias("i"), F.col("next_row").alias("r"))
    # the next document hands over what is asked of it: some first characters and its digests
    given = full.join(ask, F.col("id").eqNullSafe(F.col("i")) & (F.col("row") == F.col("r")))
    given = (given.select("to_id", "to_row", "half", F.col("t").substr(F.lit(1), F.col("half")).alias("piece"), F.col("d").alias("nd"))
             .dropDuplicates(["to_id", "to_row"]))
    both = full.join(given, F.col("id").eqNullSafe(F.col("to_id")) & (F.col("row") == F.col("to_row")))
    n = F.length("t")
    both = both.select("id", "row", n.cast("long").alias("n_chars"), "d", "nd",
                       F.concat(F.col("t").substr(F.lit(1), n - F.col("half")), F.col("piece")).alias("edited"))
    # arrays are made once, before they are read many times
    both = both.withColumn("x", let(F.struct("d", digests(F.col("edited")).alias("ed"), "nd"), lambda s: F.struct(
        s["d"].alias("d"), s["ed"].alias("ed"), s["nd"].alias("nd"), table(s["d"]).alias("t"), table(s["ed"]).alias("et"), table(s["nd"]).alias("nt"))))
    out = let(F.col("x"), lambda s: F.struct(
        shown(s["d"], s["t"]).alias("fingerprint"), shown(s["ed"], s["et"]).alias("edited_fingerprint"),
        likeness(s["d"], s["ed"], s["t"], s["et"]).alias("near_edited"), likeness(s["d"], s["nd"], s["t"], s["nt"]).alias("near_next")))
    return both.withColumn("o", out).select("id", "row", "n_chars", "edited", "o.fingerprint", "o.edited_fingerprint", "o.near_edited", "o.near_next")
