"""Line de-duplication by a deletion-neighbourhood join (operator 5), native.

The edited unit is the word.  A line counts as a duplicate when an earlier line
is equal to it, or differs from it by at most one inserted, deleted or
replaced word.  "Earlier" goes by document id, then by position.

Near matches come from hashed variants: a line and each of its one-word deletions.
Two lines that share a deletion at the same place differ by a replaced word; a
line that equals a deletion of another differs by an inserted word.  Each
group of equal variants is reduced to its earliest line by grouped minima,
so a variant of very many lines makes no pairs.  Before variants are made, the
lines without a partner are set aside: lines one word apart share at least half of
their words at the start or at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.functions.text import let
from hearth.llm.common import SPACES, WORD, cut, row_key, spread, text_or_empty

#: Lines of fewer words are never removed: those without any.
MIN_WORDS = 1
#: Lines of fewer words only count as duplicates when equal: one word of four or less is another line.
EDIT_WORDS = 5
#: Running hashes are made in pieces of so many words, so that a line costs as much as it has words.
PIECE = 64


def words_of(line: Column) -> Column:
    """Words between ASCII white space; a line with blanks alone is split at those, which is cheaper."""
    return F.array_remove(F.when(line.rlike(r"[\x09-\x0D]"), F.split(line, SPACES)).otherwise(F.split(line, " ")), "")


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per line: where it stands and its text."""
    return docs.select(F.col(id_col).cast("long").alias("id"), row_key(text_col).alias("row"),
                       F.posexplode(F.split(text_or_empty(text_col), "\n")).alias("pos", "line"))


def _hashed(lines: DataFrame, least: int, edit_words: int) -> DataFrame:
    """Lines of at least ``least`` words with 128 bits that stand for the line, made of
    its halves' hashes, and the keys of which lines one word apart share one: hashes of a start and an end of half the words,
    rounded down and up."""
    words = lines.select("id", "row", "pos", words_of(F.col("line")).alias("words")).withColumn("n", F.size("words"))
    words = words.filter(F.col("n") >= least)
    short, long = F.floor(F.col("n") / 2).cast("int"), F.ceil(F.col("n") / 2).cast("int")
    odd = F.col("n") % 2 == 1  # else both halves are as long
    half = words.select("id", "row", "pos", "n", "words", F.xxhash64(short, F.slice("words", F.lit(1), short)).alias("s0"),
                        F.xxhash64(F.lit("end"), short, F.slice("words", long + 1, short)).alias("e0"))
    parts = half.select("id", "row", "pos", "n", "s0", "e0",
                        F.when(odd, F.xxhash64(long, F.slice("words", F.lit(1), long))).otherwise(F.col("s0")).alias("s1"),
                        F.when(odd, F.xxhash64(F.lit("end"), long, F.slice("words", short + 1, long))).otherwise(F.col("e0")).alias("e1"))
    keys = F.when(F.col("n") < edit_words, None).when(F.col("n") % 2 == 0, F.array("s0", "e0")).otherwise(F.array("s0", "e0", "s1", "e1"))
    return parts.select("id", "row", "pos", F.xxhash64("s0", "e1", "n").alias("h1"), F.xxhash64("e1", "s0", "n").alias("h2"), keys.alias("halves"))


def _order() -> Column:
    """Where a line stands: known ids first, then by id, text hash and position."""
    return F.struct(F.col("id").isNull().alias("z"), "id", "row", "pos")


#: Rows of a slim table that may be broadcast once counted (about 30 MB); larger ones are shuffled.
BROADCAST_ROWS = 300_000


def _words_again(docs: DataFrame, first: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The words of the lines in ``first``, read again from the texts; lines are matched by where they stand."""
    at = first.select(F.col("first.id").alias("i"), F.col("first.row").alias("r"), F.col("first.pos").alias("p"), "h1", "h2", "first", "start", "end")
    own = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("body"))
    if first.count() <= BROADCAST_ROWS:
        at = F.broadcast(at)
    else:  # only the texts that hold such a line are taken apart
        hold = at.select("i", "r").distinct()
        own = own.join(hold, own["doc"].cast("long").eqNullSafe(hold["i"]) & (row_key("body") == hold["r"]), "left_semi")
    line = _lines(own, "doc", "body")
    found = line.join(at, line["id"].eqNullSafe(at["i"]) & (line["row"] == at["r"]) & (line["pos"] == at["p"]))
    return found.select("h1", "h2", "first", "start", "end", words_of(F.col("line")).alias("words")).dropDuplicates(["h1", "h2"])


def _variants(cand: DataFrame) -> DataFrame:
    """``(v, whole, node)``: hashed variants.  A variant is what stands before and after a place.

    Leaving out word i leaves the words before it and those after it; a whole line is
    the same pair at each of its places.  Both come from running hashes from the
    start and from the end, so a line costs as much as it has words.  A line that shares
    only its first half with others (``start``) can differ from them only after it,
    and one that shares only its second half (``end``) only before it.
    """
    n = F.col("n")
    low = F.when(F.col("end"), F.lit(0)).otherwise(F.floor(F.size("words") / 2).cast("int"))
    high = F.when(F.col("start"), F.size("words")).otherwise(F.ceil(F.size("words") / 2).cast("int"))
    c = cand.select("node", F.size("words").alias("n"), low.alias("low"), high.alias("high"),
                    _running(F.transform("words", lambda w, i: F.xxhash64(w, i))).alias("p"),
                    _running(F.transform(F.reverse("words"), lambda w, i: F.xxhash64(i, w))).alias("s"))
    before, after = (lambda i: _upto("p", i)), (lambda i: _upto("s", n - i))  # the first i words; all from i on
    out = F.transform(F.sequence("low", F.least("high", n - 1)), lambda i: F.struct(F.xxhash64(before(i), after(i + 1)).alias("v"), F.lit(False).alias("whole")))
    whole = F.transform(F.sequence("low", "high"), lambda i: F.struct(F.xxhash64(before(i), after(i)).alias("v"), F.lit(True).alias("whole")))
    return c.select("node", F.explode(F.concat(out, whole)).alias("x")).select("x.v", "x.whole", "node")


def _running(hashes: Column) -> Column:
    """Running xor of hashes, in two steps: within pieces of ``PIECE``, and over the pieces.

    (Appending to one growing array would copy it for every word.)
    """
    def add(acc: Column, h: Column) -> Column:
        return F.concat(acc, F.array(F.element_at(acc, -1).bitwiseXOR(h)))
    zero = F.array(F.lit(0).cast("long"))

    def pieces(all_h: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(all_h) - 1) / PIECE).cast("int"))
        return F.transform(starts, lambda k: F.aggregate(F.slice(all_h, k * PIECE + 1, F.lit(PIECE)), zero, add))
    return let(hashes, lambda h: let(pieces(h), lambda own: F.struct(
        own.alias("own"), F.aggregate(own, zero, lambda acc, x: add(acc, F.element_at(x, -1))).alias("above"))))


def _upto(running: str, i: Column) -> Column:
    """Of a ``_running``, what the first ``i`` hashes make."""
    k = F.floor(i / PIECE).cast("int")
    return F.get(F.col(running)["above"], k).bitwiseXOR(F.coalesce(F.get(F.get(F.col(running)["own"], k), i % PIECE), F.lit(0).cast("long")))


def _near(lines: DataFrame, firsts: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The lines ``(h1, h2)`` that are one word away from an earlier line."""
    half = lines.filter("halves is not null").select("h1", F.posexplode("halves").alias("side", "half"))
    shared = half.groupBy("half").agg(F.min("h1").alias("a"), F.max("h1").alias("b")).filter("a <> b")
    maybe = (half.join(shared.select("half"), "half", "left_semi").groupBy("h1")
             .agg(F.max(F.col("side") % 2 == 0).alias("start"), F.max(F.col("side") % 2 == 1).alias("end")))
    first = cut(firsts.join(maybe, "h1").select("h1", "h2", "first", "start", "end"))
    # numbered in their order, so that the least number is the earliest line
    cand = cut(_words_again(docs, first, id_col, text_col).orderBy("first").withColumn("node", F.monotonically_increasing_id()))
    variant = cut(_variants(spread(cand.select("node", "words", "start", "end"))))
    part, full = F.when(~F.col("whole"), F.col("node")), F.when(F.col("whole"), F.col("node"))
    group = (variant.groupBy("v").agg(F.min(part).alias("part"), F.max(part).alias("last"), F.min(full).alias("full"))
             .filter("part < last or full is not null and part is not null"))
    # a line left without a word is near to lines left without the same place, and to a line that equals the rest
    to = F.when(F.col("whole"), F.col("part")).otherwise(F.least("part", "full"))
    pair = variant.join(group, "v").withColumn("to", to).filter("to < node").groupBy("node").agg(F.collect_set("to").alias("to"))
    # confirm the edit distance on the words themselves
    pair = pair.select("node", F.explode("to").alias("to"))
    other = cand.select(F.col("node").alias("to"), F.col("words").alias("other"))
    both = pair.join(cand, "node").join(other, "to")
    return both.filter(one_word_apart("words", "other")).select("h1", "h2").distinct()


def one_word_apart(a: str, b: str) -> Column:
    """Whether two word arrays are at an edit distance of at most 1: common start and end cover all but one word."""
    n, m = F.size(a), F.size(b)
    low, high = F.least(n, m), F.greatest(n, m)
    spot = F.sequence(F.lit(1), low)

    def run(at_a, at_b):
        miss = F.filter(spot, lambda i: F.get(a, at_a(i)) != F.get(b, at_b(i)))
        return F.coalesce(F.get(miss, F.lit(0)) - 1, low)
    start = run(lambda i: i - 1, lambda i: i - 1)
    end = run(lambda i: n - i, lambda i: m - i)
    return (high - low <= 1) & (start + end >= high - 1)


def duplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    min_words: int = MIN_WORDS, edit_words: int = EDIT_WORDS) -> DataFrame:
    """``(id, row, gone)``: for each text with duplicate lines, the positions (from 0) of those lines."""
    lines = cut(_hashed(_lines(docs, id_col, text_col), min_words, edit_words))
    firsts = lines.groupBy("h1", "h2").agg(F.min(_order()).alias("first"), F.count(F.lit(1)).alias("c"))
    near = cut(_near(lines, firsts, docs, id_col, text_col)).withColumn("near", F.lit(True))
    again = (firsts.join(near, ["h1", "h2"], "left").filter("c > 1 or near")
             .select("h1", "h2", "first", F.coalesce("near", F.lit(False)).alias("near")))
    gone = lines.select("id", "row", "pos", "h1", "h2").join(again, ["h1", "h2"]).filter(F.col("near") | (_order() != F.col("first")))
    return gone.groupBy("id", "row").agg(F.sort_array(F.collect_set("pos")).alias("gone"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_words: int = MIN_WORDS, edit_words: int = EDIT_WORDS) -> DataFrame:
    """``docs`` with each duplicate line removed from its text, and ``__gone``: how many that were.

    Lines end at ``\\n``; words are split at ASCII white space and compared
    exactly.  Lines of fewer than ``min_words`` words always stay.  Of equal
    lines the earliest stays, also within one document.  A line goes if an
    earlier one is within the bound, whether or not that one stays itself.

    A null text stays null and an empty one empty.  Null ids come after all
    others.  Rows equal in id and text count as one document, so both keep
    the same lines.  Other columns are passed on; an empty table stays empty.
    """
    gone = duplicate_lines(docs, id_col, text_col, min_words, edit_words).withColumnsRenamed(
        {"id": "__gone_id", "row": "__gone_row", "gone": "__gone_at"})
    body = docs.withColumn("__row", row_key(text_col))
    hit = body[id_col].cast("long").eqNullSafe(F.col("__gone_id")) & (F.col("__row") == F.col("__gone_row"))
    both = body.join(gone, hit, "left")
    piece = F.split(F.col(text_col), "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(piece) - 1), "__gone_at")
    rest = F.array_join(F.transform(stay, lambda i: F.get(piece, i)), "\n")
    names = [F.when(F.col("__gone_at").isNull(), F.col(text_col)).otherwise(rest).alias(c) if c == text_col
             else F.col(f"`{c}`") for c in docs.columns]
    return both.select(*names, F.coalesce(F.size("__gone_at"), F.lit(0)).alias("__gone"))


def keep_rest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without duplicate lines, however short; a document that had words and has none left is dropped."""
    out = dedup_lines(docs, id_col, text_col)
    return out.filter((F.col("__gone") == 0) | F.col(text_col).rlike(WORD)).select(*docs.columns)
