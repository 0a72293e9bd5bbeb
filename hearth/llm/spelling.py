"""Spelling variants by permuterm rotations (operator 11).

A word is closed by a terminator and rotated: the rotation that starts behind its
i-th letter ends in that letter, so all words that differ in the i-th letter alone
share the rotation up to its last letter, and so does, as a whole rotation, the
word without that letter.  Replaced, inserted and deleted letters are thus one prefix
range each, skipping the edited letter.

Rotations are sorted by that prefix (a window per prefix) and each range is scanned
once.  Words are distinct, so a range holds at most one word for each letter of the alphabet
and one whole rotation: no range grows with the corpus.  No pairs are written: of its
ranges a word takes how many others they hold and the best of those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearth.llm.common import cut, text_or_empty

#: A maximal run of letters.
RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Closes a word; not a letter of ``RUN``.
END = "$"


def lower(text: Column) -> Column:
    """A-Z in lower case; every other letter stays as it is."""
    return F.translate(text, UPPER, LOWER)


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, run)``: every occurrence of a run of letters, lower-cased.  A null text has none."""
    return docs.select(F.col(id_col).alias("id"), F.explode(F.regexp_extract_all(lower(text_or_empty(text_col)), F.lit(RUN), F.lit(0))).alias("run"))


def misspelt(run: str = "run", row_id: str = "id", every: int = 199) -> Column:
    """The run without its letter ``h % length`` where ``every`` divides h, the CRC-32 of ``<id>:<run>`` (a null id is empty)."""
    h = F.crc32(F.concat(F.coalesce(F.col(row_id).cast("string"), F.lit("")), F.lit(":"), F.col(run)))
    at = F.pmod(h, F.length(run)).cast("int")
    gone = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % every == 0, gone).otherwise(F.col(run))


def vocabulary(words: DataFrame, min_length: int = 6, min_count: int = 5) -> DataFrame:
    """Occurrences ``(word)`` -> ``(word, n)`` of the long and frequent enough ones; counts are partial before the shuffle."""
    return (words.filter(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") >= min_count))


def rotations(words: DataFrame) -> DataFrame:
    """``(prefix, whole, once, rank)``: each word's rotations, and the same without their last letter.

    ``whole`` is false where the last letter is skipped.  Dropping either of two equal neighbours
    leaves the same word, so only the first of such a run counts as a deletion (``once``).
    ``rank`` orders words by count, largest first, then by code points.
    """
    w, i = F.col("word"), F.col("i")
    rank = F.struct((-F.col("n")).alias("neg"), w.alias("word"))
    all_i = words.select("word", rank.alias("rank"), F.explode(F.sequence(F.lit(0), F.length("word"))).alias("i"))
    front = F.substring(w, F.lit(1), i)
    letter, before = F.substring(w, i + 1, F.lit(1)), F.when(i > 0, F.substring(w, i, F.lit(1)))
    whole = all_i.select(F.concat(F.substring(w, i + 1, F.length(w)), F.lit(END), front).alias("prefix"), F.lit(True).alias("whole"),
                         F.lit(False).alias("once"), "rank")
    skip = all_i.filter(i < F.length(w)).select(
        F.concat(F.substring(w, i + 2, F.length(w)), F.lit(END), front).alias("prefix"), F.lit(False).alias("whole"),
        (~letter.eqNullSafe(before)).alias("once"), "rank")
    return whole.unionByName(skip)


def near(words: DataFrame) -> DataFrame:
    """``(word, n, near_word, near_n, n_near)`` of words that have a near word: the best one, and how many there are.

    Near are two words one inserted, deleted or replaced code point apart; the best has the
    largest ``n``, then comes first in code-point order.
    """
    span = Window.partitionBy("prefix")
    scan = span.orderBy("whole", "rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    part, longer = ~F.col("whole"), F.col("once")
    ranged = rotations(words).select(
        "*", F.count(F.when(part, 1)).over(span).alias("parts"), F.count(F.when(longer, 1)).over(span).alias("longer"),
        F.nth_value("rank", 1).over(scan).alias("first"), F.nth_value("rank", 2).over(scan).alias("second"),
        F.max(F.when(F.col("whole"), F.col("rank"))).over(span).alias("shorter"),
        F.min(F.when(longer, F.col("rank"))).over(span).alias("best_longer"))
    # in a range the skipped rotations come first, best first
    swapped = F.when(F.col("parts") > 1, F.when(F.col("rank") == F.col("first"), F.col("second")).otherwise(F.col("first")))
    shorter = F.when(longer, F.col("shorter"))
    best = F.when(part, F.least(swapped, shorter)).otherwise(F.col("best_longer"))
    many = F.when(part, F.col("parts") - 1 + shorter.isNotNull().cast("long")).otherwise(F.col("longer"))
    return (ranged.select("rank", many.alias("many"), best.alias("best")).filter("many > 0")
            .groupBy(F.col("rank.word").alias("word"), (-F.col("rank.neg")).alias("n"))
            .agg(F.min("best").alias("best"), F.sum("many").alias("n_near"))
            .select("word", "n", F.col("best.word").alias("near_word"), (-F.col("best.neg")).alias("near_n"), "n_near"))


def roots(links: DataFrame) -> DataFrame:
    """``(word, form)`` -> ``(word, root)``: the last word that the forms lead to.

    Each round doubles the length of the steps.  A form's count is a multiple of its word's,
    so chains are as short as the logarithm of the largest count, and rounds as that one's.
    """
    at = cut(links.select("word", F.col("form").alias("root")))
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = cut(at.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        at = step.select("word", "root")
        if step.filter("moved").isEmpty():
            return at


def group(words: DataFrame, ratio: int = 5) -> DataFrame:
    """``(word, n)`` -> one row per word: ``word, form, root, n, n_near, form_n``.

    A word's form is its best near word if that is at least ``ratio`` times as frequent, else null;
    ``root`` is where the forms lead, the word itself without one.  ``ratio`` must be above 1.
    Words must be distinct and not null; an empty table gives no rows.
    """
    if ratio <= 1:
        raise ValueError("ratio must be above 1, or forms could lead in circles")
    words = cut(words.select("word", "n"))
    found = cut(near(words).withColumn("is_form", F.col("near_n") >= ratio * F.col("n"))
                .select("word", "n_near", F.when(F.col("is_form"), F.col("near_word")).alias("form"), F.when(F.col("is_form"), F.col("near_n")).alias("form_n")))
    last = roots(found.filter("form is not null"))
    return (words.join(found, "word", "left").join(last, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"))


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spelling variants among the words of whole texts: ``word, form, root, n, n_near, form_n``.

    Words are the runs of letters in lower case, some of them misspelt on purpose
    (``misspelt``).  Null and empty texts have none, a run of any length is one word, repeated
    rows count again, and other columns are not read.
    """
    return group(vocabulary(runs(docs, id_col, text_col).select(misspelt().alias("word"))))
