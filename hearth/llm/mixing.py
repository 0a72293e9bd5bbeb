"""Mixing sources to target weights by Efraimidis-Spirakis sampling (operator 2), native.

Each source gets a target in words.  Whole epochs come first: a source takes every
document as many times as its size fits its target.  The rest of the target is filled by
weighted sampling without replacement: every document draws an exponential
key, scaled by its quality weight; in the order of the keys documents are
taken until their words fill the rest.  The document that crosses it is
taken if that comes nearer.

The order within a source is cut into buckets of key ranges that hold about equal shares of its
documents, whatever their weights.  Running sums go over the buckets' totals first and then
over the documents of a bucket, so no task ever sorts a whole source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearth.llm.common import WORD, cut, row_key, text_or_empty

#: Key ranges per source; a bucket's documents are sorted in one task.
BUCKETS = 4096
#: Quality weights of documents.
WEIGHTS = (1.0, 0.25)


def word_count(text: Column) -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def plausible_words(text: Column, size: Column) -> Column:
    """A quality weight: 1 where words have 3 to 10 characters on average, else 0.25."""
    n = F.length(text_or_empty(text))
    return F.when((n >= size * 4) & (n <= size * 11), F.lit(WEIGHTS[0])).otherwise(F.lit(WEIGHTS[1]))


def uniform(id_col: Column, seed: str) -> Column:
    """A number in (0, 1) fixed by the id and the seed: 48 bits of an MD5 digest."""
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(id_col.cast("string"), F.lit("")))), 1, 12), 16, 10)
    return (bits.cast("double") + 0.5) / float(1 << 48)


def bucket_of(key: Column, buckets: int) -> Column:
    """The key's bucket, in the order of the keys.

    Keys of weight w are below k with probability 1 - e^-wk.  The mean of that over all weights
    spreads keys over (0, 1) so that a bucket takes at most ``len(WEIGHTS) / buckets`` of the
    documents of any one weight, to be expected, the last bucket too.
    """
    below = sum(((1 - F.exp(-w * key)) for w in WEIGHTS), F.lit(0.0)) / len(WEIGHTS)
    return F.floor(below * buckets).cast("int")


def targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """``(source, source_size)`` -> also ``target``.

    Sources in code point order, null last, weigh ``weights``, repeating.  They share
    ``share`` times all words by weight, but no more than ``most`` times a source's own;
    what lies above is shared again by weight.  That ends at one level: sorted by size
    against weight, the sources below it get their most, the others level times weight.
    One row per source passes through one task.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights)))
    s = sizes.withColumn("w", weight).withColumn("most", F.col("source_size") * float(most))
    order = Window.orderBy(F.col("most") / F.col("w"), F.col("source").isNull(), "source")
    every = Window.partitionBy()
    s = s.withColumn("below", F.coalesce(F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    s = s.withColumn("above", F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing)))
    s = s.withColumn("level", (F.sum("source_size").over(every) * float(share) - F.col("below")) / F.col("above"))
    level = F.min(F.when(F.col("level") * F.col("w") <= F.col("most"), F.struct(F.col("most") / F.col("w"), "level"))).over(every)["level"]
    return (s.withColumn("level", level)
            .select("source", "source_size", F.least("most", F.coalesce(F.col("level") * F.col("w"), F.col("most"))).alias("target")))


def mix(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0,
        id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", seed: str = "mix",
        buckets: int = BUCKETS) -> DataFrame:
    """One row per document: ``id, row, source, size, source_size, target, taken``.

    ``size`` counts the runs of characters other than ASCII white space; ``taken`` is how many
    words the mix takes of the document, repeats counted.  The same input gives
    the same result.  Null and empty texts have size 0 and take 0; a source
    of size 0 has target 0; null sources form one source.  Rows sharing an id draw
    the same number and go by the text's hash; equal rows count each.  An empty table gives
    no rows.
    """
    base = docs.select(F.col(id_col).cast("long").alias("id"), row_key(text_col).alias("row"), F.col(source_col).cast("string").alias("source"),
                       word_count(F.col(text_col)).alias("size"), F.col(text_col).alias("t"))
    keyed = base.select("id", "row", "source", "size",
                        (-F.log(uniform(F.col("id"), seed)) / plausible_words(F.col("t"), F.col("size"))).alias("key"))
    keyed = cut(keyed.withColumn("bucket", bucket_of(F.col("key"), buckets)))
    totals = keyed.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    sizes = totals.groupBy("source").agg(F.sum("words").alias("source_size"))
    goal = targets(sizes, weights, share, most)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    goal = goal.withColumn("epochs", epochs).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    run = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.withColumn("before", F.coalesce(F.sum("words").over(run), F.lit(0)))
    same = before["source"].eqNullSafe(goal["source"])
    before = before.join(goal, same).select(before["source"].alias("s"), F.col("bucket").alias("b"), "before", "source_size", "target", "epochs", "rest")
    both = keyed.join(before, keyed["source"].eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    inside = Window.partitionBy("source", "bucket").orderBy("key", F.col("id").isNull(), "id", "row").rowsBetween(Window.unboundedPreceding, 0)
    after = F.col("before") + F.sum("size").over(inside)
    extra = (after - F.col("size") / 2) < F.col("rest")
    return both.select("id", "row", "source", "size", "source_size", "target",
                       (F.col("size") * (F.col("epochs") + extra.cast("int"))).alias("taken"))


def take(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **how) -> DataFrame:
    """The documents that the mix takes: ``docs`` with ``copies`` (how often) and ``taken`` (their words)."""
    mixed = mix(docs, id_col=id_col, source_col=source_col, text_col=text_col, **how).filter("taken > 0")
    plan = (mixed.groupBy("id", "row", "source").agg(F.max(F.col("taken") / F.col("size")).cast("int").alias("n"), F.max("taken").alias("w"))
            .select(F.col("id").alias("__id"), F.col("row").alias("__row"), F.col("source").alias("__source"), F.col("n").alias("__n"), F.col("w").alias("__w")))
    hit = (docs[id_col].cast("long").eqNullSafe(F.col("__id")) & (row_key(docs[text_col]) == F.col("__row"))
           & docs[source_col].cast("string").eqNullSafe(F.col("__source")))
    own = [F.col(f"`{c}`") for c in docs.columns if c not in ("copies", "taken")]
    return docs.join(plan, hit).select(*own, F.col("__n").alias("copies"), F.col("__w").alias("taken"))
