"""Near duplicates by b-bit MinHash (operator 10).

One pass over the texts makes, per document, the digest of its shingle set,
the band keys of its full minima and a packed signature of the minima's low
bits.  Documents with equal sets collapse to one class first, so exact copies never
meet in pairs.  Classes that share a band are linked to the band's first
class; where that leaves a band's classes in different components, those
outside its largest component meet the others as well.  Every pair passes
the similarity estimated from the packed bits (native bit counts, corrected for
chance agreement) and is then confirmed on the full sets.  For the second kind of pair
a longer signature of single bits is made first, so that in a large group of
texts just below the threshold few pairs leave the join; within it they are
still compared bit by bit, once for each outsider and band.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearth.llm import hashing
from hearth.llm.common import WORD, cut, row_key, text_or_empty
from hearth.llm.graph import components
from hearth.session import ship_package

BANDS, ROWS, BITS = 32, 4, 2
N = BANDS * ROWS
#: Pairs whose corrected estimate lies below this are dropped unseen: at a true
#: similarity of 0.75 the estimate's standard error is 0.046, so that is over five of them.
LEAST_ESTIMATE = 0.5
#: The longer signature: single bits, and the estimate (again five standard errors below 0.75) that passes.
FINE, LEAST_FINE = 2048, 0.675
_rng = np.random.default_rng(77)
_A = (_rng.integers(1, 2**63, N, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_C = _rng.integers(1, 2**63, N, dtype=np.uint64)
_FA = (_rng.integers(1, 2**63, FINE, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_FC = _rng.integers(1, 2**63, FINE, dtype=np.uint64)
_BAND = _rng.integers(1, 2**63, BANDS, dtype=np.uint64)


def minima(sh: np.ndarray, mul: np.ndarray = _A, add: np.ndarray = _C) -> np.ndarray:
    out, rows = np.full(mul.size, np.iinfo(np.uint64).max, np.uint64), max(1, (1 << 19) // mul.size)
    for at in range(0, sh.size, rows):
        np.minimum(out, (sh[at:at + rows, None] * mul + add).min(axis=0), out=out)
    return out


def _packed(m: np.ndarray, bits: int) -> np.ndarray:
    low = (m & np.uint64((1 << bits) - 1)).reshape(-1, 64 // bits)
    return (low << (np.arange(64 // bits, dtype=np.uint64) * np.uint64(bits))).sum(axis=1, dtype=np.uint64).view(np.int64)


def fine_signature(sh: np.ndarray) -> np.ndarray:
    return _packed(hashing.mix(minima(sh, _FA, _FC)), 1)


def signature(sh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Band keys of the full minima, and their low bits packed into 64-bit words."""
    m = hashing.mix(minima(sh))
    key = _BAND.copy()
    for j in range(ROWS):
        key = hashing.mix(key + m.reshape(BANDS, ROWS)[:, j])
    return key.view(np.int64), _packed(m, BITS)


def _sign(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows = []
                for t in part.column("__t"):
                    sh = hashing.shingles(t.as_py().encode().lower(), k)
                    rows.append((sh.size, *hashing.set_digest(sh), *(signature(sh) if sh.size else (None, None))))
                n, c1, c2, keys, packed = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column("__id"), part.column("__key"), pa.array(n, pa.int64()), pa.array(c1, pa.int64()),
                     pa.array(c2, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(packed, pa.list_(pa.int64()))],
                    names=["__id", "__key", "__n", "__c1", "__c2", "__keys", "__sig"])
    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sh = [hashing.shingles(t.as_py().encode().lower(), k) for t in part.column("__t")]
                c1, c2 = zip(*map(hashing.set_digest, sh))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c1, pa.int64()), pa.array(c2, pa.int64()),
                     pa.array([x.view(np.int64) for x in sh], pa.list_(pa.int64()))],
                    names=["__c1", "__c2", "__set"])
    return run


def _fine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            sig = [fine_signature(x.values.to_numpy().view(np.uint64)) for x in part.column("__set")]
            yield pa.RecordBatch.from_arrays([part.column("__node"), pa.array(sig, pa.list_(pa.int64()))], names=["__node", "__fine"])


def estimate(a: Column, b: Column, bits: int = BITS, n: int = N) -> Column:
    """Similarity from two packed signatures: agreeing groups of bits, corrected for chance."""
    odd, differ = int("01" * 32, 2), F.lit(0)
    for i in range(n * bits // 64):
        x = F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))
        differ = differ + F.bit_count(x if bits == 1 else x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(odd)))
    chance = 2.0 ** -bits
    return (1 - differ / F.lit(float(n)) - chance) / (1 - chance)


def _close(a: str, b: str) -> Column:
    """Necessary conditions for a link, from sizes and packed bits alone."""
    small, large = F.least(f"{a}.__n", f"{b}.__n"), F.greatest(f"{a}.__n", f"{b}.__n")
    return (small * 100 >= large * 75) & (estimate(F.col(f"{a}.__sig"), F.col(f"{b}.__sig")) >= LEAST_ESTIMATE)


def _full_sets(nodes: DataFrame, classes: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """``(node, set)``: the whole shingle sets of classes, from one text each."""
    reps = classes.join(nodes, "__node").select("__node", "__c1", "__c2", "__rid", "__rkey")
    # the id, read null-safely, with the text's hash; the digest guards against clashes
    found = (texts.join(reps, texts["__id"].eqNullSafe(reps["__rid"]) & (texts["__key"] == reps["__rkey"]), "left_semi")
             .select("__t").mapInArrow(_sets(k), "__c1 long, __c2 long, __set array<long>"))
    return cut(found.join(reps.select("__node", "__c1", "__c2"), ["__c1", "__c2"])
               .dropDuplicates(["__node"]).select("__node", "__set"))


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full shingle sets overlap enough."""
    a, b = (sets.select(F.col("__node").alias(x), F.col("__set").alias(f"__{x}")) for x in "ab")
    both = F.size(F.array_intersect("__a", "__b"))
    return (pairs.join(a, "a").join(b, "b")
            .filter(both * 100 >= (F.size("__a") + F.size("__b") - both) * 75).select("a", "b"))


def _outsiders(member: DataFrame, found: DataFrame, slim: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs within a band but across components, not tried yet, that could be links."""
    rooted = (member.filter("__size > 2").join(found.withColumnRenamed("node", "__node"), "__node", "left")
              .withColumn("root", F.coalesce("root", "__node")))
    per = rooted.groupBy("__band", "root").agg(F.count(F.lit(1)).alias("c"))
    main = per.groupBy("__band").agg(F.max(F.struct("c", "root")).alias("m"), F.count(F.lit(1)).alias("roots"))
    split = cut(rooted.join(main.filter("roots > 1").select("__band", F.col("m.root").alias("__main")), "__band"))
    fine = sets.join(split.select("__node").distinct(), "__node", "left_semi").mapInArrow(_fine, "__node long, __fine array<long>")
    split = cut(split.join(slim.join(fine, "__node"), "__node"))
    out, rest = split.filter("root <> __main").alias("l"), split.alias("r")
    fits = estimate(F.col("l.__fine"), F.col("r.__fine"), 1, FINE) >= LEAST_FINE
    # a pair meets in each band it shares; it leaves the join from the first of them
    sooner = F.arrays_overlap(F.slice("l.__keys", F.lit(1), F.col("l.__nth")), F.slice("r.__keys", F.lit(1), F.col("l.__nth")))
    rule = ((F.col("l.__band") == F.col("r.__band")) & (F.col("l.root") != F.col("r.root"))
            & ((F.col("r.root") == F.col("r.__main")) | (F.col("l.__node") < F.col("r.__node")))
            & (F.col("l.__node") != F.col("l.__first")) & (F.col("r.__node") != F.col("r.__first"))
            & _close("l", "r") & fits & ~sooner)
    return cut(out.join(rest, rule).select(F.least("l.__node", "r.__node").alias("a"), F.greatest("l.__node", "r.__node").alias("b")).distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5) -> DataFrame:
    """``docs`` -> one row each: id, ``__key`` (hash of the text), ``n_shingles``, ``component_id``, ``kept``.

    Words are split at ASCII white space and A-Z is lower-cased; a document's
    set is its distinct ``k``-word shingles, or the whole sequence when it has
    fewer words.  Two documents link at a Jaccard similarity of 0.75 or more.

    Null and empty texts have no shingles and link with nothing, each its own
    component.  A null id is never the smallest: its component takes the
    smallest other id, and a component of null ids alone has a null
    ``component_id`` and is kept.  Repeated rows give repeated results.  An
    empty table gives an empty result; further columns are ignored.
    """
    ship_package(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("__id"), row_key(text_col).alias("__key"),
                        text_or_empty(text_col).alias("__t"))
    signed = cut(texts.mapInArrow(_sign(k), "__id long, __key long, __n long, __c1 long, __c2 long, "
                                                    "__keys array<long>, __sig array<long>"))
    # equal sets are one class; its number is fixed by writing it
    classes = cut(signed.filter("__n > 0").groupBy("__c1", "__c2")
                  .agg(F.min(F.struct(F.col("__id").isNull().alias("z"), F.col("__id").alias("i"),
                                      F.col("__key").alias("k"))).alias("r"),
                       F.first("__n").alias("__n"), F.first("__keys").alias("__keys"), F.first("__sig").alias("__sig"))
                  .select(F.monotonically_increasing_id().alias("__node"), "__c1", "__c2",
                          F.col("r.i").alias("__rid"), F.col("r.k").alias("__rkey"), "__n", "__keys", "__sig"))
    member = classes.select("__node", F.posexplode("__keys").alias("__nth", "__band"))
    band = member.groupBy("__band").agg(F.min("__node").alias("__first"), F.count(F.lit(1)).alias("__size")).filter("__size > 1")
    member = cut(member.join(band, "__band"))
    slim = classes.select("__node", "__n", "__sig", "__keys")
    left, right = slim.drop("__keys").alias("l"), slim.drop("__keys").alias("r")
    star = member.filter("__node <> __first").select(F.col("__first").alias("a"), F.col("__node").alias("b")).distinct()
    star = cut(star.join(left, F.col("a") == F.col("l.__node")).join(right, F.col("b") == F.col("r.__node"))
               .filter(_close("l", "r")).select("a", "b"))
    sets = _full_sets(member.select("__node").distinct(), classes, texts, k)
    links = cut(_confirmed(star, sets))
    found = cut(components(links))
    # bands that still hold several components: those outside the largest one meet the rest
    more = cut(_confirmed(_outsiders(member, found, slim, sets), sets))
    if not more.isEmpty():
        found = cut(components(links.unionByName(more)))
    ids = classes.select("__node", "__c1", "__c2", "__rid").join(found.withColumnRenamed("node", "__node"), "__node", "left")
    ids = ids.withColumn("root", F.coalesce("root", "__node"))
    least = ids.groupBy("root").agg(F.min("__rid").alias("component_id"))
    named = ids.join(least, "root").select("__c1", "__c2", "root", "component_id")
    out = signed.select("__id", "__key", "__n", "__c1", "__c2").join(named, ["__c1", "__c2"], "left")
    own = F.when(F.col("__n") > 0, F.col("component_id")).otherwise(F.col("__id"))
    return out.select(F.col("__id").alias(id_col), "__key", F.col("__n").alias("n_shingles"),
                      own.alias("component_id"), own.eqNullSafe(F.col("__id")).alias("kept"), F.col("root").alias("__root"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5) -> DataFrame:
    """The rows of ``docs`` with one of each group of near duplicates: that with the smallest id.

    Rows without words stay.  Rows that repeat the same id and text are one
    group, of which one row stays; of rows that share the smallest id with
    different texts, that with the smallest text hash stays.
    """
    rows = near_duplicates(docs, id_col, text_col, k).filter("n_shingles > 0")
    copies = rows.groupBy("__root", id_col, "__key").agg(F.count(F.lit(1)).alias("c"))
    best = cut(copies.groupBy("__root")
               .agg(F.min(F.struct(F.col(id_col).isNull().alias("z"), F.col(id_col).alias("i"),
                                   F.col("__key").alias("k"), "c")).alias("r"))
               .select(F.col("r.i").alias("__best_id"), F.col("r.k").alias("__best_key"), F.col("r.c").alias("__copies")))
    marked = docs.withColumn("__row", row_key(text_col))
    filled = marked.filter(text_or_empty(text_col).rlike(WORD))
    stay = filled.join(best, filled[id_col].cast("long").eqNullSafe(F.col("__best_id"))
                       & (F.col("__row") == F.col("__best_key")))
    again = Window.partitionBy(id_col, "__row").orderBy(F.lit(1))
    once = (stay.filter("__copies > 1").withColumn("__nth", F.row_number().over(again)).filter("__nth = 1"))
    rest = docs.filter(~text_or_empty(text_col).rlike(WORD))
    names = [F.col(f"`{c}`") for c in docs.columns]
    return (stay.filter("__copies = 1").select(names).unionByName(once.select(names)).unionByName(rest))
