"""Hard negatives by BOND vertical scans (operator 13).

Vectors are stored in blocks of one label, each dimension a column with its least and
largest value.  An anchor reads a block's columns in the order of its own components'
magnitude, largest first, and keeps a partial score for each candidate.  What the columns
not read yet can still add lies between two sums of minima and maxima, so every candidate
has a range for its score; those whose range cannot reach a result leave the
candidate bitmap, and the rest end up with exact scores.  Scores are whole numbers.

Two rounds meet the anchors with the blocks, as tiles of one pack of anchors and one
shard of blocks.  The first looks for each anchor's best rows of its own label (its
positives).  Their scores set the windows that the second round's rows of other
labels must fall into.  A task holds one tile at a time; a tile returns
each anchor's best rows in it, and a ranked window over those picks the results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearth.llm.common import cut
from hearth.session import ship_package

#: Rows of a block, and anchors of a pack.
BLOCK, PACK = 4096, 512
#: Columns read between two looks at the bitmap, as a share of all.
STEPS = 8
_BLOCKS = "label long, n int, dim int, ids binary, width int, cols binary, low array<long>, high array<long>"
_FOUND = "akey long, pos int, id long, score long"


def usable(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
           label: Column | None = None, component=lambda x: F.floor(x * 256)) -> DataFrame:
    """``(id, label, vec)``: the rows that take part, their components made whole numbers by ``component`` (given a double).

    Rows with a null id, label or vector, or with a null, NaN or infinite component, take no part.
    """
    x = F.col(vec_col).cast("array<double>")
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    fine = rows.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vec_col).isNotNull()).filter(~odd)
    return fine.select(F.col(id_col).cast("long").alias("id"), (F.col(label_col) if label is None else label).cast("long").alias("label"),
                       F.transform(x, lambda v: component(v).cast("long")).alias("vec"))


def _block(label: int, ids: list, vecs: list) -> pa.RecordBatch:
    dim = max(map(len, vecs))
    cols = np.zeros((dim, len(vecs)), np.int64)
    for i, v in enumerate(vecs):
        cols[:len(v), i] = v
    low, high = cols.min(axis=1, initial=0), cols.max(axis=1, initial=0)
    kind = next(t for t in (np.int16, np.int32, np.int64) if dim == 0 or (low.min() >= np.iinfo(t).min and high.max() <= np.iinfo(t).max))
    return pa.RecordBatch.from_arrays(
        [pa.array([label], pa.int64()), pa.array([len(ids)], pa.int32()), pa.array([dim], pa.int32()), pa.array([np.array(ids, np.int64).tobytes()]),
         pa.array([np.dtype(kind).itemsize], pa.int32()), pa.array([cols.astype(kind).tobytes()]),
         pa.array([low], pa.list_(pa.int64())), pa.array([high], pa.list_(pa.int64()))],
        names=["label", "n", "dim", "ids", "width", "cols", "low", "high"])


def _blocks(rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label, ids, vecs = None, [], []
        for batch in batches:
            vec = batch.column("vec")
            flat, edge = vec.values.to_numpy(), vec.offsets.to_numpy()
            for i, (row, own) in enumerate(zip(batch.column("id").to_pylist(), batch.column("label").to_pylist())):
                if ids and (own != label or len(ids) == rows):
                    yield _block(label, ids, vecs)
                    ids, vecs = [], []
                label = own
                ids.append(row)
                vecs.append(flat[edge[i]:edge[i + 1]].copy())
        if ids:
            yield _block(label, ids, vecs)
    return run


def blocks(vectors: DataFrame, rows: int = BLOCK) -> DataFrame:
    """Vectors as blocks of at most ``rows`` rows of one label, cut out of ranges of label and row hash.

    A hot label is spread over many ranges; rows that repeat id, label and vector count once.
    """
    once = vectors.dropDuplicates(["id", "label", "vec"])
    ranges = max(1, math.ceil(vectors.count() / rows))
    mixed = once.repartitionByRange(ranges, "label", F.xxhash64("id", "vec")).sortWithinPartitions("label")
    return mixed.mapInArrow(_blocks(rows), _BLOCKS)


def _unpacked(block: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    cols = np.frombuffer(block["cols"], f"<i{block['width']}").reshape(block["dim"], block["n"])
    return np.frombuffer(block["ids"], np.int64), cols, np.array(block["low"], np.int64), np.array(block["high"], np.int64)


def scan(anchor: np.ndarray, cols: np.ndarray, low: np.ndarray, high: np.ndarray, stay) -> tuple[np.ndarray, np.ndarray]:
    """``(places, scores)`` of the candidates left after all columns, by the vertical scan.

    ``stay(least, most)`` gets the candidates' score ranges and says which of them can still matter.
    Dimensions that either side lacks add nothing.
    """
    dim = min(anchor.size, cols.shape[0])
    a = anchor[:dim]
    big = int(np.abs(a).max(initial=0)) * int(max(high[:dim].max(initial=0), -low[:dim].min(initial=0))) * dim
    # sums of whole numbers are exact in doubles up to 2^53; beyond, Python's own numbers
    kind = np.float64 if big < 2 ** 53 else object
    a = a.astype(kind)
    order = np.argsort(-np.abs(a), kind="stable")
    ends = np.stack([a * low[:dim].astype(kind), a * high[:dim].astype(kind)])[:, order]
    rest = [np.append(np.cumsum(x[::-1])[::-1], 0) for x in (ends.min(axis=0), ends.max(axis=0))]  # rest[j]: of all columns from the j-th on
    places, part = np.arange(cols.shape[1]), np.zeros(cols.shape[1], kind)
    step = max(1, -(-dim // STEPS))
    for at in range(0, max(dim, 1), step):
        now = order[at:at + step]
        read = cols[now] if places.size == cols.shape[1] else cols[np.ix_(now, places)]
        part = part + a[now] @ read.astype(kind)
        done = min(at + step, dim)
        keep = stay(part + rest[0][done], part + rest[1][done])
        if not keep.all():
            places, part = places[keep], part[keep]
            if not places.size:
                break
    return places, part


def _kth(x: np.ndarray, k: int):
    return x[np.argpartition(x, x.size - k)[x.size - k]] if x.dtype != object else sorted(x)[-k]


def _best(k: int):
    """The candidates that can be among the ``k`` best."""
    def stay(least, most):
        return most >= _kth(least, k) if least.size > k else np.ones(least.size, bool)
    return stay


def _within(windows: set[tuple[int, int]], k: int):
    """The candidates that can be among the ``k`` best of some window."""
    def stay(least, most):
        keep = np.zeros(least.size, bool)
        for lo, hi in windows:
            can = (most >= lo) & (least <= hi)
            sure = least[(least >= lo) & (most <= hi)]
            if sure.size > k:
                can &= most >= _kth(sure, k)
            keep |= can
        return keep
    return stay


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """The whole numbers s with ``low * score <= 100 * s <= high * score``, as least and largest (none if least > largest)."""
    return -(-low * score // 100), high * score // 100


def _top(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores) if scores.dtype != object else (ids, np.array([-s for s in scores], object)))[:k]


def _tile(find):
    """A tile's results: ``find(anchor, label, positives, block)`` gives ``(pos, ids, scores)`` of an anchor in a block."""
    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            own, held = row["label"], _unpacked(row)
            for group in right.column("anchors").to_pylist():
                for x in group:
                    for pos, ids, scores in find(x, own, held):
                        out.append((x["akey"], pos, ids, scores))
        n = [len(o[2]) for o in out]
        flat = lambda i: np.concatenate([o[i] for o in out]) if out else []
        return pa.table({"akey": pa.array(np.repeat([o[0] for o in out], n) if out else [], pa.int64()), "pos": pa.array(np.repeat([o[1] for o in out], n) if out else [], pa.int32()),
                         "id": pa.array(flat(2), pa.int64()), "score": pa.array([int(s) for s in flat(3)], pa.int64())})
    return run


def _positives(k: int):
    def find(x, label, held):
        if x["label"] != label:
            return
        ids, cols, low, high = held
        # the anchor itself is among its best rows: look for one more
        places, scores = scan(np.array(x["vec"], np.int64), cols, low, high, _best(k + int((ids == x["id"]).sum())))
        other = ids[places] != x["id"]
        places, scores = places[other], scores[other]
        top = _top(ids[places], scores, k)
        if top.size:
            yield 0, ids[places][top], scores[top]
    return find


def _negatives(k: int, least: int, most: int):
    def find(x, label, held):
        if x["label"] == label:
            return
        spans = [window(s, least, most) for s in x["scores"]]
        spans = {w for w in spans if w[0] <= w[1]}
        if not spans:
            return
        ids, cols, low, high = held
        places, scores = scan(np.array(x["vec"], np.int64), cols, low, high, _within(spans, k))
        for pos, s in enumerate(x["scores"]):
            lo, hi = window(s, least, most)
            fit = (scores >= lo) & (scores <= hi)
            if fit.any():
                at, got = places[fit.astype(bool)], scores[fit.astype(bool)]
                top = _top(ids[at], got, k)
                yield pos, ids[at][top], got[top]
    return find


def _meet(stored: DataFrame, shards: int, anchors: DataFrame, packs: int, find) -> DataFrame:
    """Every pack of anchors with every shard of blocks."""
    side = stored.withColumn("pack", F.explode(F.sequence(F.lit(0), F.lit(packs - 1))))
    pack = anchors.groupBy(F.pmod(F.xxhash64("akey"), F.lit(packs)).cast("int").alias("pack")).agg(F.collect_list(F.struct(*anchors.columns)).alias("anchors"))
    other = pack.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    return side.groupBy("shard", "pack").cogroup(other.groupBy("shard", "pack")).applyInArrow(_tile(find), _FOUND)


def _ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``vectors`` are ``usable`` rows.  An anchor's positives are its first ``positives`` other rows of its label by
    inner product, largest first, ties by id.  For each of them the first
    ``negatives`` rows of other labels follow whose score lies between ``low`` and ``high`` percent of the
    positive's.  Fewer are returned where there are fewer; an anchor alone in its label, or a positive
    that no row falls under, returns nothing.  "Other" goes by id; rows that
    repeat id, label and vector count once, and rows that share an id but not the rest are rows of their
    own.  Of vectors of different lengths the longer one's further components add nothing; an
    empty vector scores 0.  Scores beyond 64 bits raise an error.  An empty table gives no rows.
    """
    ship_package(vectors.sparkSession)
    stored = cut(blocks(vectors))
    shards = max(1, stored.count())
    stored = stored.withColumn("shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)).cast("int"))
    anchors = cut(vectors.filter(is_anchor).dropDuplicates(["id", "label", "vec"]).withColumn("akey", F.monotonically_increasing_id()))
    packs = max(1, math.ceil(anchors.count() / PACK))
    near = _ranked(_meet(stored, shards, anchors, packs, _positives(positives)), ["akey"], positives)
    held = near.groupBy("akey").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("p"))
    asked = cut(anchors.join(held, "akey").select("akey", "id", "label", "vec", F.col("p.id").alias("ids"), F.col("p.score").alias("scores")))
    far = _ranked(_meet(stored, shards, asked.drop("ids"), packs, _negatives(negatives, low, high)), ["akey", "pos"], negatives)
    named = asked.select("akey", F.col("id").alias("anchor_id"), F.posexplode(F.arrays_zip("ids", "scores")).alias("pos", "p"))
    return far.join(named, ["akey", "pos"]).select("anchor_id", F.col("p.ids").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
                                                   F.col("id").alias("negative_id"), F.col("p.scores").alias("positive_score"), F.col("score").alias("negative_score"))
