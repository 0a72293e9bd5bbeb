"""Benchmark decontamination by greedy string tiling (operator 8).

Benchmark items are the stated query set: they are taken in blocks of bounded
size, each block is sent to the tasks, and every document meets every block
once, in a narrow pass without a shuffle of texts.

Within a document the runs of ``MIN_TILE`` words it shares with an item (the
seeds) are joined through a hash table of the block.  An item with enough seeds
is tiled: the longest match between unmarked words is marked, again and
again, found by Karp-Rabin hashes rolled over both sides at a falling match
length.  Matches may stand in any order in the document, so reordered passages
count in full.  An item leaks where the tiles cover ``LEAST_COVER`` of its words.

An item with fewer than ``MIN_TILE`` words has itself as its only seed and shortest tile: it leaks
where all of it stands in a document, word after word.

A word is a run of letters, digits and underscores; of scripts written without
spaces each character is one.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import text_or_empty
from hearth.session import ship_package

#: Words of the shortest tile, share of an item's words that tiles must cover, and
#: the bound on the words of one block of items (about 12 bytes each in a task).
MIN_TILE, LEAST_COVER, BLOCK_WORDS = 5, 0.5, 2_000_000
#: Code points of scripts without spaces between words (South East Asian ones, kana, Han).
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
WORDS = re.compile(rf"[{UNSPACED}]|[^\W{UNSPACED}]+")
_B = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def words_of(text: str | None) -> list[str]:
    return WORDS.findall((text or "").lower())


def _rolled(ids: np.ndarray, s: int) -> np.ndarray:
    """Karp-Rabin hash (modulo 2^64) of every run of ``s`` ids."""
    n = ids.size - s + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h, m = np.zeros(n, np.uint64), ids.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    m ^= m >> np.uint64(29)
    for j in range(s):
        h = h * np.uint64(_B) + m[j:j + n]
    return h


def _roll_runs(ids: list[int], free: list[bool], s: int) -> Iterator[tuple[int, int]]:
    """(hash, place) of each run of ``s`` unmarked ids, the hash rolled along the run."""
    top = pow(_B, s - 1, 1 << 64)
    h = length = 0
    for i, x in enumerate(ids):
        if not free[i]:
            h = length = 0
            continue
        if length == s:
            h = (h - ids[i - s] * top) & _MASK
            length -= 1
        h = (h * _B + x) & _MASK
        length += 1
        if length == s:
            yield h, i - s + 1


def greedy_tiles(item: list[int], doc: list[int], least: int = MIN_TILE) -> list[tuple[int, int, int]]:
    """Greedy string tiling: ``(place in item, place in doc, length)``, longest first.

    The search length starts at the longest common run and falls; at each length the
    item's unmarked runs are hashed, the document's rolled past them, and equal
    hashes confirmed word by word.  Ties go to the earliest place in the item, then in the
    document.
    """
    tiles: list[tuple[int, int, int]] = []
    free_a, free_b = [True] * len(item), [True] * len(doc)
    s = _longest(item, doc, free_a, free_b, least)
    while s >= least:
        runs = list(_roll_runs(item, free_a, s))
        table: dict[int, deque[int]] = {h: deque() for h, _ in runs}
        for h, j in _roll_runs(doc, free_b, s):
            if h in table:
                table[h].append(j)
        for h, i in runs:  # each run of the item takes the first place of its kind that is still free
            if not (free_a[i] and free_a[i + s - 1]):
                continue  # only longer marks or as long ones were made, so a mark in a run covers one of its ends
            places = table[h]
            while places and not (free_b[places[0]] and free_b[places[0] + s - 1]):
                places.popleft()
            for j in places:
                if free_b[j] and free_b[j + s - 1] and item[i:i + s] == doc[j:j + s]:
                    free_a[i:i + s] = free_b[j:j + s] = [False] * s
                    tiles.append((i, j, s))
                    break
        s = _longest(item, doc, free_a, free_b, least, s - 1)
    return tiles


def _longest(item, doc, free_a, free_b, least, most=None) -> int:
    """Length of the longest common run of unmarked words, by halving on the search length."""
    low, high = least - 1, min(len(item), len(doc)) if most is None else most
    while low < high:
        s = (low + high + 1) // 2
        table: dict[int, list[int]] = {}
        for h, i in _roll_runs(item, free_a, s):
            table.setdefault(h, []).append(i)
        if any(item[i:i + s] == doc[j:j + s] for h, j in _roll_runs(doc, free_b, s) for i in table.get(h, ())):
            low = s
        else:
            high = s - 1
    return low


class Block:
    """The items of one block: word numbers, seeds and where they stand.

    ``seeds`` has one sorted table for each length of seeds: ``least``, or all of a shorter item.
    """

    def __init__(self, items: list[tuple[int, str]], least: int):
        self.least, self.number, self.items = least, {}, []
        found: dict[int, tuple[list, list]] = {}
        for item_id, text in items:
            ids = np.array([self.number.setdefault(w, len(self.number) + 1) for w in words_of(text)], np.int64)
            if ids.size:
                hashes, owner = found.setdefault(min(least, ids.size), ([], []))
                at = np.unique(_rolled(ids, min(least, ids.size)))
                hashes.append(at)
                owner.append(np.full(at.size, len(self.items), np.int64))
            self.items.append((item_id, ids.tolist()))
        self.seeds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for k, (hashes, owner) in found.items():
            h, o = np.concatenate(hashes), np.concatenate(owner)
            order = np.argsort(h, kind="stable")
            self.seeds[k] = h[order], o[order]

    def scan(self, text: str, cover: float) -> list[tuple[int, int, int, float]]:
        """``(item id, item words, covered words, coverage)`` of the items that ``text`` leaks."""
        words, number = words_of(text), self.number
        ids = np.fromiter((number.get(w, 0) for w in words), np.int64, len(words))
        return [x for k in self.seeds for x in (self._tiled(ids, cover) if k == self.least else self._standing(ids, k))]

    def _hits(self, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(seed's place, item) of every seed of ``k`` words in a document, by item."""
        none = np.empty(0, np.int64)
        if ids.size < k:
            return none, none
        known = np.concatenate(([0], np.cumsum(ids == 0)))
        spots = np.flatnonzero(known[k:] == known[:-k])  # runs of k words that all occur in the block
        if not spots.size:
            return none, none
        hashes, owner = self.seeds[k]
        h = _rolled(ids, k)[spots]
        left, right = np.searchsorted(hashes, h, "left"), np.searchsorted(hashes, h, "right")
        many = right - left
        place = np.repeat(spots, many)
        step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        item = owner[np.repeat(left, many) + step]
        order = np.lexsort((place, item))
        return place[order], item[order]

    def _standing(self, ids: np.ndarray, k: int) -> list[tuple[int, int, int, float]]:
        """The items of ``k`` words, too short for tiles of their own, that stand in a document whole."""
        found = {}
        for place, item in zip(*map(np.ndarray.tolist, self._hits(ids, k))):
            if item not in found and ids[place:place + k].tolist() == self.items[item][1]:
                found[item] = (self.items[item][0], k, k, 1.0)
        return list(found.values())

    def _tiled(self, ids: np.ndarray, cover: float) -> list[tuple[int, int, int, float]]:
        """The items that tiles cover."""
        k = self.least
        place, item = self._hits(ids, k)
        if not item.size:
            return []
        out = []
        edges = np.concatenate(([0], np.flatnonzero(np.diff(item)) + 1, [item.size]))
        for a, b in zip(edges[:-1], edges[1:]):
            item_id, own = self.items[item[a]]
            if cover * len(own) > (b - a) * k:
                continue  # even disjoint seeds could not cover enough
            covered = sum(t[2] for t in greedy_tiles(own, self._near(ids, place[a:b], k), k))
            if covered >= cover * len(own):
                out.append((item_id, len(own), covered, covered / len(own)))
        return out

    @staticmethod
    def _near(ids: np.ndarray, place: np.ndarray, k: int) -> list[int]:
        """The document's words under a seed; a 0 stands for each gap, as no tile can reach into one."""
        mark = np.zeros(ids.size + 1, np.int64)
        np.add.at(mark, place, 1)
        np.add.at(mark, place + k, -1)
        inside = np.cumsum(mark[:-1]) > 0
        first_out = ~inside & np.concatenate(([True], inside[:-1]))
        keep = inside | first_out
        return np.where(inside, ids, 0)[keep].tolist()


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, most: int):
    """The items in blocks of at most ``most`` words (one item at least), streamed partition by partition."""
    part, size = [], 0
    for r in benchmark.select(F.col(item_col).cast("long").alias("i"), F.col(text_col).alias("t")).filter("t is not null").toLocalIterator():
        n = len(words_of(r.t))
        if part and size + n > most:
            yield part
            part, size = [], 0
        part.append((r.i, r.t))
        size += n
    if part:
        yield part


SCHEMA = "id long, item_id long, item_words int, covered int, coverage double"


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text: str = "text", least: int = MIN_TILE, cover: float = LEAST_COVER,
          block_words: int = BLOCK_WORDS) -> DataFrame:
    """``(id, item_id, item_words, covered, coverage)`` for each document that leaks an item.

    Words are runs of letters, digits and underscores, in lower case, and single characters of
    scripts without spaces.  Items with fewer than ``least`` words leak where they stand whole; items without
    a word (null and empty ones) never leak; null and empty documents leak nothing; an
    empty table on either side gives no rows.  Repeated rows or items give repeated results; null ids
    stay null.
    """
    spark = docs.sparkSession
    ship_package(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("t"))
    out = None
    for items in _blocks(benchmark, item_col, item_text, block_words):
        shared = spark.sparkContext.broadcast(items)

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block = Block(shared.value, least)
            for batch in batches:
                rows = []
                for d, t in zip(batch.column(0), batch.column(1)):
                    rows += [(d.as_py(), *x) for x in block.scan(t.as_py(), cover)]
                types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64()]
                cols = list(zip(*rows)) or [[]] * len(types)
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(cols, types)],
                                                 names=[x.split()[0] for x in SCHEMA.split(", ")])
        part = texts.mapInArrow(scan, SCHEMA)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], SCHEMA) if out is None else out


def keep_clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
               least: int = MIN_TILE, cover: float = LEAST_COVER, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` that leak no item: a narrow pass for each block of items, whole rows go through."""
    spark, at = docs.sparkSession, docs.columns.index(text_col)
    ship_package(spark)
    for items in _blocks(benchmark, item_col, item_text, block_words):
        shared = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block = Block(shared.value, least)
            for batch in batches:
                yield batch.filter(pa.array([not block.scan(t.as_py() or "", cover) for t in batch.column(at)], pa.bool_()))
        docs = docs.mapInArrow(run, docs.schema)
    return docs
