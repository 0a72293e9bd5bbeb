"""Toxic spans by a linear-chain conditional random field (operator 4).

Labels come per document, so the training tokens are labelled first: in toxic
documents a token is marked if it carries a character run that sets toxic
documents apart from clean ones.  A two-state chain is then fitted by gradient steps
on the exact likelihood (forward-backward), over hashed features of each token: the
word, its first and its last characters.

Scoring is one narrow pass over whole texts, each of them one chain.  A word's emission score is
worked out once per task and remembered.  Forward-backward runs over pieces of ``CHAIN`` tokens of
many texts at once: what a piece does to the odds that enter it is a 2 x 2 matrix, so the odds
at all borders are found piece by piece first (to the right and to the left), and then
every piece is worked out with the odds that its neighbours give it.  Training takes
pieces as chains of their own, since its sample of them is bounded.
A document's score is its largest token marginal, which does not drift with
length; tokens with a marginal of at least 0.5 give the offending offsets.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import exp
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import by_turns, row_key, text_or_empty
from hearth.llm.hashing import shingles
from hearth.session import ship_package

WORDS = re.compile(r"[^\W\d_]+")
#: Training rows of each class at most (those of the smallest id hash), and characters they may sum to.
ROWS_PER_CLASS, TRAIN_CHARS = 1500, 12_000_000
SLOTS, CHAIN, REMEMBER = 1 << 16, 64, 400_000
#: Chains that are fitted at most; those with a marked token come first.
CHAINS = 12_000


def features(word: str) -> list[int]:
    """Slots of a token's features: the word, its first and its last characters."""
    n, w = len(word), word.encode()
    heads = [b"^" + word[:k].encode() for k in (3, 4, 5) if k < n]
    tails = [b"$" + word[-k:].encode() for k in (3, 4) if k < n]
    return [crc32(x) % SLOTS for x in (b"=" + w, *heads, *tails)]


@dataclass
class Chain:
    """Weights of the two-state chain; scores are those of state 1 (toxic) against state 0."""

    weight: np.ndarray = field(default_factory=lambda: np.zeros(SLOTS))
    bias: float = -4.0
    start: float = 0.0
    move: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))

    def __post_init__(self):
        self._weights = self.weight.tolist().__getitem__

    def emission(self, word: str) -> float:
        """Odds that the word itself gives."""
        return exp(min(40.0, max(-40.0, sum(map(self._weights, features(word))) + self.bias)))

    def odds(self, e: np.ndarray, mask: np.ndarray, first: np.ndarray | None = None, last: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Forward and backward odds of state 1 against 0; their product is the marginal's.

        ``e`` holds the odds that the words themselves give, places x chains, and
        ``mask`` the real tokens, which start each chain.  ``first`` and ``last`` are the forward odds at
        the first place and the backward odds at the last one, of chains that go on (``borders``).
        """
        a, t = np.exp(self.move), e.shape[0]
        fwd, bwd = np.empty(e.shape), np.ones(e.shape)
        fwd[0] = np.exp(self.start) * e[0] if first is None else first
        if last is not None:
            bwd[-1] = last
        for i in range(1, t):
            r = fwd[i - 1]
            fwd[i] = np.clip(e[i] * (a[0, 1] + r * a[1, 1]) / (a[0, 0] + r * a[1, 0]), 1e-40, 1e40)
        for i in range(t - 2, -1, -1):
            x = bwd[i + 1] * e[i + 1]
            bwd[i] = np.where(mask[i + 1], (a[1, 0] + a[1, 1] * x) / (a[0, 0] + a[0, 1] * x), 1.0)
        return fwd, bwd

    def marginals(self, e: np.ndarray, mask: np.ndarray, first: np.ndarray | None = None, last: np.ndarray | None = None) -> np.ndarray:
        """P(state 1) at each place."""
        fwd, bwd = self.odds(e, mask, first, last)
        o = fwd * bwd
        return o / (1 + o)

    def borders(self, e: np.ndarray, mask: np.ndarray, nth: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward odds at the first place and backward odds at the last place of each piece.

        A text's pieces stand side by side, all but its last one full; ``nth`` numbers them within
        the text, ``left`` says how many follow.  Odds ``n / d`` pass a token as the vector ``(n, d)``
        times ``[[e a11, e a01], [a10, a00]]``, and to the left times the transpose.
        """
        a = np.exp(self.move)
        pieces = e.shape[1]
        first, last = np.exp(self.start) * e[0], np.ones(pieces)
        if not nth.any():
            return first, last
        p, q, r, s = np.ones(pieces), np.zeros(pieces), np.zeros(pieces), np.ones(pieces)  # [[p, q], [r, s]], of all places but the first
        for i in range(1, e.shape[0]):
            p2, q2 = e[i] * (a[1, 1] * p + a[0, 1] * r), e[i] * (a[1, 1] * q + a[0, 1] * s)
            r2, s2 = a[1, 0] * p + a[0, 0] * r, a[1, 0] * q + a[0, 0] * s
            scale = np.where(mask[i], np.maximum(np.maximum(p2, q2), np.maximum(r2, s2)), 1.0)
            p, q, r, s = (np.where(mask[i], x, y) / scale for x, y in ((p2, p), (q2, q), (r2, r), (s2, s)))
        by_nth, by_left = np.argsort(nth, kind="stable"), np.argsort(left, kind="stable")
        for at in np.split(by_nth, np.cumsum(np.bincount(nth))[:-1])[1:]:
            f, k = first[at - 1], at - 1
            out = np.clip((p[k] * f + q[k]) / np.maximum(r[k] * f + s[k], 1e-80), 1e-40, 1e40)
            first[at] = np.clip(e[0, at] * (a[0, 1] + out * a[1, 1]) / (a[0, 0] + out * a[1, 0]), 1e-40, 1e40)
        for at in np.split(by_left, np.cumsum(np.bincount(left))[:-1])[1:]:
            b, k = last[at + 1], at + 1
            x = np.clip((p[k] * b + r[k]) / np.maximum(q[k] * b + s[k], 1e-80), 1e-40, 1e40) * e[0, k]
            last[at] = (a[1, 0] + a[1, 1] * x) / (a[0, 0] + a[0, 1] * x)
        return first, last

    def pairs(self, fwd, bwd, e, mask) -> np.ndarray:
        """Expected moves (2 x 2), summed over all chains."""
        a, b = fwd[:-1], np.clip(bwd[1:] * e[1:], 1e-40, 1e40)
        m = np.exp(self.move)
        cell = np.array([m[0, 0] + 0 * a, m[0, 1] * b, m[1, 0] * a, m[1, 1] * a * b])
        return (cell / cell.sum(axis=0) * mask[1:]).sum(axis=(1, 2)).reshape(2, 2)


def _grams(word: str) -> set[str]:
    return {f"={word}", *(f"^{word[:k]}" for k in (2, 3, 4, 5, 6) if k < len(word)),
            *(f"{word[-k:]}$" for k in (4, 5) if k < len(word))}


def unlike(docs: list[list[str]], share: float = 0.3) -> list[bool]:
    """Whether each document is new: of copies of one text only the first teaches anything."""
    seen: set[int] = set()
    out = []
    for words in docs:
        own = shingles(" ".join(words).encode(), 5)
        own = set(own[own % np.uint64(8) == 0].tolist())
        out.append(len(own & seen) <= share * len(own))
        seen |= own
    return out


def label_tokens(docs: list[list[str]], toxic: list[bool]) -> set[str]:
    """The words to mark in toxic documents.

    A telling character run occurs at least 40 times as often among toxic documents
    as among clean ones, and in 2% of the toxic ones; runs that explain three toxic documents
    that no more frequent run explains are added at half that rate.
    """
    bad, good, n_bad = Counter(), Counter(), sum(toxic)
    sets = []
    for words, y in zip(docs, toxic):
        g = set().union(*map(_grams, set(words))) if words else set()
        (bad if y else good).update(g)
        if y:
            sets.append(g)
    n_good = max(1, len(docs) - n_bad)
    odds = {g: (c / n_bad) / ((good[g] + 0.5) / n_good) for g, c in bad.items() if c >= 3}
    keep = {g for g, x in odds.items() if x >= 40 and bad[g] >= max(4, 0.02 * n_bad)}
    left = Counter(g for s in sets if not s & keep for g in s if odds.get(g, 0) >= 20 and bad[g] >= max(3, 0.01 * n_bad))
    keep |= {g for g, c in left.items() if c >= max(3, 0.01 * n_bad)}
    return {w for words, y in zip(docs, toxic) if y for w in set(words) if _grams(w) & keep}


def train(rows: list[tuple[str, int]], rounds: int = 60) -> Chain:
    """A chain fitted to ``(text, toxic)`` rows; without both classes it marks nothing."""
    rows = sorted(rows, key=lambda r: crc32(r[0].encode()))
    docs = [[w.lower() for w in WORDS.findall(t)] for t, _ in rows]
    new = unlike(docs)
    toxic = [bool(y) for (_, y), n in zip(rows, new) if n]
    docs = [d for d, n in zip(docs, new) if n]
    model = Chain()
    if not any(toxic) or all(toxic):
        return model
    marked = label_tokens(docs, toxic)
    number: dict[str, int] = {}
    chains, labels, found = [], [], []
    for k, (words, y) in enumerate(zip(docs, toxic)):
        for at in range(0, len(words), CHAIN):
            part = words[at:at + CHAIN]
            y_part = [int(y and w in marked) for w in part]
            if any(y_part) or not y:
                found.append((not any(y_part), crc32(str((k, at)).encode()), part, y_part))
    # chains with marked tokens first, then a bounded number of clean ones
    found.sort(key=lambda x: x[:2])
    for _, _, part, y_part in found[:CHAINS]:
        chains.append([number.setdefault(w, len(number)) for w in part])
        labels.append(y_part)
    if not chains:
        return model
    ids, mask = np.zeros((CHAIN, len(chains)), np.int64), np.zeros((CHAIN, len(chains)), bool)
    gold = np.zeros((CHAIN, len(chains)))
    for i, (c, y) in enumerate(zip(chains, labels)):
        ids[:len(c), i], mask[:len(c), i], gold[:len(c), i] = c, True, y
    want = np.zeros((2, 2))
    a, b, on = gold[:-1].astype(int), gold[1:].astype(int), mask[1:]
    np.add.at(want, (a[on], b[on]), 1)
    feats = [features(w) for w in number]
    owner = np.repeat(np.arange(len(feats)), [len(f) for f in feats])
    slot = np.concatenate([np.array(f) for f in feats])
    step, moved = [np.zeros(SLOTS), 0.0, 0.0, np.zeros((2, 2))], [np.zeros(SLOTS), 0.0, 0.0, np.zeros((2, 2))]
    for k in range(1, rounds + 1):  # Adam on the mean negative log likelihood with a small L2 term
        emit = np.bincount(owner, model.weight[slot], len(feats)) + model.bias
        e = np.where(mask, np.exp(np.clip(emit, -40, 40))[ids], 1.0)
        fwd, bwd = model.odds(e, mask)
        p = 1 - 1 / (1 + fwd * bwd)
        error = np.where(mask, p - gold, 0.0)
        by_word = np.bincount(ids[mask], error[mask], len(feats))
        scale = 1 / max(1.0, gold.sum())
        grads = [np.bincount(slot, by_word[owner], SLOTS) * scale + 1e-4 * model.weight, by_word.sum() * scale,
                 error[0].sum() * scale, (model.pairs(fwd, bwd, e, mask) - want) * scale + 1e-3 * model.move]
        values = [model.weight, model.bias, model.start, model.move]
        for i, g in enumerate(grads):
            step[i] = 0.9 * step[i] + 0.1 * g
            moved[i] = 0.99 * moved[i] + 0.01 * g * g
            values[i] = values[i] - 0.15 * (step[i] / (1 - 0.9 ** k)) / (np.sqrt(moved[i] / (1 - 0.99 ** k)) + 1e-8)
        model = Chain(*values)
    return model


class _Scores(dict):
    """Emission scores of words, worked out when first met; forgotten when they grow too many."""

    def __init__(self, model: Chain):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> float:
        if len(self) >= REMEMBER:
            self.clear()
        self[word] = s = self.model.emission(word.lower())
        return s


def score_texts(model: Chain, scores: dict, texts: list[str]) -> list[np.ndarray]:
    """The toxic marginal of each token of each text, a whole text being one chain."""
    rows = [np.fromiter(map(scores.__getitem__, WORDS.findall(t)), np.float64) for t in texts]
    out, at = [], 0
    while at < len(rows):  # texts in runs of about 200,000 tokens
        end, n = at, 0
        while end < len(rows) and (end == at or n + rows[end].size <= 200_000):
            n += rows[end].size
            end += 1
        count = [-(-r.size // CHAIN) for r in rows[at:end]]
        e, mask = np.ones((sum(count), CHAIN)), np.zeros((sum(count), CHAIN), bool)
        top = 0
        for r, c in zip(rows[at:end], count):
            e[top:top + c].reshape(-1)[:r.size] = r
            mask[top:top + c].reshape(-1)[:r.size] = True
            top += c
        if top:
            nth = np.concatenate([np.arange(c) for c in count])
            left = np.concatenate([np.arange(c)[::-1] for c in count])
            odds, real = np.ascontiguousarray(e.T), np.ascontiguousarray(mask.T)
            p = np.ascontiguousarray(model.marginals(odds, real, *model.borders(odds, real, nth, left)).T)
        else:
            p = e
        top = 0
        for r, c in zip(rows[at:end], count):
            out.append(p[top:top + c].reshape(-1)[:r.size])
            top += c
        at = end
    return out


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
           per_class: int = ROWS_PER_CLASS, chars: int = TRAIN_CHARS) -> list[tuple[str, int]]:
    """The bounded training sample: per class the rows with the smallest id hash.

    Ids with crc32(id as text) divisible by 5 are held out.  Of contradicting labels of
    one id the toxic one counts, of texts that share an id the one of the least hash; null
    labels don't.  A text that does not fit into what is left of ``chars`` is left out alone;
    if there are texts to learn from but none of a class that ``labels`` has, ValueError is raised.
    """
    spark = docs.sparkSession
    ok = labels.filter((F.crc32(F.col(id_col).cast("string")) % 5 != 0) & F.col(label_col).isin(0, 1))
    ok = ok.groupBy(F.col(id_col).cast("long").alias("__l")).agg(F.max(label_col).cast("int").alias("__y"))
    order = [F.xxhash64("__l"), F.col("__l")]
    picked = None
    for y in (0, 1):
        some = ok.filter(F.col("__y") == y).orderBy(*order).limit(per_class)
        picked = some if picked is None else picked.unionByName(some)
    own = docs.select(F.col(id_col).cast("long").alias("__l"), row_key(text_col).alias("__r"), text_or_empty(text_col).alias("__t"))
    # at most 2 * per_class slim rows reach the driver, which chooses the texts to fetch
    slim = (own.select("__l", "__r", F.length("__t").alias("__n")).join(F.broadcast(picked), "__l").groupBy("__l", "__y")
            .agg(F.min(F.struct("__r", "__n")).alias("__b")).select("__y", F.xxhash64("__l").alias("__h"), "__l", "__b.*").collect())
    with_text = {r["__y"] for r in slim}
    if len(with_text) == 1 and len(picked.select("__y").distinct().collect()) == 2:
        raise ValueError(f"only labels {with_text} have a text to learn from")
    fits = by_turns([(r["__y"], (r["__h"], r["__l"], r["__r"]), r["__n"]) for r in slim], chars)
    chosen = spark.createDataFrame([(key[1], key[2], y) for y, key in fits], "__l long, __r long, __y int")
    rows = own.join(F.broadcast(chosen), ["__l", "__r"]).dropDuplicates(["__l"])
    return [(r["__t"], r["__y"]) for r in rows.select("__t", "__y").collect()]


def score(docs: DataFrame, model: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, row, score, predicted, spans)`` for every row of ``docs``.

    ``spans`` lists the ``(begin, end)`` character offsets of offending tokens in the
    text; ``row`` is the text's hash.  Texts without a word (null and
    empty ones too) score 0.  Repeated rows give repeated results, null ids
    stay null, other columns are ignored, and an empty table gives no rows.
    """
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)
    schema = "id long, row long, score double, predicted int, spans array<struct<begin:int,end:int>>"
    span = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        scores = _Scores(model)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                texts = batch.column(2).to_pylist()
                best, spans = [], []
                for t, p in zip(texts, score_texts(model, scores, texts)):
                    best.append(float(p.max()) if p.size else 0.0)
                    hit = set(np.flatnonzero(p >= 0.5).tolist())
                    spans.append([{"begin": m.start(), "end": m.end()} for i, m in enumerate(WORDS.finditer(t)) if i in hit] if hit else [])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(best, pa.float64()),
                     pa.array([int(b >= 0.5) for b in best], pa.int32()), pa.array(spans, span)],
                    names=["id", "row", "score", "predicted", "spans"])
    texts = docs.select(F.col(id_col).cast("long").alias("id"), row_key(text_col).alias("row"), text_or_empty(text_col).alias("t"))
    return texts.mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Chain:
    return train(sample(docs, labels, id_col, text_col, label_col))


def keep_clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic: one narrow pass, whole rows go through."""
    ship_package(docs.sparkSession)
    shared, at = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col, text_col)), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        scores = _Scores(model)
        for whole in batches:
            for k in range(0, whole.num_rows, 256):
                batch = whole.slice(k, 256)
                texts = [t or "" for t in batch.column(at).to_pylist()]
                yield batch.filter(pa.array([not p.size or float(p.max()) < 0.5 for p in score_texts(model, scores, texts)]))
    return docs.mapInArrow(run, docs.schema)
