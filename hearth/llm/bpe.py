"""Token counts by byte-pair merging with a heap and a linked list (operator 9).

The vocabulary file's pieces and ranks are read; the merging is done here, and only
counted: a text has as many tokens as it has initial symbols, less the merges.
The initial symbols are characters, and a character without a piece counts its
UTF-8 bytes.  Symbols form a linked list; a heap holds the adjacent pairs that make a
piece, and the best ranked, leftmost pair merges until none is left.

Merges never reach over a place that no piece spans.  Texts are therefore cut
where the vocabulary shows that no piece continues (a space mark after another
character, and around characters that stand in no longer piece), and a cut piece's
count is remembered within a task.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import row_key, text_or_empty
from hearth.session import ship_package

SPACE = "▁"
#: Remembered counts per task, and the longest run of characters that is remembered.
REMEMBER, LONGEST = 1_000_000, 64


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with their ranks (the lowest merges first); a leading space mark is put before a text."""

    ranks: dict[str, float]
    prefix: bool = True

    def joined(self) -> set[str]:
        """Characters that stand in some piece of several characters."""
        return {c for p in self.ranks if len(p) > 1 for c in p}

    def splits_at_space(self) -> bool:
        """Whether no piece has a space mark after another character."""
        return not any(SPACE in p.lstrip(SPACE) for p in self.ranks)


def _fields(data: bytes) -> Iterator[tuple[int, bytes | int]]:
    """The (number, value) fields of a protocol-buffer message."""
    at, n = 0, len(data)

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (data[at] & 127) << shift
            at += 1
            if data[at - 1] < 128:
                return value, at
            shift += 7
    while at < n:
        key, at = varint(at)
        if key & 7 == 0:
            value, at = varint(at)
        else:
            size = {1: 8, 5: 4}.get(key & 7)
            if size is None:
                size, at = varint(at)
            value, at = data[at:at + size], at + size
        yield key >> 3, value


def read_model(data: bytes) -> Vocabulary:
    """The vocabulary of a SentencePiece BPE model file.

    Only what the counting can follow is accepted: a byte-pair model with byte
    fallback, identity normalisation, spaces kept, and no user-defined or unused pieces.
    """
    import struct

    ranks: dict[str, float] = {}
    kinds = {1: 0, 2: 0, 3: 0, 4: 0, 5: 0, 6: 0}
    trainer: dict = {}
    normal: dict = {}
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            kind = piece.get(3, 1)
            kinds[kind] += 1
            if kind == 1:
                ranks[piece[1].decode()] = -struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
        elif number == 2:
            trainer = dict(_fields(value))
        elif number == 3:
            normal = dict(_fields(value))
    if trainer.get(3) != 2 or kinds[6] != 256 or kinds[4] or kinds[5]:
        raise ValueError("a byte-pair model with byte fallback and plain pieces is needed")
    if normal.get(2) or normal.get(4, 1) or not normal.get(5, 1) or trainer.get(24, 0):
        raise ValueError("the model changes texts before it cuts them")
    return Vocabulary(ranks, bool(normal.get(3, 1)))


def count_run(symbols: str, ranks: dict[str, float]) -> int:
    """Tokens of one run of characters: initial symbols less merges."""
    n, rank = len(symbols), ranks.get
    count = n
    for c in symbols:
        if c not in ranks:
            count += len(c.encode()) - 1
    heap = []
    for i in range(n - 1):
        s = rank(symbols[i:i + 2])
        if s is not None:
            heap.append((s, i, 2))
    if not heap:
        return count
    size = [1] * n  # characters of the symbol that starts here; 0 once it has been merged away
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    heapq.heapify(heap)
    pop, push = heapq.heappop, heapq.heappush
    while heap:
        _, i, length = pop(heap)
        j = after[i]
        if j >= n or not size[i] or size[i] + size[j] != length:
            continue  # one side has changed since
        size[i], size[j] = length, 0
        count -= 1
        k = after[i] = after[j]
        end = i + length
        if k < n:
            before[k] = i
            s = rank(symbols[i:end + size[k]])
            if s is not None:
                push(heap, (s, i, length + size[k]))
        h = before[i]
        if h >= 0:
            s = rank(symbols[h:end])
            if s is not None:
                push(heap, (s, h, end - h))
    return count


class Counter(dict):
    """Counts of runs, remembered; forgotten when they grow too many."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary
        own = "".join(map(re.escape, sorted(vocabulary.joined())))
        inner = own.replace(re.escape(SPACE), "")
        if vocabulary.splits_at_space():
            # space marks and what follows them; marks alone; or one character that joins nothing
            self.cut = re.compile(f"{SPACE}*[{inner}]+|{SPACE}+|.", re.DOTALL)
        else:
            self.cut = re.compile(f"[{own}]+|.", re.DOTALL)

    def __missing__(self, run: str) -> int:
        n = count_run(run, self.vocabulary.ranks)
        if len(run) <= LONGEST:
            if len(self) >= REMEMBER:
                self.clear()
            self[run] = n
        return n

    def count(self, text: str) -> int:
        if not text:
            return 0
        text = text.replace(" ", SPACE)
        return sum(map(self.__getitem__, self.cut.findall(SPACE + text if self.vocabulary.prefix else text)))


def token_counts(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, row, n_bytes, n_tokens)`` for every row; ``row`` is the text's hash.

    Null and empty texts have no bytes and no tokens.  Special strings inside a text are
    plain text.  Repeated rows give repeated results, null ids stay null,
    further columns are ignored, and an empty table gives no rows.  The vocabulary is
    broadcast: it is a fixed file of some ten thousand pieces.
    """
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value)
        for batch in batches:
            n = pa.array([counter.count(t.as_py()) for t in batch.column(3)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), n],
                                             names=["id", "row", "n_bytes", "n_tokens"])
    texts = docs.select(F.col(id_col).cast("long").alias("id"), row_key(text_col).alias("row"),
                        F.octet_length(text_or_empty(text_col)).cast("long").alias("n_bytes"), text_or_empty(text_col).alias("t"))
    return texts.mapInArrow(run, "id long, row long, n_bytes long, n_tokens long")
