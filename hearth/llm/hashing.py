"""Word and shingle hashes of whole texts, vectorised over a document's bytes."""

from __future__ import annotations

import hashlib

import numpy as np

_rng = np.random.default_rng(20240501)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_MUL = (_rng.integers(1, 2**63, 64, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_PIECE = 1 << 22


def _powers(base: int, n: int) -> np.ndarray:
    return np.array([pow(base, i, 1 << 64) for i in range(n)], dtype=np.uint64)


_LOW = _powers(_BASE, 1 << 12)
_HIGH = _powers(pow(_BASE, 1 << 12, 1 << 64), 1 << 12)
_TOP = _powers(pow(_BASE, 1 << 24, 1 << 64), 1 << 8)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and xor-shift), element by element."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_of(off: np.ndarray) -> np.ndarray:
    if off.size and off.max() >= 4096:
        return (_LOW[off & 4095] * _HIGH[(off >> 12) & 4095]) * _TOP[(off >> 24) & 255]
    return _LOW[off]


def _piece_hashes(raw: bytes) -> np.ndarray:
    b = np.frombuffer(raw, np.uint8)
    space = _IS_SPACE[b]
    word = ~space
    if not word.any():
        return np.empty(0, np.uint64)
    edge = np.flatnonzero(np.diff(np.concatenate(([False], word)).astype(np.int8)) == 1)
    at = np.arange(b.size) - np.repeat(edge, np.diff(np.append(edge, b.size))) if edge[0] == 0 else None
    if at is None:
        at = np.zeros(b.size, np.int64)
        at[edge[0]:] = np.arange(edge[0], b.size) - np.repeat(edge, np.diff(np.append(edge, b.size)))
    at[space] = 0
    v = _BYTE[b] * _power_of(at)
    v[space] = 0
    return mix(np.add.reduceat(v, edge))


def _pieces(raw: bytes):
    """``raw`` in runs of about 4 MB, cut after ASCII white space only."""
    at, n = 0, len(raw)
    while n - at > _PIECE:
        end = max(raw.rfind(s, at, at + _PIECE) for s in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
        if end < 0:  # one word longer than a run: go on to its end
            found = [x for x in (raw.find(s, at + _PIECE) for s in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")) if x >= 0]
            if not found:
                break
            end = min(found)
        yield raw[at:end + 1]
        at = end + 1
    yield raw[at:]


def word_hashes(raw: bytes) -> np.ndarray:
    """A 64-bit hash of each white-space separated word of ``raw``, in order."""
    if len(raw) <= _PIECE:
        return _piece_hashes(raw)
    return np.concatenate([_piece_hashes(p) for p in _pieces(raw)])


def shingles(raw: bytes, k: int) -> np.ndarray:
    """Sorted distinct hashes of the ``k``-word runs; fewer words make one shingle, none makes none."""
    w = word_hashes(raw)
    n = w.size
    if n == 0:
        return w
    width = min(k, n)
    s = np.full(n - width + 1, width, np.uint64)
    for j in range(width):
        s += w[j:n - width + 1 + j] * _MUL[j]
    return np.unique(mix(s))


def set_digest(sh: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for the whole set."""
    d = hashlib.blake2b(sh.tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)
