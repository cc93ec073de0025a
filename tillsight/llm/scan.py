"""Vectorised scans of UTF-8 text inside a task: Arrow batches in, numpy arrays out.

Texts of a batch are handled in pieces of whole texts of about CHUNK_BYTES, so
memory follows the longest single text and not the batch.  Hashes of byte ranges
come from one pass: with random 64-bit values b for the bytes and an odd P, the
prefix sums of ``b[i] * P**i`` (mod 2**64) give the hash of any range as a
difference times the inverse power of its start, the same wherever it stands.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20
_P = 0x9E3779B97F4A7C15
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64); wraps."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_VALUE = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(_P)) | np.uint64(1)


def table(chars: bytes) -> np.ndarray:
    """Membership of byte values."""
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


SPACE = table(b"\x20\x09\x0a\x0b\x0c\x0d")
#: Letters, digits and every byte of a multi-byte character.
ALNUM = table(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz_") | (np.arange(256) >= 128)


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers["up"]) < n:
        size = max(n, CHUNK_BYTES + 4096)
        for name, base in (("up", _P), ("down", pow(_P, -1, 1 << 64))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[name] = np.multiply.accumulate(p)
    return _powers["up"], _powers["down"]


class Chunk:
    """Texts ``lo..hi`` of a batch: ``data`` has their bytes, ``off`` where each starts and ends."""

    def __init__(self, lo: int, hi: int, data: np.ndarray, off: np.ndarray):
        self.lo, self.hi, self.data, self.off = lo, hi, data, off
        self.n = hi - lo

    def ranges(self) -> None:
        """Prepare hashes of byte ranges."""
        up, self._down = _power(len(self.data) + 1)
        self._sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(BYTE_VALUE[self.data] * up[:len(self.data)], out=self._sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sums[end] - self._sums[start]) * self._down[start])

    def doc(self, at: np.ndarray) -> np.ndarray:
        """Index of the text that holds each byte position."""
        return np.searchsorted(self.off, at, "right") - 1

    def runs(self, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of maximal runs of one non-zero kind within a text; kind: per byte."""
        n = len(self.data)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        edge = np.empty(n + 1, bool)
        edge[0] = edge[n] = True
        np.not_equal(kind[1:], kind[:-1], out=edge[1:n])
        edge[self.off] = True
        at = np.flatnonzero(edge)
        inside = kind[at[:-1]] > 0
        return at[:-1][inside], at[1:][inside]

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of words (runs without white space)."""
        return self.runs((~SPACE[self.data]).view(np.uint8))

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, start and end of each line; every text has one line at least."""
        nl = np.flatnonzero(self.data == 10)
        owner = self.doc(nl)
        every = np.arange(self.n)
        doc = np.concatenate([every, owner])
        start = np.concatenate([self.off[:-1], nl + 1])
        end, end_doc = np.concatenate([nl, self.off[1:]]), np.concatenate([owner, every])
        order = np.lexsort((start, doc))
        return doc[order], start[order], end[np.lexsort((end, end_doc))]

    def total(self, flags: np.ndarray) -> np.ndarray:
        """Sum of a per-byte flag in each text."""
        sums = prefix(flags)
        return sums[self.off[1:]] - sums[self.off[:-1]]


def prefix(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=out[1:])
    return out


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Whole texts in pieces of about ``limit`` bytes; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    body = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        yield Chunk(lo, hi, body[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
        lo = hi


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: whether it occurs again at all, and whether it occurred before."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    any_, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order[1:]] = same
    any_[order[1:]] = same
    any_[order[:-1]] |= same
    return any_, later
