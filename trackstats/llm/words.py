"""Words of whole texts as numpy arrays, a bounded chunk of texts at a time.

Every function works on bytes (UTF-8). A chunk holds whole texts of about
``CHUNK`` bytes together; a longer text is a chunk of its own, so memory follows
the longest text and not the partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK = 1 << 19
U64 = np.uint64

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Words `[^\x20\x09-\x0D]+`.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, 9, 10, 11, 12, 13]] = False
#: Words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` of lower-cased text.
PLAIN = np.zeros(256, bool)
PLAIN[48:58] = PLAIN[97:123] = PLAIN[128:] = True

_PRIME = 0x9E3779B97F4A7C15
_powers = (np.ones(1, U64), np.ones(1, U64))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd constant and of its inverse modulo 2**64."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, CHUNK + CHUNK // 4)
        tables = []
        for base in (_PRIME, pow(_PRIME, -1, 1 << 64)):
            t = np.full(size, base, U64)
            t[0] = 1
            tables.append(np.cumprod(t))
        if size > 4 * CHUNK:  # a single very long text: do not keep its tables
            return tuple(tables)
        _powers = tuple(tables)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit changes every output bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def text_chunks(texts: list[bytes | None], size: int = CHUNK) -> Iterator[tuple[int, list[bytes]]]:
    """Whole texts in runs of about ``size`` bytes, with the number of the first one; null is empty."""
    start, run, total = 0, [], 0
    for i, t in enumerate(texts):
        t = t or b""
        if run and total + len(t) > size:
            yield start, run
            start, run, total = i, [], 0
        run.append(t)
        total += len(t)
    if run:
        yield start, run


class Words:
    """Text ``i`` owns the words ``first[i]:first[i + 1]``; word ``j`` is ``data[start[j]:end[j]]``."""

    def __init__(self, texts: list[bytes], keep: np.ndarray = NOT_SPACE, lower: bool = True):
        joined = b"\n".join([*texts, b""])
        raw = np.frombuffer(joined, np.uint8)
        self.data = LOWER[raw] if lower else raw
        size = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.text_start = np.concatenate([[0], np.cumsum(size)])
        inside = np.zeros(len(raw) + 1, np.int8)
        inside[:-1] = keep[self.data]
        inside[self.text_start[1:] - 1] = 0
        step = np.diff(inside, prepend=np.int8(0))
        self.start = np.flatnonzero(step == 1)
        self.end = np.flatnonzero(step == -1)
        self.first = np.searchsorted(self.start, self.text_start)
        self.count = np.diff(self.first)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.count)), self.count)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word."""
        return span_hashes(self.data, self.start, self.end)

    def bytes_of(self, j: int) -> bytes:
        return self.data[self.start[j]:self.end[j]].tobytes()


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    power, inverse = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * power[:len(data)], out=total[1:])
    return mix((total[end] - total[start]) * inverse[start] + (end - start).astype(U64))


def _multipliers(k: int) -> np.ndarray:
    return mix(np.arange(1, k + 1, dtype=U64) * U64(0xD6E8FEB86659FD93)) | U64(1)


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word windows and where each text's windows begin (one more than there are texts).

    A text of fewer than ``k`` words has its whole sequence as the only window, one without words has none.
    """
    h, n = words.hashes(), len(words.start)
    left = np.repeat(words.first[1:], words.count) - np.arange(n)  # words from here to the text's end
    padded = np.concatenate([h, np.zeros(k, U64)])
    total = np.minimum(left, k).astype(U64)
    for j, m in enumerate(_multipliers(k)):
        total += np.where(left > j, padded[j:j + n], U64(0)) * m
    valid = left >= k
    short = words.first[:-1][(words.count > 0) & (words.count < k)]
    valid[short] = True
    return mix(total[valid]), np.concatenate([[0], np.cumsum(valid)])[words.first]
