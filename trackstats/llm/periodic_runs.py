"""Runs of repeated words in whole texts, found by internal pattern matching.

A run is a stretch of words with smallest period q, four times as long as q or
longer, that no neighbouring word extends. Every dyadic block of words (length b
a power of two, at a multiple of b) asks where it occurs again close behind
itself: its interval of the suffix array is known from the round of prefix
doubling that sorted by b words, and a wavelet matrix over the suffix array gives
the first occurrences not before a place (range successor). A run of period q
holds a whole block for a b of about q, with its repetition q words on, so one of
the distances found is q; if a block occurs three times or more in the window, its
occurrences form a progression, and the ends of the two stretches with the
progression's difference as period give q. Candidates are extended to both sides
by hashes of word ranges and what is left is compared word by word.

Several texts share the arrays: suffixes are sorted by text first, so intervals
never mix texts. A text costs O(n log n) time and its arrays some 150 bytes a word.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keys import once
from .registry import query, table
from .words import text_chunks

#: A run is at least this many words and this many periods long.
WORDS, PERIODS = 6, 4
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"

_MODULUS = np.uint64((1 << 31) - 1)
_FIRST_BASE = 1_103_515_245


class SuffixArray:
    """Suffixes of the texts ``first[i]:first[i + 1]`` of ``ids``, texts in order and within them sorted by words.

    ``levels[k]`` has, for every block of ``2**k`` words at a multiple of ``2**k``
    of its text, where it starts and the interval of the array with all its occurrences.
    """

    def __init__(self, ids: np.ndarray, first: np.ndarray):
        n = len(ids)
        size = np.diff(first)
        text = np.repeat(np.arange(len(size)), size)
        end = np.repeat(first[1:], size)
        place = np.arange(n) - np.repeat(first[:-1], size)
        key = text * (int(ids.max(initial=0)) + 1) + ids
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.ones(n, bool)
        new[1:] = ordered[1:] != ordered[:-1]
        rank, group_end = self._ranks(order, new, n)
        self.levels = []
        open_ = order[group_end - rank[order] > 1]  # members of groups of two or more, in the array's order
        b = 1
        while len(open_):
            starts = np.sort(open_[(place[open_] & (b - 1)) == 0])
            starts = starts[starts + b <= end[starts]]
            self.levels.append((starts, rank[starts], group_end_of(rank, group_end, starts)))
            nxt = open_ + b
            tail = np.where(nxt < end[open_], rank[np.minimum(nxt, n - 1)] + 1, 0)
            within = rank[open_]
            resorted = np.lexsort((tail, within)) if n >= 1 << 31 else np.argsort(within * (n + 1) + tail, kind="stable")
            moved, tail, within = open_[resorted], tail[resorted], within[resorted]
            # Groups stay where they are, so the members' places in the array are the places of all open groups, in order.
            head = np.ones(len(moved), bool)
            head[1:] = within[1:] != within[:-1]
            at = np.arange(len(moved))
            slot = within + at - np.maximum.accumulate(np.where(head, at, 0))
            order[slot] = moved
            new = head.copy()
            new[1:] |= tail[1:] != tail[:-1]
            begin = np.maximum.accumulate(np.where(new, at, 0))
            rank = rank.copy()
            rank[moved] = slot[begin]
            bounds = np.flatnonzero(new)
            counts = np.diff(np.append(bounds, len(moved)))
            group_end[slot] = slot + np.repeat(counts, counts) - (at - begin)
            open_ = moved[np.repeat(counts, counts) > 1]
            b *= 2
        self.order = order

    @staticmethod
    def _ranks(order, new, n):
        begin = np.flatnonzero(new)
        counts = np.diff(np.append(begin, n))
        rank = np.empty(n, np.int64)
        rank[order] = np.repeat(begin, counts)
        return rank, np.repeat(begin + counts, counts)


def group_end_of(rank: np.ndarray, group_end: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return group_end[rank[starts]]


class WaveletMatrix:
    """Values below ``2**bits`` in the order given, one bit a level from the highest, with packed bits and counts per 64."""

    def __init__(self, values: np.ndarray, bits: int):
        self.n, self.bits, self.levels = len(values), bits, []
        values = values.astype(np.int64)
        for b in range(bits - 1, -1, -1):
            bit = (values >> b) & 1 == 1
            packed = np.packbits(np.concatenate([bit, np.zeros(-len(bit) % 64 + 64, bool)]), bitorder="little").view(np.uint64)
            counts = np.concatenate([[0], np.cumsum(np.bitwise_count(packed).astype(np.int64))])[:-1]
            self.levels.append((b, packed, counts, len(values) - int(bit.sum())))
            values = np.concatenate([values[~bit], values[bit]])

    @staticmethod
    def _ones(packed, counts, i):
        w = i >> 6
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return counts[w] + np.bitwise_count(packed[w] & low)

    def below(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values at places ``lo:hi`` are less than ``x`` (at most ``2**bits``)."""
        lo, hi, total = lo.copy(), hi.copy(), np.zeros(len(lo), np.int64)
        everything = x >= 1 << self.bits
        total[everything] = (hi - lo)[everything]
        for b, packed, counts, zeros in self.levels:
            ones_lo, ones_hi = self._ones(packed, counts, lo), self._ones(packed, counts, hi)
            up = (x >> b) & 1 == 1
            total += np.where(up & ~everything, (hi - lo) - (ones_hi - ones_lo), 0)
            lo, hi = np.where(up, zeros + ones_lo, lo - ones_lo), np.where(up, zeros + ones_hi, hi - ones_hi)
        return total

    def smallest(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The value with ``k`` smaller ones at places ``lo:hi``, which are more than ``k``."""
        lo, hi, k, value = lo.copy(), hi.copy(), k.copy(), np.zeros(len(lo), np.int64)
        for b, packed, counts, zeros in self.levels:
            ones_lo, ones_hi = self._ones(packed, counts, lo), self._ones(packed, counts, hi)
            below = (hi - lo) - (ones_hi - ones_lo)
            up = k >= below
            value |= np.where(up, 1 << b, 0)
            k = np.where(up, k - below, k)
            lo, hi = np.where(up, zeros + ones_lo, lo - ones_lo), np.where(up, zeros + ones_hi, hi - ones_hi)
        return value


class Extensions:
    """Longest common extensions of two places ``q`` words apart, by polynomial hashes modulo a prime."""

    def __init__(self, ids: np.ndarray, begin: np.ndarray, end: np.ndarray, base: int):
        n = len(ids)
        self.begin, self.end = begin, end  # of the text of every place
        self.power = np.ones(n + 1, np.uint64)
        size, step = 1, np.uint64(base) % _MODULUS
        while size <= n:  # powers of the base, twice as many each time
            more = min(size, n + 1 - size)
            self.power[size:size + more] = self.power[:more] * step % _MODULUS
            size, step = size + more, step * step % _MODULUS
        word = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % _MODULUS
        self.hash = np.zeros(n + 1, np.uint64)
        np.cumsum(word * self.power[:n] % _MODULUS, out=self.hash[1:])
        self.hash %= _MODULUS

    def _equal(self, x, y, m):
        left = (self.hash[x + m] + _MODULUS - self.hash[x]) % _MODULUS * self.power[y - x] % _MODULUS
        return left == (self.hash[y + m] + _MODULUS - self.hash[y]) % _MODULUS

    def right(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Words that agree from ``x`` and ``y`` (``x < y``) on."""
        return self._longest(self.end[x] - y, lambda m: self._equal(x, y, m))

    def left(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Words that agree just before ``x`` and ``y``."""
        return self._longest(x - self.begin[x], lambda m: self._equal(x - m, y - m, m))

    @staticmethod
    def _longest(most, equal):
        low, high = np.zeros_like(most), most.copy()
        while np.any(low < high):
            middle = (low + high + 1) >> 1
            same = equal(middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low


def _candidates(sa: SuffixArray, tree: WaveletMatrix, ext: Extensions) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances behind them at which a block of a run and its repetition may stand."""
    at, apart = [], []
    for k, (start, lo, hi) in enumerate(sa.levels):
        b = 1 << k
        nearest, farthest = (2 * b + 1) // 3, (4 * b - 2) // 3  # a run of such a period holds a whole block and the next one
        if k == 0 or not len(start):
            continue
        before = tree.below(lo, hi, start + nearest)
        count = tree.below(lo, hi, start + farthest + 1) - before
        met = count > 0
        start, lo, hi, before, count = start[met], lo[met], hi[met], before[met], count[met]
        if not len(start):
            continue
        one = tree.smallest(lo, hi, before)
        at.append(start)
        apart.append(one - start)
        pair = count > 1
        start, lo, hi, before, count, one = start[pair], lo[pair], hi[pair], before[pair], count[pair], one[pair]
        two = tree.smallest(lo, hi, before + 1)
        at.append(start)
        apart.append(two - start)
        many = count > 2
        start, one, step = start[many], one[many], (two - one)[many]
        ends = one + step + ext.right(one, one + step), start + step + ext.right(start, start + step)
        shift = ends[0] - ends[1]
        right = (shift >= nearest) & (shift <= farthest)
        at.append(start[right])
        apart.append(shift[right])
    if not at:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(at), np.concatenate(apart)


def find_runs(ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and smallest period of all runs of the texts ``first[i]:first[i + 1]`` of word numbers ``ids``, in order."""
    size = np.diff(first)
    if not len(ids) or size.max() < WORDS:
        return (np.zeros(0, np.int64),) * 3
    begin, end = np.repeat(first[:-1], size), np.repeat(first[1:], size)
    sa = SuffixArray(ids, first)
    if len(sa.levels) < 2:
        return (np.zeros(0, np.int64),) * 3
    tree = WaveletMatrix(sa.order, max(1, int(len(ids) - 1).bit_length()))
    base = _FIRST_BASE
    while True:
        ext = Extensions(ids, begin, end, base)
        at, q = _candidates(sa, tree, ext)
        start = at - ext.left(at, at + q)
        length = at + q + ext.right(at, at + q) - start
        long = (length >= WORDS) & (length >= PERIODS * q)
        rows = np.unique(np.stack([start[long], length[long], q[long]], 1), axis=0)
        # Multiples of the smallest period give the same stretch.
        alone = np.ones(len(rows), bool)
        alone[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)
        start, length, q = rows[alone].T
        if all(np.array_equal(ids[s:s + n - p], ids[s + p:s + n]) for s, n, p in zip(start, length, q, strict=True)):
            order = np.lexsort((q, start))
            return start[order], length[order], q[order]
        base = base * 48_271 % int(_MODULUS)  # two different stretches had the same hash


def _found(texts: list[bytes]) -> Iterator[tuple[list[tuple[int, int, int]], bytes]]:
    """Runs and the text without its repetitions, for texts of a chunk."""
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    words = [t.split() for t in texts]  # ASCII white space only, as these are bytes
    first = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
    ids = np.fromiter(map(numbers.__getitem__, chain.from_iterable(words)), np.int64, int(first[-1]))
    start, length, q = find_runs(ids, first)
    change = np.zeros(len(ids) + 1, np.int64)
    np.add.at(change, start + q, 1)
    np.add.at(change, start + length, -1)
    dropped = np.cumsum(change[:-1]) > 0
    owner = np.searchsorted(first, start, "right") - 1
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    for i, w in enumerate(words):
        a, b = bounds[i], bounds[i + 1]
        if a == b:
            yield [], b" ".join(w)
            continue
        kept = np.flatnonzero(~dropped[first[i]:first[i + 1]])
        yield (list(zip((start[a:b] - first[i]).tolist(), length[a:b].tolist(), q[a:b].tolist(), strict=True)),
               b" ".join([w[j] for j in kept.tolist()]))


def _runs(batches):
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    for batch in batches:
        for at, chunk in text_chunks(batch.column(1).to_pylist()):
            found = list(_found(chunk))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(at, len(chunk)),
                pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in runs] for runs, _ in found], kind),
                pa.array([text for _, text in found], pa.binary())], names=["doc_id", "runs", "collapsed"])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, runs, collapsed`` for every row of ``docs`` (``doc_id, text``).

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0. ``runs`` are all runs by
    start and period; ``collapsed`` is the text with the words of every run after
    its first period left out, words joined by one space. Null and empty texts
    have no runs and collapse to the empty text. Whole texts are read: a very long
    one takes a chunk of its own and some 150 bytes of memory a word. Rows come back as often as they
    are there, also with equal or null doc_ids; no other column is read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    made = rows.mapInArrow(_runs, f"doc_id long, runs {RUNS}, collapsed binary")
    return made.select("doc_id", "runs", F.decode("collapsed", "UTF-8").alias("collapsed"))


def planted(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` of the registered query: every tenth document, by its id's checksum, repeats some of its words to its end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    split = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = once(docs.select("doc_id", "text"), words=F.when(h % 10 == 0, split))  # split once, however often used
    g, n = F.floor(h / 10), F.size("words")
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    times = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("words", a + 1, p), times)), F.lit(1), n - a)
    repeated = F.array_join(F.concat(F.slice("words", F.lit(1), a), tail), " ")
    return rows.select("doc_id", F.when(n > 0, repeated).otherwise(F.col("text")).alias("text"))


@query()
def op13_periodic_runs(spark, folder):
    docs = table(spark, folder, "documents")
    found = periodic_runs(planted(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period)), "\n")
    best = F.array_sort(F.transform("runs", lambda r: F.struct((-r.length).alias("less"), r.start.alias("start"), r.period.alias("period"))))
    longest = F.get(best, F.lit(0))
    return (found.withColumn("best", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), (-F.col("best.less")).alias("length"),
        F.col("best.period").alias("period"), F.floor(-1000 * F.col("best.less") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.concat(lines, F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256")))
