"""Benchmark decontamination by templates.

Texts become sequences of words in which numbers, units after a number and names
are typed placeholders. Windows of the templates of a benchmark item and of a
document are joined by hash. Slots at the same places must be filled
consistently: a value of the item that stands for another value of the document
does so at most of its places. A slot that breaks this costs the windows it is
in. An item whose numbers and names were exchanged is found that way, and a text
that only has the same shape is not.

A capitalised word at the start of a sentence may be a name or not. So there are
three sequences of a text, each with windows of its own: the words as they are,
without case; templates in which such a word is a name where the text has it as a
name elsewhere; and templates in which it always is one. An item is held by a
document that has enough windows of any of the three.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.keys import lookup
from . import words as W
from .registry import query, table
from .store import stored

WINDOW = 8
#: A template window of a long item with fewer plain words is compared by its values, and so is a short item with fewer.
PLAIN_WORDS, SHORT_PLAIN_WORDS = 2, 5
#: Share of an item's windows that a document must hold.
COVERAGE = 0.5
#: Bits of the filter for each window of the benchmark, and the most it may have (64 MB).
FILTER_BITS, MOST_BITS = 16, 1 << 29
EXACT, KNOWN_NAMES, ALL_NAMES = range(3)

# Units of measure.
UNITS = ("mm cm m km in ft yd mi mg g kg lb lbs oz t ml l s sec min h hr kb mb gb tb w kw v hz "
         "inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers kilometre kilometres "
         "gram grams kilogram kilograms pound pounds ounce ounces ton tons litre litres liter liters gallon gallons "
         "second seconds minute minutes hour hours day days week weeks month months year years "
         "cent cents dollar dollars euro euros percent degree degrees").split()
# Number words.
NUMBERS = ("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
           "seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand "
           "million billion").split()

_OTHER, _LETTER, _DIGIT = 0, 1, 2
_CLASS = np.zeros(256, np.uint8)
_CLASS[97:123] = _CLASS[65:91] = _CLASS[128:] = _LETTER
_CLASS[48:58] = _DIGIT
_BREAK = np.isin(np.arange(256), np.frombuffer(b".!?\n\r:;\"()", np.uint8))
_NUM, _UNIT, _NAME = (W.mix(np.array([i], W.U64))[0] for i in (101, 102, 103))


def _hash_list(words: list[str]) -> np.ndarray:
    w = W.Words([x.encode() for x in words])
    return np.sort(w.hashes())


_UNIT_HASHES, _NUMBER_HASHES = _hash_list(UNITS), _hash_list(NUMBERS)


class Sequence:
    """Words of some texts: ``value`` hash, ``slot`` flag, ``template`` hash and ``first`` as in ``Words``."""

    def __init__(self, value: np.ndarray, slot: np.ndarray, template: np.ndarray, first: np.ndarray):
        self.value, self.slot, self.template, self.first = value, slot, template, first
        self.count = np.diff(first)

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the ``n`` words from each place on and the places that have ``n`` words left."""
        total = len(self.value)
        left = np.repeat(self.first[1:], self.count) - np.arange(total)
        at = np.flatnonzero(left >= n)
        shape, plain = np.full(len(at), n, W.U64), np.zeros(len(at), np.int8)
        for j, m in enumerate(W._multipliers(n)):
            shape += self.template[at + j] * m
            plain += ~self.slot[at + j]
        few = np.flatnonzero(plain < (PLAIN_WORDS if n == WINDOW else min(SHORT_PLAIN_WORDS, n)))
        exact = np.full(len(few), n, W.U64)
        for j, m in enumerate(W._multipliers(n)):
            exact += self.value[at[few] + j] * m
        shape[few] = exact ^ W.U64(0x55)
        return W.mix(shape), at

    def slot_lists(self, at: np.ndarray, n: int) -> list:
        """For each window the values of its slots, 0 where a plain word stands; nothing where there is no slot."""
        slot = self.slot[at[:, None] + np.arange(n)]
        cells = W.signed(np.where(slot, self.value[at[:, None] + np.arange(n)] | W.U64(1), W.U64(0)))
        return [c if some else c[:0] for c, some in zip(cells, slot.any(1), strict=True)]


def sequences(texts: list[bytes]) -> list[Sequence]:
    """The exact words and the two templates of some texts."""
    raw = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    size = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    text_start = np.concatenate([[0], np.cumsum(size)])
    kind = _CLASS[raw]
    if len(raw) > 2:  # digit groups and decimals are one number
        inner = ((raw[1:-1] == 46) | (raw[1:-1] == 44)) & (kind[:-2] == _DIGIT) & (kind[2:] == _DIGIT)
        kind[1:-1][inner] = _DIGIT
    edge = np.flatnonzero(np.diff(kind, prepend=np.uint8(_OTHER), append=np.uint8(_OTHER)) != 0)
    begin, stop = edge[:-1], edge[1:]
    used = kind[begin] != _OTHER if len(begin) else np.zeros(0, bool)
    begin, stop = begin[used], stop[used]
    value = W.span_hashes(W.LOWER[raw], begin, stop)
    first = np.searchsorted(begin, text_start)
    number = (kind[begin] == _DIGIT) | np.isin(value, _NUMBER_HASHES)
    after_number = np.concatenate([[False], number[:-1]])[:len(number)]
    unit = np.isin(value, _UNIT_HASHES) & after_number & ~number
    head = raw[begin]
    second = raw[np.minimum(begin + 1, len(raw) - 1)]
    upper = ((head >= 65) & (head <= 90)) | ((head == 0xC3) & (second >= 0x80) & (second <= 0x9E))
    breaks = np.concatenate([[0], np.cumsum(_BREAK[raw])])
    gap_from = np.concatenate([[0], stop[:-1]])[:len(stop)]
    sentence_start = breaks[begin] > breaks[gap_from]
    opening = first[:-1][np.diff(first) > 0]
    sentence_start[opening] = True
    unit[opening] = False
    may_be_name = upper & ~number & ~unit
    sure = may_be_name & ~sentence_start
    own = W.mix(value + np.repeat(np.arange(len(texts)), np.diff(first)).astype(W.U64) * W.U64(0x9E3779B97F4A7C15))
    known = may_be_name & np.isin(own, own[sure])
    none = np.zeros(len(value), bool)
    out = [Sequence(value, none, value, first)]
    for name in (known, may_be_name):
        fixed = number | unit
        joined = value
        # Neighbouring names are one name: the later ones go, their hash is folded into the first.
        follows = np.concatenate([[False], name[:-1]])[:len(name)] & name
        follows[opening] = False
        if follows.any():
            group = np.cumsum(~follows) - 1
            total = np.zeros(group[-1] + 1, W.U64)
            place = np.arange(len(name)) - np.flatnonzero(~follows)[group]
            np.add.at(total, group, np.where(name, value * (2 * place.astype(W.U64) + W.U64(1)), W.U64(0)))
            several = np.concatenate([follows[1:], [False]]) & ~follows
            joined = np.where(several, W.mix(total[group]), value)
        keep = ~follows
        shape = np.where(number, _NUM, np.where(unit, _UNIT, np.where(name, _NAME, value)))
        out.append(Sequence(joined[keep], (fixed | name)[keep], shape[keep], np.concatenate([[0], np.cumsum(keep)])[first]))
    return out


SPANS = "id long, kind int, place long, width int, span long, slots array<long>"


def _rows(found: list) -> pa.RecordBatch:
    columns = list(zip(*found, strict=True)) if found else [()] * 6
    types = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                      names=["id", "kind", "place", "width", "span", "slots"])


def _item_windows(batches):
    """All windows of every item; an item shorter than a window is one window of its own width."""
    for batch in batches:
        ids = batch.column(0).to_pylist()
        for at, chunk in W.text_chunks(batch.column(1).to_pylist()):
            found = []
            for kind, t in enumerate(sequences(chunk)):
                for width in range(1, WINDOW + 1):
                    hashes, places = t.windows(width)
                    owner = np.searchsorted(t.first, places, "right") - 1
                    own = (t.count[owner] == width) if width < WINDOW else np.ones(len(owner), bool)
                    hashes, places, owner = hashes[own], places[own], owner[own]
                    for h, p, o, s in zip(W.signed(hashes), places, owner, t.slot_lists(places, width), strict=True):
                        if ids[at + o] is not None:
                            found.append((ids[at + o], kind, int(p - t.first[o]), width, int(h), s))
            yield _rows(found)


def _filter_places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    h = hashes.view(W.U64)
    return (h & W.U64(bits - 1)).astype(np.int64), (W.mix(h) & W.U64(bits - 1)).astype(np.int64)


def _filter_bits(bits: int):
    """Places of the filter that a task's windows set."""
    def run(batches):
        for batch in batches:
            h = batch.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(_filter_places(h, bits))), pa.int64())], names=["bit"])
    return run


def _filter(items: DataFrame) -> tuple[bytes, int]:
    """A Bloom filter of two places a window, as large as the benchmark's windows need."""
    n = items.agg(F.approx_count_distinct("span")).first()[0]
    size = min(MOST_BITS, 1 << max(16, int(FILTER_BITS * n).bit_length()))
    rows = items.select("span").mapInArrow(_filter_bits(size), "bit long").select(
        F.shiftright("bit", 3).alias("byte"), F.expr("cast(1 << cast(bit % 8 as int) as int)").alias("mask"))
    packed = rows.groupBy("byte").agg(F.bit_or("mask").alias("mask")).toArrow()  # at most MOST_BITS / 8 rows
    bits = np.zeros(size // 8, np.uint8)
    bits[packed.column("byte").to_numpy()] = packed.column("mask").to_numpy().astype(np.uint8)
    return bits.tobytes(), size


def _document_windows(shared, size: int, widths: list[int]):
    def run(batches):
        bits = np.frombuffer(shared.value, np.uint8)

        def among(place):
            return bits[place >> 3] >> (place & 7).astype(np.uint8) & 1 == 1
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for at, chunk in W.text_chunks(batch.column(1).to_pylist()):
                found = []
                for kind, t in enumerate(sequences(chunk)):
                    for width in widths:
                        hashes, places = t.windows(width)
                        a, b = _filter_places(hashes, size)
                        hit = among(a)
                        hit[hit] = among(b[hit])
                        hashes, places = hashes[hit], places[hit]
                        owner = np.searchsorted(t.first, places, "right") - 1
                        for h, p, o, s in zip(W.signed(hashes), places, owner, t.slot_lists(places, width), strict=True):
                            if ids[at + o] is not None:
                                found.append((ids[at + o], kind, int(p - t.first[o]), width, int(h), s))
                if found:
                    yield _rows(found)
    return run


def consistent(windows: list[tuple[int, int, list[int], list[int]]]) -> tuple[set[tuple[int, int]], bool]:
    """The windows ``(place, span, here, there)`` of one alignment whose slots are filled consistently; whether with the same values.

    A value may stand for itself. It may stand for another one that is at more than half of the value's places.
    """
    votes: dict[int, dict[int, int]] = {}
    for place, _, here, there in windows:
        for j, (a, b) in enumerate(zip(here, there, strict=True)):
            if a:
                votes.setdefault(a, {})[place + j] = b
    stands: dict[int, int] = {}
    for a, at in votes.items():
        others = list(at.values())
        best = max(set(others), key=others.count)
        if 2 * others.count(best) > len(others):
            stands[a] = best
    kept, same = set(), True
    for place, span, here, there in windows:
        if all(a == b or stands.get(a) == b for a, b in zip(here, there, strict=True)):
            kept.add((place, span))
            same = same and here == there
    return kept, same


def _aligned(batches):
    """Windows of one document and item, kind by kind and shift by shift, to the number of those that fit."""
    at, shift, windows, kept, same = None, None, [], set(), True

    def settled():
        found, alike = consistent(windows)
        return kept | found, same and (alike or not found)
    for batch in batches:
        out = []
        for doc, item, kind, off, place, span, here, there in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if ((doc, item, kind), off) != (at, shift):
                if at is not None:
                    kept, same = settled()
                if (doc, item, kind) != at:
                    if at is not None:
                        out.append((*at, len(kept), same))
                    at, kept, same = (doc, item, kind), set(), True
                shift, windows = off, []
            windows.append((place, span, here, there))
        yield _counts(out)
    if at is not None:
        kept, same = settled()
        yield _counts([(*at, len(kept), same)])


def _counts(rows: list) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
        columns, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_()), strict=True)], names=["doc_id", "item_id", "kind", "n", "same"])


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, coverage, same_values``, one row per document that holds an item.

    ``coverage`` is the share of the item's windows found with consistent slots
    in the best of the three sequences, at least ``COVERAGE``; ``same_values``
    tells a copy from a re-parameterised item. An item shorter than a window must
    be there whole. Items without words and rows without an id match nothing; rows
    with the same doc_id, or the same item_id, count as one text. Windows are
    taken from whole texts, very long ones included. Values that stand for two
    others at equally many places stand for none. Other columns are not read.
    """
    spark = docs.sparkSession
    pick = lambda df, key: df.select(F.col(key).cast("long").alias("id"), F.col("text").cast("binary").alias("text"))
    items = stored(pick(benchmark, "item_id").mapInArrow(_item_windows, SPANS), "items")
    bits, size = _filter(items)
    widths = sorted(r[0] for r in items.select("width").distinct().collect())  # at most WINDOW rows
    shared = spark.sparkContext.broadcast(bits)
    found = stored(pick(docs, "doc_id").mapInArrow(_document_windows(shared, size, widths), SPANS), "windows")
    found = found.select(F.col("id").alias("doc_id"), "kind", F.col("place").alias("at"), "width", "span", F.col("slots").alias("there")).distinct()

    # Of an item's windows, COVERAGE must be met; so one of any others and one more is. The rarest among items are asked for.
    items = items.withColumnRenamed("id", "item_id").distinct()
    own = items.groupBy("item_id", "kind").agg(F.countDistinct("place", "span").alias("windows"))
    shared_by = items.groupBy("kind", "width", "span").agg(F.countDistinct("item_id").alias("df"))
    order = Window.partitionBy("item_id", "kind").orderBy("df", "place", "span")
    ranked = (lookup(items.select("item_id", "kind", "place", "width", "span").distinct(), shared_by, ["kind", "width", "span"], "inner")
              .withColumn("rank", F.row_number().over(order)).join(own, ["item_id", "kind"]))
    asked = ranked.where(F.col("rank") <= F.col("windows") - F.ceil(COVERAGE * F.col("windows")) + 1).select("item_id", "kind", "width", "span").distinct()
    pairs = found.select("doc_id", "kind", "width", "span").distinct().join(asked, ["kind", "width", "span"]).select("doc_id", "item_id", "kind").distinct()
    whole = items.groupBy("item_id", "kind").agg(F.collect_set(F.struct("place", "width", "span", F.col("slots").alias("here"))).alias("w"))
    met = (lookup(pairs, whole, ["item_id", "kind"], "inner").select("doc_id", "item_id", "kind", F.inline("w"))
           .join(found, ["doc_id", "kind", "width", "span"]))
    met = (met.where(F.size("here") == F.size("there")).select("doc_id", "item_id", "kind", (F.col("at") - F.col("place")).alias("shift"), "place", "span", "here", "there")
           .repartition("doc_id", "item_id", "kind").sortWithinPartitions("doc_id", "item_id", "kind", "shift", "place"))
    counts = met.mapInArrow(_aligned, "doc_id long, item_id long, kind int, n long, same boolean")
    per = counts.join(own, ["item_id", "kind"]).withColumn("coverage", F.col("n") / F.col("windows")).where(F.col("coverage") >= COVERAGE)
    return per.groupBy("doc_id", "item_id").agg(F.max("coverage").alias("coverage"), F.bool_or("same").alias("same_values"))


def leaking_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_ids, coverage, same_values`` of the documents that hold an item."""
    return leaks(docs, benchmark).groupBy("doc_id").agg(
        F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.max("coverage").alias("coverage"),
        F.bool_or("same_values").alias("same_values"))


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item, with their columns; rows without doc_id stay."""
    return docs.join(leaks(docs, benchmark).select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


@query()
def op1_benchmark_leaks(spark, folder):
    return leaking_documents(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
