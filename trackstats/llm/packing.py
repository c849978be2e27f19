"""Token ids packed into rows of a fixed length by best fit decreasing.

Texts are encoded, ended by an end-of-text id and cut into segments of at most a
row. Each task packs blocks of about ``BLOCK`` ids: the segments go by falling
length, each into the row that leaves the least room; a segment tree over the
free lengths finds it. Nothing is dropped: a text that is longer than a row
continues in other rows. Blocks are independent, so nothing is shuffled and
memory does not depend on the table.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keys import scratch_path
from .registry import query, table
from .store import stored
from .vocabularies import END, FOLDER, VOCABULARY, encoding
from .warc import file_system

LENGTH = 2048
BLOCK = 1 << 22
MAGIC = b"PACKIDS1"


class FreeRows:
    """Open rows by their free length; ``tightest`` finds the smallest free length that is enough.

    A segment tree over the lengths 0..length holds how many open rows have a
    free length in each range.
    """

    def __init__(self, length: int):
        self.size = 1 << length.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(length + 1)]

    def _add(self, free: int, change: int):
        node, count = free + self.size, self.count
        while node:
            count[node] += change
            node >>= 1

    def put(self, free: int, row: int):
        self.rows[free].append(row)
        self._add(free, 1)

    def take(self, free: int) -> int:
        self._add(free, -1)
        return self.rows[free].pop()

    def tightest(self, need: int) -> int | None:
        count, node = self.count, need + self.size
        if count[node]:
            return need
        while node > 1:
            if not node & 1 and count[node + 1]:  # the range just right of this one
                node += 1
                while node < self.size:
                    node = 2 * node if count[2 * node] else 2 * node + 1
                return node - self.size
            node >>= 1
        return None


def best_fit_decreasing(lengths: np.ndarray, length: int) -> list[list[int]]:
    """Rows of segment numbers; every segment once, no row longer than ``length``."""
    rows: list[list[int]] = []
    free = FreeRows(length)
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        room = free.tightest(need)
        if room is None:
            row, room = len(rows), length
            rows.append([])
        else:
            row = free.take(room)
        rows[row].append(i)
        if room > need:
            free.put(room - need, row)
    return rows


ROW = ("block long, row int, n_tokens int, doc_ids array<long>, parts array<int>, cu_seqlens array<int>, resets array<int>, "
       "ids binary")


def _packed_block(number: int, segments: list, length: int) -> Iterator[dict]:
    """``segments``: (doc_id, part, ids). ``resets`` are the places where positions begin at 0 again."""
    lengths = np.array([len(s[2]) for s in segments])
    for r, members in enumerate(best_fit_decreasing(lengths, length)):
        ends = np.concatenate([[0], np.cumsum(lengths[members])]).astype(np.int32)
        ids = np.full(length, END, np.uint16)
        ids[:ends[-1]] = np.concatenate([segments[i][2] for i in members])
        yield {"block": number, "row": r, "n_tokens": int(ends[-1]), "doc_ids": [segments[i][0] for i in members],
               "parts": [segments[i][1] for i in members], "cu_seqlens": ends.tolist(), "resets": ends[:-1].tolist(),
               "ids": ids.tobytes()}


def _segments(batches, length: int, vocabulary: str) -> Iterator[tuple]:
    encode = encoding(vocabulary).encode_ordinary
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            ids = np.array([*encode(text.as_py() or ""), END], np.uint16)
            for part, at in enumerate(range(0, len(ids), length)):
                yield key, part, ids[at:at + length]


def _blocks(batches, length: int, vocabulary: str) -> Iterator[tuple[int, list]]:
    """Numbered runs of segments of about ``BLOCK`` ids; the number names task and run."""
    number, run, size = TaskContext.get().partitionId() << 32, [], 0
    for segment in _segments(batches, length, vocabulary):
        run.append(segment)
        size += len(segment[2])
        if size >= BLOCK:
            yield number, run
            number, run, size = number + 1, [], 0
    if run:
        yield number, run


_TYPES = [pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()),
          pa.list_(pa.int32()), pa.binary()]
_NAMES = [c.split()[0] for c in ROW.split(", ")]


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(_NAMES, _TYPES, strict=True)], names=_NAMES)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def packed(docs: DataFrame, *, length: int = LENGTH, vocabulary: str = f"{FOLDER}/{VOCABULARY}") -> DataFrame:
    """Packed rows of the texts of ``docs``: ids (16 bits each, padded with the end id), lengths and resets.

    ``doc_ids`` and ``parts`` say which part of which text each segment is. A
    null or empty text is a segment of the end id alone; a row without doc_id
    has null there. Repeated rows are packed as often as they occur. A text longer
    than a row, however long, is cut into parts; other columns are not read.
    """
    def run(batches):
        for number, segments in _blocks(batches, length, vocabulary):
            rows = []
            for row in _packed_block(number, segments, length):
                rows.append(row)
                if len(rows) == 256:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)
    return _texts(docs).mapInArrow(run, ROW)


FILED = ("file string, block long, row int, n_tokens int, doc_ids array<long>, parts array<int>, cu_seqlens array<int>, "
         "resets array<int>")


def write_packed(docs: DataFrame, folder: str, *, length: int = LENGTH, vocabulary: str = f"{FOLDER}/{VOCABULARY}") -> DataFrame:
    """Pack and write a file per block below ``folder``; returns a row per packed row that names its file.

    A file holds a header (magic, rows, row length), the id matrix (16 bits, row
    by row), the offsets of each row's segments, the cumulative segment lengths
    and the position resets (32 bits each), all little-endian.
    """
    def run(batches):
        files, base = file_system(folder)
        files.create_dir(base, recursive=True)
        for number, segments in _blocks(batches, length, vocabulary):
            rows = list(_packed_block(number, segments, length))
            temp, name = f"{base}/.{number}-{os.urandom(8).hex()}", f"block-{number:015d}.pack"
            with files.open_output_stream(temp, compression=None) as out:
                out.write(MAGIC + struct.pack("<II", len(rows), length))
                for r in rows:
                    out.write(r.pop("ids"))
                out.write(np.cumsum([0, *[len(r["cu_seqlens"]) for r in rows]]).astype("<i4").tobytes())
                out.write(np.concatenate([r["cu_seqlens"] for r in rows]).astype("<i4").tobytes())
                out.write(np.concatenate([r["resets"] for r in rows]).astype("<i4").tobytes())
            files.move(temp, f"{base}/{name}")  # a repeated task makes the same file
            full = _batch([r | {"ids": None} for r in rows]).drop_columns(["ids"])
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"] * len(rows)), *full.columns],
                                             names=["file", *full.schema.names])
    return stored(_texts(docs).mapInArrow(run, FILED), "packed")


def read_block(data: bytes) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """The id matrix, cumulative lengths and resets of one file."""
    n, length = struct.unpack_from("<II", data, 8)
    if data[:8] != MAGIC:
        raise ValueError("not a packed file")
    ids = np.frombuffer(data, "<u2", n * length, 16).reshape(n, length)
    at = 16 + 2 * n * length
    offsets = np.frombuffer(data, "<i4", n + 1, at)
    lengths = np.frombuffer(data, "<i4", offsets[-1], at + 4 * (n + 1))
    resets = np.frombuffer(data, "<i4", offsets[-1] - n, at + 4 * (n + 1 + int(offsets[-1])))
    return (ids, [lengths[a:b] for a, b in zip(offsets, offsets[1:], strict=False)],
            [resets[a - i:b - i - 1] for i, (a, b) in enumerate(zip(offsets, offsets[1:], strict=False))])


@query()
def op2_packed_ids(spark, folder):
    return write_packed(table(spark, folder, "documents"), scratch_path(spark) + "/packed")
