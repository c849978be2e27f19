"""Records of CSV files whose quoted fields may hold line ends, read by all tasks of a splittable scan.

A line alone does not say whether it starts inside a quoted field. So a first
scan notes for every split how it ends if it starts outside and if it starts
inside quotes; chained over the splits of a file this gives each split's true
start. A second scan then joins lines to records on its own; only the pieces of
records that cross a split's border are brought together by a shuffle.
"""

from __future__ import annotations

import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A quoted field runs to the first quote that is not doubled; what follows up to the comma belongs to it.
_FIELD = r'(?:"(?:[^"]++|"")*+"[^,]*+|[^",][^,]*+|)'
_FIELDS = re.compile(rf"{_FIELD}(?:,{_FIELD})*+", re.S)
_REST = re.compile(rf'(?:[^"]++|"")*+"[^,]*+(?:,{_FIELD})*+', re.S)


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted field is open at the line's end, given whether one is at its start."""
    if '"' not in line:
        return inside
    if not inside:
        return _FIELDS.fullmatch(line) is None
    return _REST.fullmatch(line) is None  # else the field that was open at the start still is, or a later one


def _batches_of_splits(batches):
    """(file, split's start, lines) in the order of the scan, runs of one split together."""
    for batch in batches:
        files, starts = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        at = 0
        while at < len(files):
            end = at + 1
            while end < len(files) and files[end] == files[at] and starts[end] == starts[at]:
                end += 1
            yield (files[at], starts[at]), batch.column(0).slice(at, end - at)
            at = end


def _quotes(lines: pa.Array) -> bool:
    return bool(pc.any(pc.match_substring(lines, '"')).as_py())


def _summaries(batches):
    now, state = None, None

    def row():
        (file, start), (outside, inside, closed) = now, state
        return pa.RecordBatch.from_arrays([pa.array([x]) for x in (file, start, outside, inside, closed)], names=["file", "start", "from_outside", "from_inside", "closed"])
    for split, lines in _batches_of_splits(batches):
        if split != now:
            if now is not None:
                yield row()
            now, state = split, (False, True, False)
        if _quotes(lines):
            outside, inside, closed = state
            for line in lines.to_pylist():
                outside, inside = ends_inside(line, outside), ends_inside(line, inside)
                closed = closed or not inside  # the record that was open at the start has ended
            state = outside, inside, closed
    if now is not None:
        yield row()


def _starts(rows) -> dict[tuple[str, int], int | None]:
    """For each split that starts inside a quoted field, the start of the split where its record begins."""
    found, file, opener = {}, None, None
    for r in sorted(rows, key=lambda r: (r.file, r.start)):
        if r.file != file:
            file, opener = r.file, None
        if opener is None:
            opener = r.start if r.from_outside else None
        else:
            found[r.file, r.start] = opener
            opener = (r.start if r.closed else opener) if r.from_inside else None
    return found


_NAMES = ["record", "file", "opener", "start", "head"]


def _joined(opened: dict[tuple[str, int], int]):
    def rows(made):
        return pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], t) for i, t in enumerate(
            (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_()))], names=_NAMES)

    def run(batches):
        now, held, head, opener, first = None, [], False, None, False
        for split, lines in _batches_of_splits(batches):
            made = []
            if split != now:
                if held:
                    made.append(("\n".join(held), now[0], now[1] if opener is None else opener, now[1], head))
                now, held, opener = split, [], opened.get(split)
                inside, first = opener is not None, split[1] == 0
            if not held and not inside and not first and not _quotes(lines):
                if made:
                    yield rows(made)
                n = len(lines)
                none = pa.nulls(n, pa.int64())
                yield pa.RecordBatch.from_arrays([lines, pa.nulls(n, pa.string()), none, none, pa.array([False] * n)], names=_NAMES)
                continue
            for line in lines.to_pylist():
                if not held:
                    head = first
                first = False
                inside = ends_inside(line, inside)
                held.append(line)
                if not inside:
                    text = "\n".join(held)
                    made.append((text, None, None, None, head) if opener is None else (text, now[0], opener, now[1], False))
                    held, opener = [], None
            if made:
                yield rows(made)
        if held:
            yield rows([("\n".join(held), now[0], now[1] if opener is None else opener, now[1], head)])
    return run


def csv_records(spark: SparkSession, path: str, *, header: bool = True) -> DataFrame:
    """``record``: the text of every record of the CSV files, line ends within quotes kept; blank records are left out.

    With ``header`` each file's first record is left out too. Lines end with
    ``\\n`` or ``\\r\\n``. One row per split of the scan reaches the driver.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    rows = lines.mapInArrow(_summaries, "file string, start long, from_outside boolean, from_inside boolean, closed boolean").collect()
    found = lines.mapInArrow(_joined(_starts(rows)), "record string, file string, opener long, start long, head boolean")
    whole = found.where("file is null").select("record", "head")
    pieces = F.array_sort(F.collect_list(F.struct("start", "record", "head")))
    crossing = (found.where("file is not null").groupBy("file", "opener").agg(pieces.alias("p"))  # as many pieces as splits that one record touches
                .select(F.array_join(F.transform("p", lambda x: x["record"]), "\n").alias("record"), F.get("p", F.lit(0))["head"].alias("head")))
    kept = whole.unionByName(crossing)
    if header:
        kept = kept.where("not head")
    return kept.select(F.regexp_replace("record", "\r$", "").alias("record")).where(F.trim("record") != "")
