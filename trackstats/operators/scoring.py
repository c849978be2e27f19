"""Scores of whole texts against a table of weighted pieces, inside the task that read the text.

A row's pieces become one count per different piece and are matched with the
model as arrays, so no row per piece exists and texts do not move. The model is
``(piece, label, weight)``; its different pieces and labels travel to the tasks
only if they are few (``CELLS``). Beyond that a block of rows asks for the
pieces it holds, the model answers by a join, and each block is scored with its
own answers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .keys import cut_lineage

#: A model of at most so many rows, and of so many pieces times labels, is sent to the tasks (40 MB).
ROWS, CELLS = 1 << 18, 1 << 22
#: Texts are counted in runs of about this many bytes; a longer text is a run of its own.
CHUNK = 1 << 19

#: Counts go into a table of at most so many cells (32 MB); beyond that they are sorted.
TABLE = 1 << 22

SCORES = "array<struct<label:string,score:double>>"
_SCORES = pa.list_(pa.struct([("label", pa.string()), ("score", pa.float64())]))


def _words(text: bytes) -> list[bytes]:
    return text.split()  # ASCII white space, as these are bytes


def _points(text: bytes) -> np.ndarray:
    return np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.int64)


def _trigrams(text: bytes) -> np.ndarray:
    """All triples of code points as numbers of three times 21 bits."""
    point = _points(text)
    return point[:-2] << 42 | point[1:-1] << 21 | point[2:] if len(point) > 2 else point[:0]


def _numbered(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Different triples of a run of texts in ascending order, the number of each that occurs, and how many each text has.

    With few different characters the triples are counted in a table of all that could be, else they are sorted.
    """
    points = [_points(t) for t in texts]
    lengths = [max(0, len(p) - 2) for p in points]
    flat = np.concatenate([np.zeros(0, np.int64), *points])
    known = np.flatnonzero(np.bincount(flat)) if len(flat) else flat
    k = len(known)
    if k ** 3 > TABLE or len(flat) < 3:
        names, pieces = np.unique(np.concatenate([np.zeros(0, np.int64), *[_trigrams(t) for t in texts]]), return_inverse=True)
        return names, pieces, lengths
    rank = np.zeros(known[-1] + 1, np.int64)
    rank[known] = np.arange(k)
    at = rank[flat]
    triple = (at[:-2] * k + at[1:-1]) * k + at[2:]
    ends = np.cumsum([len(p) for p in points])
    inside = np.ones(len(flat), bool)  # triples do not reach into the next text
    for back in (1, 2):
        last = ends - back
        inside[last[(last >= 0) & (np.array([len(p) for p in points]) >= back)]] = False
    triple = triple[inside[:-2]]
    found = np.flatnonzero(np.bincount(triple)) if len(triple) else triple
    number = np.zeros(k ** 3, np.int64)
    number[found] = np.arange(len(found))
    return known[found // (k * k)] << 42 | known[found // k % k] << 21 | known[found % k], number[triple], lengths


def _spelled(code: int) -> str:
    return "".join(chr(code >> shift & 0x1FFFFF) for shift in (42, 21, 0))


def _counted(texts: list[bytes | None], kind: str) -> tuple[list | np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Different pieces of a run of texts, and (text, piece number, times) of all that occur."""
    if kind == "words":
        number: dict[bytes, int] = {}
        lists = [_words(t or b"") for t in texts]
        pieces = np.fromiter((number.setdefault(w, len(number)) for w in chain.from_iterable(lists)), np.int64)
        names, lengths = list(number), [len(x) for x in lists]
    else:
        names, pieces, lengths = _numbered([t or b"" for t in texts])
    owner = np.repeat(np.arange(len(texts)), lengths)
    pairs = owner * max(1, len(names)) + pieces
    if len(texts) * len(names) <= TABLE:
        all_times = np.bincount(pairs, minlength=1)
        pairs = np.flatnonzero(all_times)
        times = all_times[pairs]
    else:
        pairs, times = np.unique(pairs, return_counts=True)
    return names, pairs // max(1, len(names)), pairs % max(1, len(names)), times


def _runs(texts: list[bytes | None]) -> Iterator[tuple[int, list[bytes | None]]]:
    start, size, run = 0, 0, []
    for i, t in enumerate(texts):
        if run and size + len(t or b"") > CHUNK:
            yield start, run
            start, size, run = i, 0, []
        run.append(t)
        size += len(t or b"")
    if run:
        yield start, run


class _Model:
    """Weights by piece and label; NaN where the model has no row."""

    def __init__(self, pieces: list[str], labels: list[str], weights: list[float], kind: str):
        self.kind, self.labels = kind, sorted(set(labels))
        different = list(dict.fromkeys(pieces))
        row, column = {p: i for i, p in enumerate(different)}, {c: i for i, c in enumerate(self.labels)}
        self.weight = np.full((len(different) + 1, len(self.labels)), np.nan)  # the last row is for pieces it does not have
        self.weight[[row[p] for p in pieces], [column[c] for c in labels]] = weights
        if kind == "words":
            self.row = {p.encode(): i for p, i in row.items()}
        else:
            triples = [(int(code[0]), i) for p, i in row.items() if len(code := _trigrams(p.encode())) == 1]
            self.row = np.array(sorted(triples), np.int64).reshape(-1, 2)

    def rows(self, names) -> np.ndarray:
        unknown = len(self.weight) - 1
        if self.kind == "words":
            return np.fromiter((self.row.get(n, unknown) for n in names), np.int64, len(names))
        if not len(self.row):
            return np.full(len(names), unknown)
        at = np.minimum(np.searchsorted(self.row[:, 0], names), len(self.row) - 1)
        return np.where(self.row[at, 0] == names, self.row[at, 1], unknown)

    def scores(self, n: int, names, owner: np.ndarray, piece: np.ndarray, times: np.ndarray) -> list[list[dict]]:
        found: list[list[dict]] = [[] for _ in range(n)]
        row = self.rows(names)[piece]
        for j, label in enumerate(self.labels):
            weight = self.weight[row, j]
            met = ~np.isnan(weight)
            total = np.bincount(owner[met], weights=(weight * times)[met], minlength=n)
            for i in np.flatnonzero(np.bincount(owner[met], minlength=n)):
                found[i].append({"label": label, "score": float(total[i])})
        return found


def _scoring(model: _Model, kind: str):
    def run(batches):
        for batch in batches:
            found = []
            for _, texts in _runs(batch.column(batch.num_columns - 1).to_pylist()):
                found += model.scores(len(texts), *_counted(texts, kind))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, _SCORES)],
                                             names=[*batch.schema.names[:-1], "scores"])
    return run


def _blocks(kind: str):
    """Runs of rows as (block, rows, pieces, owner, piece, times), the rows as an Arrow stream."""
    def run(batches):
        from pyspark import TaskContext
        block = TaskContext.get().partitionId() << 33
        for batch in batches:
            for at, texts in _runs(batch.column(batch.num_columns - 1).to_pylist()):
                names, owner, piece, times = _counted(texts, kind)
                spelled = [n.decode("utf-8", "replace") for n in names] if kind == "words" else [_spelled(int(n)) for n in names]
                sink = pa.BufferOutputStream()
                own = batch.slice(at, len(texts)).drop_columns([batch.schema.names[-1]])
                with pa.ipc.new_stream(sink, own.schema) as out:
                    out.write_batch(own)
                arrays = [x.astype(np.int32).tobytes() for x in (owner, piece, times)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([block]), pa.array([sink.getvalue().to_pybytes()]), pa.array([len(texts)]), pa.array([spelled], pa.list_(pa.string())),
                    *[pa.array([a], pa.binary()) for a in arrays]], names=["block", "rows", "n", "pieces", "owner", "piece", "times"])
                block += 1
    return run


def _block_scores(names: list[str]):
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                with pa.ipc.open_stream(r["rows"]) as stream:
                    own = stream.read_all().combine_chunks().to_batches()[0]
                owner, piece, times = (np.frombuffer(r[c], np.int32).astype(np.int64) for c in ("owner", "piece", "times"))
                answers = r["answers"] or []
                model = _Model([str(a["pos"]) for a in answers], [a["label"] for a in answers], [a["weight"] for a in answers], "words")
                numbers = [str(i).encode() for i in range(len(r["pieces"]))]
                found = model.scores(r["n"], numbers, owner, piece, times)
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(found, _SCORES)], names=[*names, "scores"])
    return run


def scored(df: DataFrame, keep: list[str], text: Column, model: DataFrame, *, kind: str) -> DataFrame:
    """``(keep..., scores)``: for every row the summed weights of its pieces under each label that it met.

    ``kind`` says what a piece is: ``words`` between ASCII white space, or
    ``trigrams`` of characters. ``model`` is ``(piece, label, weight)``, the
    weights of repeated rows add up. Rows come back as often as they are there,
    whatever their keys; a null text meets nothing.
    """
    src = df.select(*keep, text.cast("binary").alias("__text"))
    schema = T.StructType([*src.drop("__text").schema.fields, T.StructField("scores", T._parse_datatype_string(SCORES))])
    rows = (model.where("piece is not null and label is not null and weight is not null").groupBy("piece", "label")
            .agg(F.sum(F.col("weight").cast("double")).alias("weight")))
    few = rows.limit(ROWS + 1).toArrow()
    pieces, labels = len(few["piece"].unique()), len(few["label"].unique())
    if len(few) <= ROWS and (pieces + 1) * labels <= CELLS:
        packed = _Model(few["piece"].to_pylist(), few["label"].to_pylist(), few["weight"].to_pylist(), kind)
        return src.mapInArrow(_scoring(packed, kind), schema)
    blocks = cut_lineage(src.mapInArrow(_blocks(kind), "block long, rows binary, n long, pieces array<string>, owner binary, piece binary, times binary"))
    asked = blocks.select("block", F.posexplode("pieces").alias("pos", "piece"))
    answers = (asked.join(rows, "piece").groupBy("block").agg(F.collect_list(F.struct("pos", "label", "weight")).alias("answers")))  # as many as a block's pieces have rows
    return blocks.join(answers, "block", "left").mapInArrow(_block_scores(keep), schema)


def _tallies(kind: str):
    def run(batches):
        for batch in batches:
            groups, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at, run_ in _runs(texts):
                names, owner, piece, times = _counted(run_, kind)
                total: Counter = Counter()
                own = groups[at:at + len(run_)]
                for g in dict.fromkeys(own):
                    mine = np.array([x == g for x in own])[owner]
                    n = np.bincount(piece[mine], weights=times[mine], minlength=len(names)).astype(np.int64)
                    total.update({(g, int(p)): int(n[p]) for p in np.flatnonzero(n)})
                spell = (lambda i: names[i].decode("utf-8", "replace")) if kind == "words" else (lambda i: _spelled(int(names[i])))
                yield pa.RecordBatch.from_arrays([
                    pa.array([g for g, _ in total], pa.string()), pa.array([spell(p) for _, p in total], pa.string()),
                    pa.array(list(total.values()), pa.int64())], names=["label", "piece", "n"])
    return run


def tallies(df: DataFrame, label: Column, text: Column, *, kind: str) -> DataFrame:
    """``(label, piece, n)``: how often each piece occurs in the texts of a label; a run of texts is summed in its task."""
    made = df.select(label.cast("string").alias("label"), text.cast("binary").alias("text")).mapInArrow(_tallies(kind), "label string, piece string, n long")
    return made.groupBy("label", "piece").agg(F.sum("n").alias("n"))
