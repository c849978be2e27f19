"""Token counts that follow edits.

A text is kept as runs of whole pre-tokens; a segment tree over the runs holds
the characters and tokens below every node. An edit descends to the runs it
touches, with the characters on both sides that decide where pre-tokens end;
only these runs are cut and encoded again, then the sums above them change.

A run begins at a blank between two letters or digits. Such a blank always begins a
pre-token, whatever stands further left or right, so runs can be encoded alone.
"""

from __future__ import annotations

from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .registry import query, table
from .store import stored
from .vocabularies import FOLDER, VOCABULARY, encoding

#: Characters of a run, at least.
RUN = 256


def cuts(text: str, run: int = RUN) -> list[int]:
    """Lengths of the runs of a text."""
    out, start = [], 0
    at = text.find(" ", run)
    while at != -1:
        if text[at - 1].isalnum() and at + 1 < len(text) and text[at + 1].isalnum():
            out.append(at - start)
            start = at
            at = text.find(" ", start + run)
        else:
            at = text.find(" ", at + 1)
    if start < len(text):
        out.append(len(text) - start)
    return out


class CountTree:
    """Runs of a text at the leaves of a complete binary tree that sums their characters and tokens.

    A leaf holds a few runs. An edit that changes the number of runs deals the new
    ones out to the leaves of the old ones, so only the paths above these change
    and the text is not copied. A leaf that has become too full has the tree
    dealt out anew, which happens once in many edits of one place.
    """

    #: Runs that a leaf may hold.
    FULL = 8

    def __init__(self, runs: list[str], tokens: list[int]):
        self._build(list(zip(runs, tokens, strict=True)))

    def _build(self, rows: list[tuple[str, int]]):
        self.size = size = 1 << max(0, (len(rows) - 1).bit_length())
        self.leaves: list[list[tuple[str, int]]] = [[r] for r in rows] + [[] for _ in range(size - len(rows))]
        self.chars, self.tokens = [0] * (2 * size), [0] * (2 * size)
        for i in range(size):
            self._sum(i)
        for i in range(size - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def _sum(self, leaf: int):
        self.chars[self.size + leaf] = sum(len(t) for t, _ in self.leaves[leaf])
        self.tokens[self.size + leaf] = sum(n for _, n in self.leaves[leaf])

    def rows(self) -> list[tuple[str, int]]:
        return [r for leaf in self.leaves for r in leaf]

    def text(self) -> str:
        return "".join(t for t, _ in self.rows())

    def runs(self) -> tuple[list[int], list[int]]:
        rows = self.rows()
        return [len(t) for t, _ in rows], [n for _, n in rows]

    def find(self, place: int) -> tuple[int, int, int]:
        """Leaf and number of the run that holds a character (the last one for places at the end), and where the run starts."""
        node, start = 1, 0
        place = min(place, self.chars[1] - 1)
        while node < self.size:
            node *= 2
            if place >= start + self.chars[node]:
                start += self.chars[node]
                node += 1
        leaf = node - self.size
        for i, (text, _) in enumerate(self.leaves[leaf]):
            if place < start + len(text):
                return leaf, i, start
            start += len(text)
        raise IndexError(place)

    def between(self, first: tuple[int, int], last: tuple[int, int]) -> list[tuple[str, int]]:
        """The runs from one to another, both included."""
        if first[0] == last[0]:
            return self.leaves[first[0]][first[1]:last[1] + 1]
        inner = [r for leaf in self.leaves[first[0] + 1:last[0]] for r in leaf]
        return self.leaves[first[0]][first[1]:] + inner + self.leaves[last[0]][:last[1] + 1]

    def replace(self, first: tuple[int, int], last: tuple[int, int], rows: list[tuple[str, int]]):
        """Put new runs in place of those from one to another."""
        rows = self.leaves[first[0]][:first[1]] + rows + self.leaves[last[0]][last[1] + 1:]
        each = -(-len(rows) // (last[0] - first[0] + 1))
        for k, leaf in enumerate(range(first[0], last[0] + 1)):
            self.leaves[leaf] = rows[k * each:(k + 1) * each]
            self._sum(leaf)
        low, high = (first[0] + self.size) // 2, (last[0] + self.size) // 2
        while low:
            for i in range(low, high + 1):
                self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
                self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]
            low, high = low // 2, high // 2
        if each > self.FULL:
            self._build(self.rows())


def _encoded(text: str, encode) -> list[tuple[str, int]]:
    rows, at = [], 0
    for n in cuts(text):
        rows.append((text[at:at + n], len(encode(text[at:at + n]))))
        at += n
    return rows


def build(text: str, encode) -> CountTree:
    rows = _encoded(text, encode)
    return CountTree([t for t, _ in rows], [n for _, n in rows])


def apply(tree: CountTree, start: int, stop: int, insert: str, encode) -> int:
    """Replace the characters ``start:stop`` of the tree's text; returns how many characters were encoded again."""
    size = tree.chars[1]
    start = max(0, min(start, size))
    stop = max(start, min(stop, size))
    if not size:
        tree.__dict__.update(build(insert, encode).__dict__)
        return len(insert)
    # The blank that begins a run holds only with its neighbours: a change beside it opens the run before it.
    *first, low = tree.find(max(0, start - 2))
    *last, _ = tree.find(stop + 1)
    old = "".join(t for t, _ in tree.between(first, last))
    middle = old[:start - low] + insert + old[stop - low:]
    tree.replace(first, last, _encoded(middle, encode))
    return len(middle)


KEPT = "doc_id long, text string, n_tokens long, run_chars array<int>, run_tokens array<int>"


def _rows(names: list[str], types: list, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def counted(docs: DataFrame, *, vocabulary: str = f"{FOLDER}/{VOCABULARY}") -> DataFrame:
    """``doc_id, text, n_tokens`` and the runs of every row; a null text is empty and has no runs.

    Whole texts are read, very long ones too; repeated rows and null doc_ids come back as often as they are there; other
    columns are not read.
    """
    def run(batches):
        encode = encoding(vocabulary).encode_ordinary
        for batch in batches:
            rows, size = [], 0
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py() or ""
                tree = build(text, encode)
                rows.append((key, text, tree.tokens[1], *tree.runs()))
                size += len(text)
                if size > 4 << 20:
                    yield _rows(names, types, rows)
                    rows, size = [], 0
            yield _rows(names, types, rows)
    names = [c.split()[0] for c in KEPT.split(", ")]
    types = [pa.int64(), pa.string(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, KEPT)


EDITED = KEPT + ", n_before long, n_edits int, encoded_chars long"
EDIT = "array<struct<start:int,stop:int,insert:string>>"


def edited(kept: DataFrame, *, edits: str = "edits", vocabulary: str = f"{FOLDER}/{VOCABULARY}") -> DataFrame:
    """Apply each row's edits, in their order, each to the outcome of those before; same columns as ``counted`` and more.

    Places are characters (code points); places beyond the text are taken as its
    end, a null insert as empty, null edits as none. Columns beside those of ``counted`` and the edits are not read.
    """
    def run(batches):
        encode = encoding(vocabulary).encode_ordinary
        for batch in batches:
            rows, size = [], 0
            columns = [batch.column(i) for i in range(6)]
            for i in range(batch.num_rows):
                key, text, before, chars, tokens, todo = (c[i].as_py() for c in columns)
                ends = list(accumulate(chars, initial=0))
                tree, again = CountTree([text[a:b] for a, b in zip(ends, ends[1:], strict=False)], tokens), 0
                for e in todo or []:
                    again += apply(tree, e["start"] or 0, e["stop"] or 0, e["insert"] or "", encode)
                text = tree.text()
                rows.append((key, text, tree.tokens[1], *tree.runs(), before, len(todo or []), again))
                size += len(text)
                if size > 4 << 20:
                    yield _rows(names, types, rows)
                    rows, size = [], 0
            yield _rows(names, types, rows)
    names = [c.split()[0] for c in EDITED.split(", ")]
    types = [pa.int64(), pa.string(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int64(), pa.int32(), pa.int64()]
    return kept.select("doc_id", "text", "n_tokens", "run_chars", "run_tokens", F.col(edits).cast(EDIT).alias("edits")).mapInArrow(run, EDITED)


@query()
def op3_edited_token_counts(spark, folder):
    """Every text gets a headline, a replaced passage around its middle and a closing line."""
    kept = stored(counted(table(spark, folder, "documents")), "counted")
    n, edit = F.char_length("text"), lambda a, b, s: F.struct(a.cast("int").alias("start"), b.cast("int").alias("stop"), s.alias("insert"))
    middle = F.floor(n / 2)
    todo = F.array(edit(n, n, F.concat(F.lit("\nend of document "), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")))),
                   edit(middle, middle + 20, F.lit("(20 characters went here)")),
                   edit(F.lit(0), F.lit(0), F.lit("A headline: ")))
    found = edited(kept.withColumn("edits", todo))
    return found.select("doc_id", "n_before", "n_tokens", "n_edits", F.char_length("text").cast("long").alias("n_chars"),
                        "encoded_chars", F.size("run_chars").alias("n_runs"))
