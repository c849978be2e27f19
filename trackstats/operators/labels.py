"""The first of many labels that a text contains, in one pass over the text.

All labels go into one Aho-Corasick automaton, so a text costs its length and not
its length times the number of labels.
"""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters of labels in one automaton, which takes some 100 bytes a character; more labels take several passes.
MOST = 1 << 21


def _automaton(labels: list[tuple[int, str, str]]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for place, low, label in labels:
        found.add_word(low, (place, label))
    found.make_automaton()
    return found


def _searching(labels: list[tuple[int, str, str]]):
    """Batches whose last columns are a text and the best label so far."""
    def run(batches):
        automaton = _automaton(labels)
        for batch in batches:
            *rest, texts, best = batch.columns
            found = []
            for text, known in zip(texts.to_pylist(), best.to_pylist(), strict=True):
                first = min((hit for _, hit in automaton.iter(text or "")), default=None)
                if known is not None and (first is None or known["place"] < first[0]):
                    first = known["place"], known["label"]
                found.append(first and dict(zip(("place", "label"), first, strict=True)))
            yield pa.RecordBatch.from_arrays([*rest, texts, pa.array(found, best.type)], names=batch.schema.names)
    return run


def first_label(df: DataFrame, keep: list[str], text: Column, labels: DataFrame, *, name: str = "label") -> DataFrame:
    """``(keep..., name)``: the label of smallest ``place`` that the text contains, ignoring case; NULL without any.

    ``labels`` is ``(place, label)``. Empty and missing labels are in no text, of
    labels alike but for case the first one counts. Texts do not move; a list of
    labels too long for one automaton (``MOST``) passes over them in parts.
    """
    order = F.struct(F.col("place").cast("long").alias("place"), "label")
    listed = labels.where("label is not null and label <> '' and place is not null").groupBy(F.lower("label").alias("low")).agg(F.min(order).alias("l"))
    listed = listed.select("l.place", "low", "l.label")
    parts = int((listed.agg(F.sum(F.length("low"))).first()[0] or 0) // MOST) + 1
    none = F.lit(None).cast("struct<place:bigint,label:string>")
    found = df.select(*keep, F.lower(text).alias("__text"), none.alias("__best"))
    for part in range(parts):
        own = listed.where(F.pmod(F.xxhash64("low"), F.lit(parts)) == part)  # about MOST characters
        rows = [tuple(r) for r in own.collect()]
        if rows:
            found = found.mapInArrow(_searching(rows), found.schema)
    return found.select(*keep, F.col("__best.label").alias(name))
