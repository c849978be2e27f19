"""Sums of numeric tables that many tasks have made, without bringing them together in one task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

PARTS = "part int, data binary"


def parts(table: np.ndarray) -> pa.RecordBatch:
    """A table as one row per first index, as ``summed`` takes them."""
    return pa.RecordBatch.from_arrays([pa.array(np.arange(len(table)), pa.int32()), pa.array([row.tobytes() for row in table])],
                                      names=["part", "data"])


def summed(made: DataFrame, shape: tuple[int, ...], sent=np.float64) -> np.ndarray:
    """The sum of all tasks' tables, made as ``sent``. Tasks add up one part at a time; ``shape`` bounds what reaches the driver."""
    def run(batches):
        at, total = None, None
        for batch in batches:
            for part, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                row = np.frombuffer(data, sent)
                if part != at:
                    if at is not None:
                        yield _row(at, total)
                    at, total = part, np.zeros(len(row))
                total += row
        if at is not None:
            yield _row(at, total)
    rows = made.repartition("part").sortWithinPartitions("part").mapInArrow(run, PARTS).collect()
    out = np.zeros(shape)
    for r in rows:
        out[r.part] = np.frombuffer(r.data).reshape(shape[1:])
    return out


def _row(part: int, total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([total.tobytes()])], names=["part", "data"])
