"""Sums of matrices that tasks have made, without all of them in one place."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Rows of a matrix that are summed together hold at most so many bytes.
BLOCK_BYTES = 64 << 10
#: Ways in which the partial sums of one block are first spread.
WAYS = 64

PARTS = "block int, data binary"


def cut(matrix: np.ndarray) -> pa.RecordBatch:
    """A matrix of doubles as blocks of rows, in the schema ``PARTS``."""
    step = max(1, BLOCK_BYTES // max(1, matrix[:1].nbytes))
    found = [np.ascontiguousarray(matrix[low : low + step], "<f8").tobytes() for low in range(0, len(matrix), step)]
    return pa.RecordBatch.from_arrays([pa.array(range(len(found)), pa.int32()), pa.array(found, pa.binary())], names=["block", "data"])


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = np.frombuffer(data, "<f8")
            sums[block] = sums[block] + found if block in sums else found
    data = [total.tobytes() for total in sums.values()]
    yield pa.RecordBatch.from_arrays([pa.array(sums, pa.int32()), pa.array(data, pa.binary())], names=["block", "data"])


def summed(parts: DataFrame, shape: tuple[int, int]) -> np.ndarray:
    """The sum of all matrices in ``parts`` (``PARTS``), zeros if there are none.

    Every task has added its rows up already. Blocks are added in two steps,
    first in up to ``WAYS`` places each, then in one; the driver gets one
    matrix of the given shape, however many rows and tasks there were.
    """
    spread = parts.repartition(F.col("block"), (F.rand(7) * WAYS).cast("int")).mapInArrow(_add, PARTS)
    whole = spread.repartition("block").mapInArrow(_add, PARTS)
    rows = sorted(whole.collect(), key=lambda row: row["block"])
    if not rows:
        return np.zeros(shape)
    return np.frombuffer(b"".join(bytes(row["data"]) for row in rows), "<f8").reshape(shape)
