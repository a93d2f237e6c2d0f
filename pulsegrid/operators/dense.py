"""Sums of numpy arrays of fixed size that every task makes from its rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SCHEMA = "part int, body binary"
PIECE = 1 << 16  # numbers that travel together


def added_up(rows: DataFrame, add: Callable[[np.ndarray, pa.RecordBatch], None], shape: tuple[int, ...]) -> np.ndarray:
    """The sum over all tasks of an array of ``shape`` to which ``add`` adds each
    batch.  Arrays travel in pieces of fixed size, a task adds up one piece of all
    tasks as they arrive, and the driver gets one array."""
    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(shape), False
        for batch in batches:
            if batch.num_rows:
                add(total, batch)
                seen = True
        if seen:
            flat = total.ravel()
            yield _rows({k: flat[k * PIECE:(k + 1) * PIECE] for k in range(-(-flat.size // PIECE))})

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total[part] = total.get(part, 0) + np.frombuffer(body)
        if total:
            yield _rows(total)

    got = rows.mapInArrow(own, SCHEMA).repartition("part").mapInArrow(merged, SCHEMA).collect()
    out = np.zeros(int(np.prod(shape)))
    for r in got:
        piece = np.frombuffer(r["body"])
        out[r["part"] * PIECE:r["part"] * PIECE + len(piece)] = piece
    return out.reshape(shape)


def _rows(pieces: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(pieces), pa.int32()), pa.array([p.tobytes() for p in pieces.values()], pa.binary())], ["part", "body"])


def matrix(column: pa.Array) -> np.ndarray:
    """A column of arrays of one length as rows of a matrix, nulls as NaN."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(len(column), -1)
