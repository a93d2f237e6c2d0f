"""Adding up arrays of fixed size that every task has made."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

KIND = "part int, body binary"


def rows(arrays: dict[int, np.ndarray], pieces: int = 1) -> pa.RecordBatch:
    """A task's arrays as rows of ``KIND``, each cut into ``pieces`` equal parts."""
    parts, bodies = [], []
    for k, a in arrays.items():
        for j, x in enumerate(np.split(a.astype(np.float64), pieces)):
            parts.append(k * pieces + j)
            bodies.append(x.tobytes())
    return pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(bodies, pa.binary())], ["part", "body"])


def add_up(made: DataFrame, pieces: int = 1) -> dict[int, np.ndarray]:
    """Sums of the arrays over all tasks.  Parts are added where they arrive, one
    after the other, so a task holds sums only, and the driver gets one array of
    each kind, whatever the number of tasks."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total[part] = total.get(part, 0) + np.frombuffer(body)
        if total:
            yield rows(total)

    got = {r["part"]: np.frombuffer(r["body"]) for r in made.repartition("part").mapInArrow(add, KIND).collect()}
    return {k: np.concatenate([got[k * pieces + j] for j in range(pieces)]) for k in {p // pieces for p in got}}
