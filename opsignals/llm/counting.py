"""Sums of dense count vectors of a fixed width: a few chunks from each task, added by key.

What a task sends depends on the vector's width and not on its rows, so the sums stay small on any
input and no cell is a hot key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

CHUNK = 1 << 15
PARTS = "chunk int, counts binary"


def chunks(counts: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """The parts of a vector (its length a multiple of CHUNK, or shorter) that aren't zero."""
    for i in range(0, len(counts), CHUNK):
        part = counts[i : i + CHUNK]
        if part.any():
            yield i // CHUNK, part.astype("<i8").tobytes()


def chunk_batch(counts: np.ndarray) -> pa.RecordBatch:
    rows = list(chunks(counts))
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["chunk", "counts"]
    )


def summed(parts: DataFrame, width: int) -> np.ndarray:
    """The vectors' sum, on the driver: ``width`` numbers, whatever the input."""

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for frame in frames:
            for chunk, counts in zip(frame["chunk"], frame["counts"], strict=True):
                part = np.frombuffer(counts, "<i8")
                sums[chunk] = sums[chunk] + part if chunk in sums else part
        if sums:
            yield pd.DataFrame({"chunk": list(sums), "counts": [s.astype("<i8").tobytes() for s in sums.values()]})

    out = np.zeros(width, np.int64)
    for row in parts.repartition("chunk").mapInPandas(add, PARTS).collect():
        part = np.frombuffer(bytes(row.counts), "<i8")
        out[row.chunk * CHUNK : row.chunk * CHUNK + len(part)] += part
    return out
