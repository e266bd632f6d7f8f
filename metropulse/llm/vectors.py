"""Packed float vectors in Arrow batches and DataFrames."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Neither null nor zero nor with a null, NaN or infinite component."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~odd & F.exists(vector, lambda x: x != 0), F.lit(False))


def doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def unpack(rows) -> np.ndarray:
    """Vectors kept as bytes of doubles."""
    rows = list(rows)
    return np.frombuffer(b"".join(rows), dtype=np.float64).reshape(len(rows), -1)


def pack_column(vectors: np.ndarray) -> pa.Array:
    data = np.ascontiguousarray(vectors, dtype=np.float64)
    return pa.array([row.tobytes() for row in data], pa.binary())


def pack_lists(column: pa.Array | pa.ChunkedArray, unit: bool = False) -> pa.Array:
    """Each list as the bytes of its doubles, divided by its length if ``unit``; lists may have different lengths."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    size = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    bounds = np.append(0, np.cumsum(size))
    if unit and len(flat):
        some = np.flatnonzero(size)
        flat = flat / np.repeat(np.sqrt(np.add.reduceat(flat * flat, bounds[some])), size[some])
    offsets, data = (pa.py_buffer(x) for x in ((bounds * 8).astype(np.int32), flat))
    return pa.Array.from_buffers(pa.binary(), len(column), [None, offsets, data])


class Rows:
    """Vectors kept as bytes, read as matrices a stretch of equal lengths at a time."""

    def __init__(self, rows):
        self.rows = list(rows)
        self.whole = unpack(self.rows) if len(set(map(len, self.rows))) == 1 else None

    def __getitem__(self, part: slice) -> np.ndarray:
        return unpack(self.rows[part]) if self.whole is None else self.whole[part]


def by_length(rows) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, matrix) of the vectors of each length."""
    rows = list(rows)
    size = np.fromiter(map(len, rows), np.int64, len(rows))
    for length in np.unique(size):
        at = np.flatnonzero(size == length)
        yield at, unpack(rows[i] for i in at)


def packed(df: DataFrame, keep: list[str], vector: str, unit: bool = False) -> DataFrame:
    """The long columns ``keep`` and the vector as bytes; divided by its length if ``unit``."""
    n = len(keep)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pack_lists(batch.column(n), unit)], [*keep, vector])

    source = df.select(*[F.col(c).cast("long").alias(c) for c in keep], doubles(F.col(vector)).alias(vector))
    return source.mapInArrow(run, ", ".join([f"{c} long" for c in keep] + [f"{vector} binary"]))
