"""Arrow list columns as matrices."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector is not null and holds only finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def matrices(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(row numbers, matrix)`` for each vector length in a column of usable vectors."""
    size = column.value_lengths().to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False)
    start = np.cumsum(size) - size
    for d in np.unique(size):
        rows = np.flatnonzero(size == d)
        yield rows, values[start[rows][:, None] + np.arange(d)]


def packed(rows: int, parts: Iterable[tuple[np.ndarray, np.ndarray]]) -> pa.BinaryArray:
    """``rows`` binaries, those of each ``(row numbers, matrix)`` holding its rows as doubles, all others null."""
    parts, size = list(parts), np.zeros(rows, np.int64)
    for at, x in parts:
        size[at] = x.shape[1]
    end = np.cumsum(size)
    words = np.empty(int(end[-1]) if rows else 0)
    for at, x in parts:
        words[(end - size)[at][:, None] + np.arange(x.shape[1])] = x
    offsets = np.concatenate([[0], end * 8]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), rows, [pa.array(size > 0).buffers()[1], pa.py_buffer(offsets), pa.py_buffer(words)])


def unpacked(column: pa.BinaryArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(row numbers, matrix)`` for each length in a column of binaries that hold doubles."""
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64) // 8
    words = np.frombuffer(column.buffers()[2], np.float64, int(offsets[-1]))
    size = np.diff(offsets)
    for d in np.unique(size):
        rows = np.flatnonzero(size == d)
        yield rows, words[offsets[rows][:, None] + np.arange(d)]
