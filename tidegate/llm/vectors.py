"""Vectors inside tasks: array columns as matrices, and matrices as binary columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.functions.compare import quoted


def dimension(rows: DataFrame, column: str) -> int:
    """Components of the longest vector; 0 without any."""
    return max(rows.agg(F.max(F.size(quoted(column))).alias("d")).first()["d"] or 0, 0)


def unpacked(lists: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A matrix of doubles, shorter vectors ending with zeros, and which rows are finite vectors.

    Rows that are NULL or hold NULL or non-finite components are zero in the matrix.
    """
    out = np.zeros((len(lists), size))
    fine = pc.is_valid(lists).to_numpy(zero_copy_only=False).copy()
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # NULL becomes NaN
    row = np.repeat(np.arange(len(lists)), lengths)
    place = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    fine[row[~np.isfinite(values)]] = False
    keep = fine[row]
    out[row[keep], place[keep]] = values[keep]
    return out, fine


def units(matrix: np.ndarray) -> np.ndarray:
    """The rows scaled to length 1, whatever their size; zero rows stay zero."""
    most = np.abs(matrix).max(axis=1, initial=0.0, keepdims=True)
    scaled = np.divide(matrix, most, out=np.zeros_like(matrix), where=most > 0)
    norms = np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]
    return np.divide(scaled, norms, out=scaled, where=norms > 0)


def packed(matrix: np.ndarray) -> pa.Array:
    """The rows of a matrix as binary values."""
    width, data = matrix.shape[1] * matrix.itemsize, np.ascontiguousarray(matrix)
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * np.int32(width)
    return pa.BinaryArray.from_buffers(pa.binary(), len(matrix), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def matrix_of(column: pa.Array, kind: str) -> np.ndarray:
    """The matrix whose rows are the binary values of this column, all of one length."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32, count=len(column) + 1, offset=4 * column.offset)
    whole = data[int(at[0]) : int(at[-1])].to_pybytes() if len(column) else b""
    return np.frombuffer(whole, kind).reshape(len(column), -1 if whole else 0)


def pieces(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches cut to at most so many rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
