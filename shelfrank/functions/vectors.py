"""Factor vectors as blocks of float32 bytes.

Between stages a vector travels as one binary value: shuffles and Arrow copy it as a block, where an
array column is written element by element.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_chunk(column: pa.ChunkedArray) -> pa.Array:
    data = column.combine_chunks()
    return pa.concat_arrays(data.chunks) if isinstance(data, pa.ChunkedArray) else data


def longs(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy().astype(np.int64)


def to_matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of a binary column as one float32 matrix."""
    data = one_chunk(column) if isinstance(column, pa.ChunkedArray) else column
    if len(data) == 0:
        return np.empty((0, 0), dtype=np.float32)
    _, ends, values = data.buffers()
    bounds = np.frombuffer(ends, dtype=np.int32)[data.offset : data.offset + len(data) + 1]
    raw = np.frombuffer(values, dtype=np.uint8)[bounds[0] : bounds[-1]]
    return np.frombuffer(raw.tobytes(), dtype=np.float32).reshape(len(data), -1)


def to_binary(matrix: np.ndarray) -> pa.Array:
    """One binary value per row of a float32 matrix."""
    rows, width = len(matrix), matrix.shape[1] * 4 if matrix.size else 0
    ends = np.arange(rows + 1, dtype=np.int32) * np.int32(width)
    values = np.ascontiguousarray(matrix, dtype=np.float32)
    return pa.Array.from_buffers(
        pa.binary(), rows, [None, pa.py_buffer(ends), pa.py_buffer(values.tobytes())]
    )


def pack(factors: DataFrame, *more: str) -> DataFrame:
    """(id, features) as (id, vec), with ``more`` columns of doubles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            flat = np.asarray(lists.flatten(), dtype=np.float32)
            matrix = flat.reshape(len(lists), -1) if len(lists) else flat.reshape(0, 0)
            rest = batch.columns[2:]
            yield pa.RecordBatch.from_arrays([batch.column(0), to_binary(matrix), *rest], names=["id", "vec", *more])

    rows = factors.select(F.col("id").cast("long"), F.col("features").cast("array<float>"), *[F.col(c).cast("double") for c in more])
    return rows.mapInArrow(run, ", ".join(["id long, vec binary", *[f"{c} double" for c in more]]))


def unpack(factors: DataFrame) -> DataFrame:
    """(id, vec) as (id, features)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix = to_matrix(batch.column(1))
            ends = np.arange(len(matrix) + 1, dtype=np.int32) * np.int32(matrix.shape[1])
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(matrix.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["id", "features"])

    return factors.select("id", "vec").mapInArrow(run, "id long, features array<float>")
