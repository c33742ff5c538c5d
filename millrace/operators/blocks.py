"""Sums of small arrays over all rows: each task adds up its own, Spark adds up the tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.lineage import materialize

#: Bytes of one packed value, about. A batch of 10,000 of them stays small.
PACKED_BYTES = 4096
#: Numbers of a long sum that meet as one value.
SUM_PIECE = 8192


def packed(df: DataFrame, numbers: Callable[[pa.RecordBatch], np.ndarray]) -> DataFrame:
    """Column `packed`: the rows of `df` as numbers, a few rows to a value, written once for many passes.

    `numbers` makes a matrix of a batch, one line per row. Reading a row costs more than
    adding it up; packed, it is read with its neighbours as a piece of one array.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.ascontiguousarray(numbers(batch), dtype=float)
            step = max(1, PACKED_BYTES // (8 * x.shape[1]))
            values = [x[i : i + step].tobytes() for i in range(0, len(x), step)]
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.binary())], ["packed"])

    return materialize(df.mapInArrow(pack, "packed binary"), spread=True)


def unpacked(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """The rows of a batch of `packed`, as a matrix of `width` columns."""
    values = batch.column(0)
    _, places, data = values.buffers()
    wide = np.int64 if pa.types.is_large_binary(values.type) else np.int32
    at = np.frombuffer(places, wide)[values.offset : values.offset + len(values) + 1]
    first, last = (int(at[0]), int(at[-1])) if len(values) else (0, 0)
    if first == last:
        return np.zeros((0, width))
    return np.frombuffer(data[first:last], float).reshape(-1, width)


def block_sum(df: DataFrame, block: Callable[[Iterator[pa.RecordBatch]], np.ndarray], length: int) -> np.ndarray:
    """The sum over all tasks of the array of `length` numbers that `block` makes of a task's rows.

    A task sends one array; arrays meet by position, so no task and no driver holds more
    than one number per position and task. Zeros for an empty frame.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = np.asarray(block(batches), float)
        at = np.flatnonzero(values)
        # Cut up, so that a long array is no single large row.
        for i in range(0, len(at), 10_000):
            some = at[i : i + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(values[some])], ["at", "x"])

    parts = df.mapInArrow(partial, "at int, x double")
    total = np.zeros(length)
    for batch in parts.groupBy("at").agg(F.sum("x").alias("x")).toArrow().to_batches():
        total[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return total


def long_sum(df: DataFrame, block: Callable[[Iterator[pa.RecordBatch]], np.ndarray], length: int) -> np.ndarray:
    """The same for millions of numbers: they meet in pieces of SUM_PIECE, added up in the order of the tasks."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, task = np.asarray(block(batches), float), TaskContext.get().partitionId()
        for i in range(0, length, SUM_PIECE):
            piece = values[i : i + SUM_PIECE]
            if piece.any():
                yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([task]), pa.array([piece.tobytes()], pa.binary())], ["at", "task", "x"])

    def add(parts: pa.Table) -> pa.Table:
        parts = parts.sort_by("task")
        total = sum(np.frombuffer(x, float) for x in parts["x"].to_pylist())
        return pa.table({"at": parts["at"][:1], "x": pa.array([total.tobytes()], pa.binary())})

    parts = df.mapInArrow(partial, "at long, task long, x binary").groupBy("at").applyInArrow(add, "at long, x binary")
    total = np.zeros(length)
    for row in parts.toArrow().to_pylist():
        piece = np.frombuffer(row["x"], float)
        total[row["at"] : row["at"] + len(piece)] = piece
    return total


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of an array column of equal lengths as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)
