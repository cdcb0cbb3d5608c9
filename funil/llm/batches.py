"""Arrow batches cut into slices of bounded size, for functions that run inside tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 8 << 20

Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def give_back() -> None:
    """Return memory that is free, but kept by Arrow's pool or the C library, to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.pythonapi, "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def resting(run: Run) -> Run:
    """``run``, whose worker gives free memory back when a task ends: it stays, idle, while other stages need the memory."""

    def task(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(given)
        finally:
            give_back()

    return task


def slices(batches: Iterator[pa.RecordBatch], text_col: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices that hold about ``size`` bytes of text each, and one row at least."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_pylist()
        first = total = 0
        for row, length in enumerate(lengths):
            if row > first and total + length > size:
                yield batch.slice(first, row - first)
                first, total = row, 0
            total += length
        if first < len(lengths):
            yield batch.slice(first)


def texts(batch: pa.RecordBatch, text_col: str) -> list[str]:
    """The texts of a batch; null counts as empty."""
    return [t or "" for t in batch.column(text_col).to_pylist()]


def lists(parts: list[bytes], dtype: pa.DataType = pa.int32()) -> pa.ListArray:
    """One list per packed byte string, without a Python object per value."""
    width, offsets = dtype.bit_width // 8, [0]
    for part in parts:
        offsets.append(offsets[-1] + len(part) // width)
    values = pa.Array.from_buffers(dtype, offsets[-1], [None, pa.py_buffer(b"".join(parts))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def binary(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Byte strings out of one buffer of numbers: the numbers from each bound to the next."""
    ends = bounds.astype(np.int64) * values.itemsize
    if ends[-1] > np.iinfo(np.int32).max:
        raise ValueError("the byte strings of a batch are too long")
    return pa.Array.from_buffers(
        pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))]
    )
