"""Bounded slices and raw UTF-8 of Arrow string columns, for functions given to mapInArrow."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql.types import StructType

SLICE_BYTES = 2 << 20

_owner: list = ["", None]


def claim(owner: str, free: Callable[[], None]) -> None:
    """Say, in a worker, whose caches are in use from now on. Those of another operator, which a
    worker that is used again still holds, are freed, and the room goes back to the system."""
    if _owner[0] != owner:
        if _owner[1] is not None:
            _owner[1]()
        _owner[:] = [owner, free]
        settle()


def settle() -> None:
    """Give memory that is no longer used back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def _libc_trim():
    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):  # not glibc
        return None


_trim = _libc_trim()


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES, rows: int = 1 << 30) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each slice holds about ``limit`` bytes of ``column``, or one row, and at
    most ``rows`` rows."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, min(start + rows, int(np.searchsorted(ends, before + limit, "right"))))
            yield batch.slice(start, stop - start)
            start = stop
    settle()


def strings(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The column as Python strings, null as the empty one."""
    return [x or "" for x in batch.column(column).to_pylist()]


def utf8(batch: pa.RecordBatch, column: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column one after the other, and where each row starts
    (one more entry than rows). Null counts as empty."""
    values = batch.column(column)
    if values.null_count:
        values = pc.fill_null(values, b"" if pa.types.is_binary(values.type) or pa.types.is_large_binary(values.type) else "")
    wide = pa.types.is_large_string(values.type) or pa.types.is_large_binary(values.type)
    _, offsets, data = values.buffers()
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[values.offset : values.offset + len(values) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] else np.zeros(0, np.uint8)
    return raw, at - at[0]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The integers of all half-open ranges, one range after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    return np.arange(total, dtype=np.int64) + shift


def extended(schema: StructType, columns: str) -> StructType:
    """The schema with more columns, given as DDL."""
    return StructType([*schema.fields, *StructType.fromDDL(columns).fields])
