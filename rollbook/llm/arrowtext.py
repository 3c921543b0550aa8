"""Slices of Arrow string columns that stay small whatever the texts' lengths."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The C library, where it is one that keeps freed memory.
_LIBRARY = ctypes.CDLL(None) if sys.platform.startswith("linux") else None

#: Bytes of text worked on at once, in a Python worker; one longer text is a slice of its own.
SLICE_BYTES = 1 << 20


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows that together hold about ``limit`` bytes of ``column``."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False))
    at, rows = 0, batch.num_rows
    while at < rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to
    release()


def release() -> None:
    """Gives memory that was freed back to the system, Arrow's pool first: workers live on from stage to stage."""
    pa.default_memory_pool().release_unused()
    trim = getattr(_LIBRARY, "malloc_trim", None)
    if trim is not None:
        trim(0)


def buffers(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
    """All texts' bytes one after another, and the rows' offsets into them; null is empty."""
    array = pc.fill_null(batch.column(column), "").cast(pa.large_string())
    offsets = np.frombuffer(array.buffers()[1], dtype=np.int64)[array.offset : array.offset + len(array) + 1]
    data = array.buffers()[2]
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = int(offsets[0]) if len(offsets) else 0
    last = int(offsets[-1]) if len(offsets) else 0
    return flat[first:last], offsets - first


def texts(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts; null is empty."""
    return [x or "" for x in batch.column(column).to_pylist()]
