"""Record batches in parts of bounded text, so a worker holds little beside the batch itself."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

_c = ctypes.CDLL(None)
PART = 1 << 20  # bytes of text in a part; a longer text is a part of its own


def stretches(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Borders of runs of texts that hold about PART bytes."""
    size = np.fromiter((x or 0 for x in pa.compute.binary_length(column).to_pylist()), np.int64, len(column))
    number = np.cumsum(size) // PART
    edges = np.flatnonzero(np.diff(number)) + 1
    for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(column)]):
        if b > a:
            yield a, b


def texts_of(column: pa.Array) -> list[str]:
    """A null text is empty."""
    return [t or "" for t in column.to_pylist()]


def parts(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches with their texts. The memory that parts took goes back at the end."""
    for batch in batches:
        for a, b in stretches(batch.column(text)):
            some = batch.slice(a, b - a)
            yield some, texts_of(some.column(text))
    release()


def release() -> None:
    """Gives memory that a finished task no longer holds back to the system, as a worker waits for its next one."""
    pa.default_memory_pool().release_unused()
    if hasattr(_c, "malloc_trim"):
        _c.malloc_trim(0)
