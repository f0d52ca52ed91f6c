"""What a task gives back when it ends."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa

Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def give_back() -> None:
    """Return freed pages of Arrow's pool and, with glibc, of the heap to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def returning(run: Run) -> Run:
    """``run`` for mapInArrow, which gives back at its end what its allocators only hold.

    Python workers serve many tasks and stages. Without this each keeps the pages of its
    largest moment, beside those of the JVM and of the other workers of its executor.
    """

    @wraps(run)
    def returned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return returned
