"""Giving back the memory that a task no longer needs.

A Python worker outlives its task, and memory that was freed in it stays with it unless the
allocators are told; on an executor that runs one kind of work after another that adds up.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa

Work = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def release() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def releasing(work: Work) -> Work:
    """``work`` on the batches of a task, with what it used given back at the end."""

    @wraps(work)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            release()

    return run
