"""Workers that hand their memory back when a task ends: they stay alive beside the stages that follow."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa


def hand_back() -> None:
    """Return what the allocators keep for later; without effect where the C library has no such call."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(step: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A step over the batches of a task that hands memory back after its last batch."""
    @wraps(step)
    def run(batches: Iterator) -> Iterator:
        try:
            yield from step(batches)
        finally:
            hand_back()

    return run
