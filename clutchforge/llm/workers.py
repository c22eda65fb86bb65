"""Python workers outlive their tasks: what a task leaves behind must be given back."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa


def give_back() -> None:
    """Return the memory this process has freed to the system. Allocators keep it
    otherwise, and over the stages of a job that adds up on every executor."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function from batches to batches that gives memory back when its task ends."""
    @functools.wraps(run)
    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            give_back()
    return tidied
