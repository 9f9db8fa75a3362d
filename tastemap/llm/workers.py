"""The memory of a Python worker, which Spark hands on from job to job: what it keeps between tasks (the
tables of one operator), and what it gives back to the system."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa

_kept: dict[str, dict] = {}
_libc = None

#: Arrays of this size and more are mapped one by one, so freeing them returns their memory.
MAPPED_BYTES = 4 << 20
M_MMAP_THRESHOLD = -3  # fixed value: the option's number in the C library


def kept(kind: str) -> dict:
    """The worker's tables of ``kind``; those of other kinds are freed."""
    free(kind)
    return _kept.setdefault(kind, {})


def free(but: str | None = None) -> None:
    """Frees all tables but those of one kind, and returns unused memory to the system."""
    others = [kind for kind in _kept if kind != but]
    for kind in others:
        del _kept[kind]
    if others:
        gc.collect()
    trim()


def trim() -> None:
    """Returns unused memory to the system. Where the C library has no such calls, that is left to it."""
    global _libc
    pa.default_memory_pool().release_unused()
    try:
        if _libc is None:
            _libc = ctypes.CDLL(None)
            _libc.mallopt(M_MMAP_THRESHOLD, MAPPED_BYTES)
        _libc.malloc_trim(0)
    except (OSError, AttributeError):
        pass


def tidy(task: Callable[[Iterator], Iterator], but: str | None = None) -> Callable[[Iterator], Iterator]:
    """``task``, which frees memory before it starts and when it has ended, but for the tables of one kind. Spark
    hands tasks to idle workers in turn, and there are more of them than tasks at a time where a stage had
    several in a row: what a task leaves would count once for each of them."""

    def run(batches: Iterator) -> Iterator:
        free(but)
        try:
            yield from task(batches)
        finally:
            free(but)

    return run
