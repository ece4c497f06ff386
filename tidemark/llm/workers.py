"""What a Python worker keeps between tasks, and what it gives back.

Spark uses a worker again for whatever operator comes next, and an idle one lives
on for a while.  What one operator keeps for its next task would weigh on all
that run after it, so it goes when a task of another operator begins, and memory
that a task freed is given back when it ends.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa

Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

_kept: dict[str, dict] = {}


def kept(owner: str) -> dict:
    """What ``owner`` keeps in this worker; what others kept goes."""
    others = [name for name in _kept if name != owner]
    for name in others:
        del _kept[name]
    if others:
        gc.collect()
        give_back()
    return _kept.setdefault(owner, {})


def give_back() -> None:
    """Freed memory goes back to the system, where the C library can do so."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(owner: str, run: Task) -> Task:
    """``run`` as a task of ``owner``, which leaves no more than ``owner`` keeps."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept(owner)
        yield from run(batches)
        give_back()

    return task
