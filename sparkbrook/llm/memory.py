"""What a Python worker keeps between tasks.

Spark reuses workers, and an idle one stays beside the JVM that runs the next stage. What
a task has freed lies in the pools of Arrow and of the C library until something asks
for it back.
"""

from __future__ import annotations

import ctypes

import pyarrow as pa


def release() -> None:
    """Gives freed memory back to the system; where the C library has no such call, Arrow's part only."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def returning(run):
    """``run``, a function of ``mapInArrow``, with its memory given back when its rows end or its reader stops."""

    def whole(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return whole
