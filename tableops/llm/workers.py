"""What operators keep in a Python worker for its next tasks.

Spark uses a worker again for tasks of other operators, and an executor holds
several workers: what one operator left (a tokenizer with its units, tables of
powers) would stay beside the next one's model.  ``kept`` holds such objects,
``release`` lets them go and returns the unused memory of Arrow and of the C
library, which Python and numpy would keep, to the system.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Hashable, Iterator
from typing import Any

import pyarrow as pa

_KEPT: dict[Hashable, Any] = {}


def kept(key: Hashable, make: Callable[[], Any]) -> Any:
    """The worker's object of this key, made where it is not there."""
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]


def release() -> None:
    """Let go what tasks of this worker have kept; a later task makes it anew."""
    _KEPT.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the GNU library has it
    if trim is not None:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` over a task's batches, with ``release`` before and after: a worker
    that waits for its next task beside working ones holds little."""
    @functools.wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        yield from run(batches)
        release()
    return task
