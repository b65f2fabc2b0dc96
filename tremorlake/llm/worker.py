"""What outlives one task inside a Python worker."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable
from typing import Any

_PLACE = "tremorlake_worker_state"


def _task() -> int | None:
    from pyspark import TaskContext

    context = TaskContext.get()
    return context.taskAttemptId() if context else None


def released() -> None:
    """Give memory that is free again back to the system."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def held(key: Any, make: Callable[[], Any]) -> Any:
    """The object of this worker under ``key``, made at first use.

    Functions shipped by value get fresh globals in every task; a module made in
    the worker does not. Workers are reused by later operators, so what the running task
    doesn't use is let go when something new is made: a worker holds one operator's state.
    """
    state = sys.modules.setdefault(_PLACE, types.ModuleType(_PLACE)).__dict__.setdefault("state", {})
    task = _task()
    if key not in state:
        idle = [k for k, (last, _) in state.items() if last != task]
        for k in idle:
            del state[k]
        if idle:
            released()
        state[key] = (task, make())
    found = state[key][1]
    state[key] = (task, found)
    return found


class Known(dict):
    """Texts and what was worked out for them; emptied when it has grown past a number of bytes.

    ``trim`` is to be called between blocks of bounded size, so nothing goes while it is needed.
    """

    # Two objects' heads and a place in the table.
    EACH = 200

    def __init__(self, most: int):
        super().__init__()
        self.most, self.bytes = most, 0

    def put(self, text: str, value: bytes) -> None:
        self[text] = value
        self.bytes += self.EACH + 2 * len(text) + len(value)

    def put_all(self, texts: list[str], values: list[bytes]) -> None:
        self.update(zip(texts, values))
        self.bytes += self.EACH * len(texts) + 2 * sum(map(len, texts)) + sum(map(len, values))

    def trim(self) -> None:
        if self.bytes > self.most:
            self.clear()
            self.bytes = 0
