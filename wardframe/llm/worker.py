"""Memory of Python workers, which Spark hands from one operator to the next."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

import pyarrow as pa

_FORGET: dict[str, Callable[[], None]] = {}
_serving: str | None = None


def remembers(operator: str, forget: Callable[[], None]) -> None:
    """Says how to give up what an operator keeps in a worker."""
    _FORGET[operator] = forget


def serve(operator: str) -> None:
    """Call where a task starts: what other operators have kept in this worker goes."""
    global _serving
    if _serving != operator:
        for other, forget in _FORGET.items():
            if other != operator:
                forget()
        gc.collect()
        _return_freed()
        _serving = operator
    pa.default_memory_pool().release_unused()


def _return_freed() -> None:
    """Hands freed pages back to the system where the C library knows how to."""
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass
