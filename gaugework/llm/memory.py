"""What Python workers remember between tasks: one operator at a time, for a pipeline's stages share the workers."""

from __future__ import annotations

import ctypes
from collections.abc import Callable

_FORGET: dict[str, tuple[Callable[[], int], Callable[[], None]]] = {}


def remembered(owner: str, size: Callable[[], int], forget: Callable[[], None]) -> None:
    """Name a memory of this worker by its owner."""
    _FORGET[owner] = size, forget


def only(owner: str) -> None:
    """Drop what all other owners remember, and give it back to the system."""
    full = [forget for name, (size, forget) in _FORGET.items() if name != owner and size()]
    for forget in full:
        forget()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if full and trim is not None:
        trim(0)
