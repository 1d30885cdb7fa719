"""Memory of the tasks: computed values of recurring keys within a bound, and freed memory handed back."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Hashable
from typing import Any

import pyarrow as pa


def hand_back() -> None:
    """Gives memory that was freed back to the system. Allocators keep it otherwise, and a worker lives on through the tasks of later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


class Recent(dict):
    """Values by key, computed when first asked for. When `size` are held, those not asked for since the last time go."""

    def __init__(self, compute: Callable[[Any], Any] | None = None, size: int = 200_000):
        super().__init__()
        self.compute, self.size, self.before = compute, size, {}

    def kept(self, key: Hashable) -> Any:
        """The value, or None; nothing goes for it."""
        return self.get(key) or self.before.get(key)

    def keep(self, key: Hashable, value: Any) -> None:
        if len(self) >= self.size:
            self.before = dict(self)
            self.clear()
        self[key] = value

    def __missing__(self, key: Hashable) -> Any:
        value = self.before.get(key)
        if value is None:
            value = self.compute(key)
        self.keep(key, value)
        return value
