"""What a worker process holds: it outlives its tasks, and so would freed memory that it keeps."""

from __future__ import annotations

import ctypes

import pyarrow as pa


def trim() -> None:
    """Give freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    freed = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
    if freed is not None:
        freed(0)
