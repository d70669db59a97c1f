"""Arrow helpers for sparse vectors.

A vector column reaches an Arrow function as struct<type, size, indices, values>. Each helper
works on the flat index and value buffers of a whole batch, so there is no per-row Python.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

VECTOR_FIELDS = ("type", "size", "indices", "values")


def unpack(vectors: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row lengths, flat indices, flat values) of a batch of sparse vectors."""
    indices, values = vectors.field("indices"), vectors.field("values")
    lengths = np.asarray(indices.value_lengths().fill_null(0)).astype(np.int64)
    return lengths, np.asarray(indices.flatten()), np.asarray(values.flatten())


def row_ids(lengths: np.ndarray) -> np.ndarray:
    """Batch row of every flat entry."""
    return np.repeat(np.arange(len(lengths)), lengths)


def row_sums(lengths: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Sum of the flat entries of each row."""
    return np.bincount(row_ids(lengths), weights=entries, minlength=len(lengths))


def lists(lengths: np.ndarray, flat: pa.Array) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), flat)


def pack(
    size: int, lengths: np.ndarray, indices: np.ndarray, values: np.ndarray
) -> pa.StructArray:
    """Batch of sparse vectors of dimension ``size``."""
    rows = len(lengths)
    return pa.StructArray.from_arrays(
        [
            pa.array(np.zeros(rows, dtype=np.int8)),
            pa.array(np.full(rows, size, dtype=np.int32)),
            lists(lengths, pa.array(indices.astype(np.int32))),
            lists(lengths, pa.array(values.astype(np.float64))),
        ],
        names=list(VECTOR_FIELDS),
    )


def top_entries(
    lengths: np.ndarray, strength: np.ndarray, names: np.ndarray, keep: np.ndarray, n: int
) -> tuple[np.ndarray, np.ndarray]:
    """Flat positions of the ``n`` strongest kept entries per row, and how many each row has.

    Order: row, strength descending, name ascending.
    """
    rows = row_ids(lengths)
    chosen = np.flatnonzero(keep)
    order = np.lexsort((names[chosen], -strength[chosen], rows[chosen]))
    chosen = chosen[order]
    owner = rows[chosen]
    first = np.searchsorted(owner, np.arange(len(lengths)))
    place = np.arange(len(owner)) - first[owner]
    chosen = chosen[place < n]
    return chosen, np.bincount(rows[chosen], minlength=len(lengths))
