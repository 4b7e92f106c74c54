"""Arrow helpers for tasks: text columns as bytes, and whole groups of a sorted stream."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from mailsieve.session import bounded_batches  # noqa: F401 - Arrow helpers are taken from here

SLICE_BYTES = 1 << 20


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its rows; a null row is empty."""
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    at = at.astype(np.int64)
    if data is None or at[-1] == at[0]:
        return np.empty(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of ``batch`` with about ``limit`` bytes of text each (one row may hold more)."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0))
    start, held = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if held and held + size > limit:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups with the groups' bounds, from batches sorted by ``key`` (no nulls).

    Holds one group and one batch at a time: callers bound the group by their choice of key.
    """
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.asarray(batch.column(key))
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        if not held or keys[0] != last:
            ready, rest = held, batch
            if cuts.size:
                ready, rest = [*held, batch.slice(0, int(cuts[-1]))], batch.slice(int(cuts[-1]))
        elif cuts.size:
            ready, rest = [*held, batch.slice(0, int(cuts[-1]))], batch.slice(int(cuts[-1]))
        else:
            held.append(batch)
            continue
        if ready:
            yield _bounded(ready, key)
        held, last = [rest], keys[-1]
    if held:
        yield _bounded(held, key)


def _bounded(parts: list[pa.RecordBatch], key: str) -> tuple[pa.Table, np.ndarray]:
    table = pa.Table.from_batches(parts).combine_chunks()
    keys = np.asarray(table.column(key))
    inner = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    return table, np.concatenate([[0], inner, [len(keys)]])
