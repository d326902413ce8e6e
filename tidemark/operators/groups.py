"""Whole groups out of sorted Arrow batches, for functions that work on many small groups at a time."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

ROWS = 100_000


def starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """The first row of every group of a table that is sorted by these columns; null keys are keys."""
    new = np.zeros(len(table), bool)
    new[:1] = True
    for k in keys:
        codes = table.column(k).combine_chunks().dictionary_encode()
        codes = (codes.combine_chunks() if isinstance(codes, pa.ChunkedArray) else codes).indices.fill_null(-1).to_numpy(zero_copy_only=False)
        new[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(new)


def whole_groups(batches: Iterable[pa.RecordBatch], keys: list[str], rows: int = ROWS) -> Iterator[pa.Table]:
    """Tables of at least so many rows, but for the last, that no group crosses. A group must fit in memory."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        held.append(b)
        if sum(map(len, held)) >= rows:
            table = pa.Table.from_batches(held)
            cut = int(starts(table, keys)[-1])
            if cut:
                yield table.slice(0, cut)
            held = table.slice(cut).combine_chunks().to_batches()
    if any(map(len, held)):
        yield pa.Table.from_batches(held)
