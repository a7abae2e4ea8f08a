"""Arrow batches in small parts, so that a Python worker holds few objects at a time."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

#: Rows that are Python objects at once; a batch may hold many more.
SLICE_ROWS = 128


def slices(batch: pa.Array, rows: int = SLICE_ROWS) -> Iterator[list]:
    """The values of ``batch`` as lists of at most ``rows``."""
    for at in range(0, len(batch), rows):
        yield batch.slice(at, rows).to_pylist()


def lists(values: list, kind: pa.DataType) -> pa.ListArray:
    """An array of lists from numpy arrays, without an object per number."""
    ends = [0]
    for value in values:
        ends.append(ends[-1] + len(value))
    flat = [pa.array(value, type=kind) for value in values]
    return pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), pa.concat_arrays(flat) if flat else pa.array([], kind))
