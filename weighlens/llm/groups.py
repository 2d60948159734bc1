"""Rows of many small groups, a batch at a time, without a call per group."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables that end where a group ends, and where their groups begin.  Rows must come sorted by the keys; what is held
    is one batch and the group it ends in, so groups must be bounded."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, table]).combine_chunks() if rest is not None else table
        if not table.num_rows:
            continue
        new = _begins(table, keys)
        cut = int(new[-1])
        if cut:
            yield table.slice(0, cut), new[:-1]
        rest = table.slice(cut)
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks(), np.zeros(1, np.int64)


def _begins(table: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for k in keys:
        values = table.column(k).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def binary_rows(column: pa.ChunkedArray, dtype) -> np.ndarray:
    """Matrix of a column of equally long binary values."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(array, pa.ChunkedArray):
        array = pa.concat_arrays(array.chunks) if array.num_chunks else pa.array([], pa.binary())
    if not len(array):
        return np.zeros((0, 0), dtype)
    width = pc.binary_length(array[:1])[0].as_py()
    offsets = np.frombuffer(array.buffers()[1], np.int32)[array.offset: array.offset + len(array) + 1]
    data = np.frombuffer(array.buffers()[2], np.uint8)[offsets[0]: offsets[-1]]
    return np.ascontiguousarray(data).view(dtype).reshape(len(array), width // np.dtype(dtype).itemsize)


def forest(a: np.ndarray, b: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Positions of the pairs (a, b), taken in the given order, that join two trees; ``start`` labels what is joined already."""
    labels, at = np.unique(np.concatenate([start[a], start[b]]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    parent = list(range(len(labels)))

    def root(v):
        while parent[v] != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    keep: list[int] = []
    rest, step = np.arange(len(a)), 2048
    while len(rest):
        some, rest, step = rest[:step], rest[step:], 2 * step
        for n, v, w in zip(some.tolist(), x[some].tolist(), y[some].tolist()):
            v, w = root(v), root(w)
            if v != w:
                parent[max(v, w)] = min(v, w)
                keep.append(n)
        tops = np.fromiter(map(root, range(len(labels))), np.int64, len(labels))
        rest = rest[tops[x[rest]] != tops[y[rest]]]  # most pairs of a large group: joined by now
    return np.array(keep, np.int64)
