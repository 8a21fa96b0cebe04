"""Streams over rows sorted by a hash: what equal hashes have in common, in bounded memory (used inside tasks)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def list_offsets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column end to end, and how many each row has (null: none)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null([]) if column.null_count else column
    return column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())


def long_lists(values: np.ndarray, counts: np.ndarray, none: np.ndarray) -> pa.Array:
    """A list column of longs; rows in ``none`` are null."""
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int64)), mask=pa.array(none))


def gather(keys: list[np.ndarray], *values: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], list[pa.Array]]:
    """Rows of a slice with equal keys become one, before they are shuffled.

    Returns the distinct keys, the values of their first row, and as a list column per value those of
    further rows. The first row is the one with the smallest first value.
    """
    order = np.lexsort((*reversed(values), *reversed(keys)))
    keys, values = [k[order] for k in keys], [v[order] for v in values]
    head = _changes(keys)
    counts = np.diff(np.append(np.flatnonzero(head), len(head))) - 1
    more = [long_lists(v[~head], counts, counts == 0) for v in values]
    return [k[head] for k in keys], [v[head] for v in values], more


def _changes(keys: list[np.ndarray]) -> np.ndarray:
    """Whether a row's keys differ from those of the row before it."""
    out = np.ones(len(keys[0]), bool)
    out[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return out


def expand(batch: pa.RecordBatch, keys: list[str], names: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Undo ``gather``: keys and values of all rows of a sorted batch, keys still together."""
    found = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
    firsts = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
    more = [list_offsets(batch.column(f"{n}_more")) for n in names]
    counts = more[0][1]
    if not counts.any():
        return found, firsts
    head = np.zeros(int((counts + 1).sum()), bool)
    head[np.concatenate(([0], np.cumsum(counts + 1)[:-1]))] = True
    out = []
    for f, (v, _) in zip(firsts, more, strict=True):
        column = np.empty(len(head), np.int64)
        column[head], column[~head] = f, v
        out.append(column)
    return [np.repeat(k, counts + 1) for k in found], out


def shared(batches: Iterator[pa.RecordBatch], keys: list[str], names: list[str]) -> Iterator[tuple[list[np.ndarray], list[np.ndarray], np.ndarray]]:
    """For batches sorted by (keys, first of ``names``): keys, values and the group's smallest first value.

    Rows of groups with a single first value are left out. Kept between batches: one row of the group that is open.
    """
    open_key, open_least, pending = None, None, None  # pending: the values of its rows so far, all with one first value
    for batch in batches:
        if batch.num_rows == 0:
            continue
        found, values = expand(batch, keys, names)
        begin = np.flatnonzero(_changes(found))
        sizes = np.diff(np.append(begin, len(found[0])))
        least = np.minimum.reduceat(values[0], begin)
        most = np.maximum.reduceat(values[0], begin)
        goes_on = open_key is not None and open_key == tuple(int(k[0]) for k in found)
        if goes_on:
            least[0] = min(least[0], open_least)
            if pending is not None and most[0] != least[0]:
                n = len(pending[0])
                yield [np.full(n, k) for k in open_key], pending, np.full(n, open_least)
                pending = None
            alone = most[0] == least[0] and pending is not None
            keep = np.repeat(np.concatenate(([not alone], most[1:] != least[1:])), sizes)
        else:
            pending = None
            keep = np.repeat(most != least, sizes)
        yield [k[keep] for k in found], [v[keep] for v in values], np.repeat(least, sizes)[keep]
        last = slice(begin[-1], None)
        if not keep[-1]:
            rows = [v[last] for v in values]
            pending = [np.concatenate((a, b)) for a, b in zip(pending, rows, strict=True)] if len(begin) == 1 and goes_on and pending is not None else rows
        else:
            pending = None
        open_key, open_least = tuple(int(k[-1]) for k in found), least[-1]
