"""Sums of products per key from Arrow batches, without a Python call per key.

A task gathers rows up to a bound, sorts them by key and reduces all keys at once:
long groups by a matrix product, short ones by sums over the outer products of
their rows.  A key gives one set of sums for each such gathering, whatever the
number of keys; a partial aggregation in Spark adds them up.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd

#: Values (rows x columns) gathered before they are reduced (32 MB).
GATHERED = 4_000_000
#: Rows from which a group is reduced on its own, and rows of short groups at once.
_LONG = 32
_ROWS = 4096


def gathered(batches: Iterator[pd.DataFrame], columns: int) -> Iterator[pd.DataFrame]:
    """The batches of a task in frames of about ``GATHERED`` values."""
    held, rows = [], 0
    for pdf in batches:
        held.append(pdf)
        rows += len(pdf)
        if rows * columns >= GATHERED:
            yield pd.concat(held, ignore_index=True)
            held, rows = [], 0
    if rows:
        yield pd.concat(held, ignore_index=True)


def grouped(pdf: pd.DataFrame, keys: Sequence[str]) -> tuple[pd.DataFrame, np.ndarray, pd.DataFrame]:
    """(rows sorted by key, where each key's begin, key values); a null key is a
    key, and without keys all rows are one group."""
    if not keys:
        return pdf, np.zeros(1, np.int64), pd.DataFrame(index=[0])
    code = pdf.groupby(list(keys), dropna=False, sort=False).ngroup().to_numpy()
    pdf = pdf.iloc[np.argsort(code, kind="stable")]
    code = np.sort(code)
    start = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
    return pdf, start, pdf[list(keys)].iloc[start].reset_index(drop=True)


def reduced(start: np.ndarray, rows: int, long, short, shape: tuple[int, ...]) -> np.ndarray:
    """One array of ``shape`` for each group: ``long(slice)`` of a long group,
    ``short(rows, starts)`` of blocks of short ones."""
    size = np.diff(np.append(start, rows))
    out = np.empty((len(start), *shape))
    for g in np.flatnonzero(size >= _LONG):
        out[g] = long(slice(start[g], start[g] + size[g]))
    small = np.flatnonzero(size < _LONG)
    block = np.cumsum(size[small]) // _ROWS
    for b in np.unique(block):
        g = small[block == b]
        n = size[g]
        first = np.cumsum(n) - n
        out[g] = short(np.arange(n.sum()) - np.repeat(first, n) + np.repeat(start[g], n), first)
    return out


def products(a: np.ndarray, b: np.ndarray, start: np.ndarray) -> np.ndarray:
    """a' b of each group."""
    return reduced(start, len(a), lambda s: a[s].T @ b[s],
                   lambda r, first: np.add.reduceat(a[r][:, :, None] * b[r][:, None, :], first, axis=0),
                   (a.shape[1], b.shape[1]))
