"""Numpy views of Arrow text batches: bytes, tokens, hashes, minimizers.

All functions work on the concatenated UTF-8 buffer of a batch, so there is no
Python loop over documents.  ``slices`` bounds what one call holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a single longer text forms a slice alone.
SLICE_BYTES = 1_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(int(_BASE), -1, 2 ** 64))
_CHUNK = 1 << 19


def strings(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; a null counts as empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, off, data = column.buffers()
    n = len(column)
    if not n:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(off, np.int64)[column.offset: column.offset + n + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return buf[offsets[0]: offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of whole rows with about ``size`` bytes of text."""
    n = batch.num_rows
    if not n:
        return
    col = batch.column(batch.schema.get_field_index(column))
    lens = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(lens.astype(np.int64))
    start = 0
    while start < n:
        base = total[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(total, base + size, "right")))
        yield batch.slice(start, end - start)
        start = end


@lru_cache(maxsize=4)
def byte_class(pattern: str) -> np.ndarray:
    """Lookup table of the bytes that belong to a word.

    ``blank``: words are runs of anything but \\x20 and \\x09-\\x0D.
    ``alnum``: runs of ASCII letters, digits and bytes above 0x7F."""
    t = np.ones(256, bool)
    if pattern == "blank":
        t[[0x20, 9, 10, 11, 12, 13]] = False
    elif pattern == "alnum":
        t[:0x80] = False
        for a, b in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A)):
            t[a: b + 1] = True
    else:
        raise ValueError(pattern)
    return t


def words(buf: np.ndarray, offsets: np.ndarray, pattern: str = "blank"):
    """(start, end, doc) of every word; words never cross documents."""
    starts, ends = [], []
    table = byte_class(pattern)
    edge = np.zeros(len(buf) + 1, bool)
    edge[offsets[(offsets < len(buf))]] = True
    carry = False
    for x in range(0, len(buf), _CHUNK):
        part = table[buf[x: x + _CHUNK]]
        before = np.empty_like(part)
        before[0], before[1:] = carry, part[:-1]
        cut = edge[x: x + len(part)]
        starts.append(np.flatnonzero(part & (~before | cut)) + x)
        ends.append(np.flatnonzero(before & (~part | cut)) + x)
        carry = bool(part[-1])
    if carry:
        ends.append(np.array([len(buf)]))
    if not starts:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    start, end = np.concatenate(starts), np.concatenate(ends)
    return start, end, np.searchsorted(offsets, start, "right") - 1


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    return np.where((buf >= 0x41) & (buf <= 0x5A), buf + 32, buf).astype(np.uint8)


@lru_cache(maxsize=8)
def _powers(n: int, inverse: bool) -> np.ndarray:
    p = np.full(n, _INV if inverse else _BASE, np.uint64)
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


def powers(n: int, inverse: bool = False) -> np.ndarray:
    size = 1 << 12
    while size < n:
        size *= 2
    return _powers(size, inverse)[:n]


@lru_cache(maxsize=1)
def byte_values() -> np.ndarray:
    """A fixed odd 64-bit number for each byte value."""
    return mix(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Prefix polynomial hashes modulo 2**64 (n + 1 entries)."""
    p = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values)), dtype=np.uint64, out=p[1:])
    return p


def span_hash(prefix: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Hash of values[lo:hi]; equal content gives equal hashes anywhere."""
    return (prefix[hi] - prefix[lo]) * powers(len(prefix), True)[lo]


def word_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of every word's bytes."""
    out = np.empty(len(start), np.uint64)
    val = byte_values()
    i = 0
    while i < len(start):
        x = start[i]
        j = max(i + 1, int(np.searchsorted(end, x + _CHUNK, "right")))
        p = prefix_hash(val[buf[x: end[j - 1]]])
        out[i:j] = mix(span_hash(p, start[i:j] - x, end[i:j] - x))
        i = j
    return out


def window_minima(h: np.ndarray, w: int) -> np.ndarray:
    """Position of the (leftmost) smallest hash in every run of ``w`` <= 512.
    Only the upper 55 bits are compared."""
    n = len(h)
    if n < w:
        return np.empty(0, np.int64)
    blocks = -(-n // w)
    low = np.uint64(511)
    key = np.full(blocks * w, np.uint64(2 ** 64 - 1))
    key[:n] = (h & ~low) | (np.arange(n, dtype=np.uint64) % np.uint64(w))
    key = key.reshape(blocks, w)
    pre = np.minimum.accumulate(key, axis=1).ravel()
    suf = np.minimum.accumulate(key[:, ::-1], axis=1)[:, ::-1].ravel()
    s = np.arange(n - w + 1)
    e = s + w - 1
    a, b = suf[s], pre[e]
    left = (a >> np.uint64(9)) <= (b >> np.uint64(9))
    return np.where(left, s - s % w + (a & low).astype(np.int64),
                    e - e % w + (b & low).astype(np.int64))
