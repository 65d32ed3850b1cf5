"""Exact substring dedup on bytes by hash-compared suffix sorting.

Of all suffixes, only those in groups with a common core can repeat (see
``repeats``).  Each group is sorted by a mergesort whose comparisons are
logarithmic: prefix polynomial hashes and a binary search find how far two
suffixes agree, and the next byte decides.  Neighbours in the sorted order that
agree over a whole window repeat; their bytes are compared, so that a collision
of prefix hashes can't remove anything.  Copies of equal contexts don't get here:
``repeats`` finds them by 64-bit hashes and compares no bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import text as tx
from tidemark.llm.common import arrow, keyed, table
from tidemark.llm.repeats import Windows, offsets_of, removed, repeated_spans

WINDOW = 400
#: Bytes of an anchor (see ``repeats``).
GRAM = 100


class Suffixes:
    """Comparisons of suffixes of ``buf`` up to ``depth`` bytes."""

    def __init__(self, buf: np.ndarray, depth: int):
        self.buf, self.depth = buf, depth
        self.prefix = tx.prefix_hash(tx.byte_values()[buf])
        self.inverse = tx.powers(len(self.prefix), True)

    def same(self, x: np.ndarray, y: np.ndarray, n: np.ndarray | int) -> np.ndarray:
        p, q = self.prefix, self.inverse
        return (p[x + n] - p[x]) * q[x] == (p[y + n] - p[y]) * q[y]

    def agree(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the common extension of each pair, by binary search."""
        lo = np.zeros(len(x), np.int64)
        hi = np.where(self.same(x, y, self.depth), self.depth, self.depth - 1)
        lo[hi == self.depth] = self.depth
        todo = np.flatnonzero(lo < hi)
        while len(todo):
            mid = (lo[todo] + hi[todo] + 1) >> 1
            ok = self.same(x[todo], y[todo], mid)
            lo[todo[ok]] = mid[ok]
            hi[todo[~ok]] = mid[~ok] - 1
            todo = todo[lo[todo] < hi[todo]]
        return lo

    def less(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(x < y, x = y) up to the depth."""
        n = self.agree(x, y)
        end = n == self.depth
        at = np.where(end, 0, n)
        return ~end & (self.buf[x + at] < self.buf[y + at]), end

    def sort(self, start: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Stable bottom-up mergesort of each group ``first .. first + size``,
        all groups at once: an element's place in a merged run is its place in
        its own run plus its rank in the other one."""
        out = start.copy()
        run = 1
        group = np.repeat(np.arange(len(size)), size)
        place = np.arange(len(start)) - first[group]
        while len(size) and run < size.max():
            live = np.flatnonzero(size[group] > run)
            p, g = place[live], group[live]
            left = (p // run) % 2 == 0
            other = np.where(left, (p // run + 1) * run, (p // run - 1) * run)
            lo = np.zeros(len(live), np.int64)
            hi = np.clip(size[g] - other, 0, run)
            x, base = out[live], first[g] + other
            todo = np.flatnonzero(lo < hi)
            while len(todo):
                mid = (lo[todo] + hi[todo]) >> 1
                lt, eq = self.less(out[base[todo] + mid], x[todo])
                below = lt | (eq & ~left[todo])
                lo[todo[below]] = mid[below] + 1
                hi[todo[~below]] = mid[~below]
                todo = todo[lo[todo] < hi[todo]]
            to = first[g] + p // (2 * run) * (2 * run) + p % run + lo
            merged = out.copy()
            merged[to] = x
            out = merged
            run *= 2
        return out


def _equal_bytes(buf: np.ndarray, x: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    out = np.empty(len(x), bool)
    at = np.arange(n)
    for i in range(0, len(x), 8192):
        out[i: i + 8192] = (buf[x[i: i + 8192, None] + at] == buf[y[i: i + 8192, None] + at]).all(axis=1)
    return out


def resolve(spec: Windows, group, low, high, lft, order, buf, off):
    """Windows of the contexts that another one has too."""
    row, o = offsets_of(low, high)
    by = np.lexsort((o, group[row]))  # windows at different offsets never agree
    row, o = row[by], o[by]
    g = group[row]
    new = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (o[1:] != o[:-1])])[:len(g)])
    size = np.diff(np.concatenate([new, [len(g)]]))
    start = off[row] + lft[row] - o
    suffixes = Suffixes(buf, spec.window)
    ranked = suffixes.sort(start, new, size)
    own = np.repeat(np.arange(len(size)), size)
    pair = np.flatnonzero((own[1:] == own[:-1]) & suffixes.same(ranked[1:], ranked[:-1], spec.window)) \
        if len(ranked) else np.empty(0, np.int64)
    true = _equal_bytes(buf, ranked[pair], ranked[pair + 1], spec.window)
    if not true.all():  # a collision may have misplaced a suffix: compare the bytes of all
        window = np.array([bytes(buf[s: s + spec.window]) for s in start], object)
        _, inverse, count = np.unique(window, return_inverse=True, return_counts=True)
        again = count[inverse] > 1
        return row[again], o[again]
    hit = np.zeros(len(ranked), bool)
    hit[pair] = hit[pair + 1] = True
    known = np.isin(start, ranked[hit])
    return row[known], o[known]


def _digest(keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tx.slices(batch, "text"):
                names = part.schema.names
                buf, off = tx.strings(part.column(names.index("text")))
                n = np.diff(off)
                cuts = removed(part.column(names.index("spans")), n)
                kept = []
                for i, (a, b) in enumerate(cuts):
                    text = bytes(buf[off[i]: off[i + 1]])
                    kept.append(b"".join(text[s:e] for s, e in zip([0, *b], [*a, len(text)], strict=True)))
                yield pa.RecordBatch.from_arrays([
                    part.column(names.index("doc_id")), pa.array(n),
                    pa.array([int((b - a).sum()) for a, b in cuts], pa.int64()),
                    pa.array([len(a) for a, _ in cuts], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in kept]),
                    pa.array([x if keep_text else None for x in kept], pa.binary()),
                ], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, group_rows: int = 4096,
                   keep_text: bool = True) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` for every row:
    each UTF-8 byte covered by a ``window``-byte string that also starts anywhere
    else is removed, all copies alike; ``kept`` holds the remaining bytes (which
    may end inside a character; null unless ``keep_text``).  ``window`` may be at
    most 511 bytes longer than ``gram`` (else ValueError).

    A null text counts as empty.  Rows that repeat an id and a text are one
    document: they don't repeat each other, and each gets its result.  Rows that
    share an id but not the text are different documents.  Other columns are not
    read; an empty table gives no rows.
    """
    spec = Windows("bytes", window, gram, every=True, group_rows=group_rows)
    rows = keyed(docs)
    spans = repeated_spans(rows, spec, resolve, "suffixes")
    kind = dict(docs.dtypes)["doc_id"]
    return arrow(rows.join(spans, ["_d", "_h"], "left"), _digest(keep_text),
                 f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), keep_text=False).drop("kept")


ORACLE = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, md5(substr(h, 2 * i - 1, 800)) AS g
      FROM (SELECT doc_id, h, unnest(range(1, length(h) // 2 - 398)) AS i FROM d WHERE length(h) >= 800)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY g) AS c FROM w) WHERE c > 1),
m AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM r),
s AS (SELECT doc_id, i, sum(CASE WHEN before IS NULL OR i > before + 400 THEN 1 ELSE 0 END)
        OVER (PARTITION BY doc_id ORDER BY i) AS run FROM m),
x AS (SELECT doc_id, run, min(i) AS a, max(i) + 400 AS b FROM s GROUP BY doc_id, run),
y AS (SELECT doc_id, a, b, lag(b, 1, 1) OVER (PARTITION BY doc_id ORDER BY a) AS from_ FROM x),
k AS (SELECT doc_id, count(*) AS n_spans, sum(b - a)::BIGINT AS n_removed, max(b) AS last,
             string_agg(substr(h, 2 * from_ - 1, 2 * (a - from_)), '' ORDER BY a) AS head
      FROM y JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed,
       coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN last IS NULL THEN h ELSE head || substr(h, 2 * last - 1) END)) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""
