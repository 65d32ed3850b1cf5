"""Repeated windows of text: what substring operators have in common.

A window is ``window`` consecutive units (words or bytes) of one document.
Equal windows are found without shuffling all of them:

1. The anchor of a window is the start of its smallest-hashed run of ``gram``
   units.  It depends on the window's content only, so equal windows have equal
   anchors at equal places.  Adjoining windows share anchors; a document of n
   units has about ``2n / (window - gram + 2)``.
2. Only anchors whose gram occurs twice or more can stand for repeats.
3. The context of an anchor holds all windows that may be anchored there.
   Anchors are counted by gram and context; where a gram has one context, every
   window of every copy repeats, and no text is needed.
4. Where a gram has several contexts, the texts of the distinct ones (one copy
   of each) meet in a group, and a resolver finds the windows that they share.

A group larger than ``group_rows`` is split (see ``grouped``): half of the offsets
that a window may have from the anchor fix a longer common core, whose hash is the
new key.  At a single offset the core is the whole window, and one context is left.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import text as tx
from tidemark.llm.common import arrow, written

_CHUNK = 1 << 19
_GROUP_BYTES = 2_000_000
_KEY = ["k", "c"]
_AT = ("_d", "_h", "at")


@dataclass(frozen=True)
class Windows:
    """unit: ``words`` or ``bytes``; every: whether all copies of a window count
    as repeats, or all but the first."""
    unit: str
    window: int
    gram: int
    every: bool
    group_rows: int = 4096

    def __post_init__(self):
        if not 0 <= self.reach < 512 or self.gram < 1:
            raise ValueError("a window may be at most 511 units longer than its gram")

    @property
    def reach(self) -> int:
        """Largest offset of an anchor in its window."""
        return self.window - self.gram


def units(spec: Windows, buf: np.ndarray, off: np.ndarray):
    """(number of units, unit offsets of the documents, values of a range)."""
    if spec.unit == "bytes":
        val = tx.byte_values()
        return len(buf), off, lambda a, b: val[buf[a:b]]
    start, end, doc = tx.words(buf, off)
    h = tx.word_hashes(buf, start, end)
    return len(start), np.searchsorted(doc, np.arange(len(off))), lambda a, b: h[a:b]


def anchors(spec: Windows, n: int, off: np.ndarray, values) -> tuple[np.ndarray, ...]:
    """(doc, anchor, first window, last window, gram hash, context hash) of the
    windows' runs with one anchor; positions count from the document's start."""
    w, out = spec.window, [tuple(np.empty(0, t) for t in (np.int64,) * 4 + (np.uint64,) * 2)]
    for x in range(0, n, _CHUNK):
        lo, hi = max(0, x - w), min(n, x + _CHUNK + 2 * w)
        p = tx.prefix_hash(values(lo, hi))
        s = np.arange(x, min(x + _CHUNK, n - w + 1))
        if not len(s):
            continue
        g = np.arange(x - lo, min(x + _CHUNK + w, n) - lo - spec.gram + 1)
        h = tx.mix(tx.span_hash(p, g, g + spec.gram))
        at = tx.window_minima(h, spec.reach + 1)[:len(s)] + x
        s = s[:len(at)]
        doc = np.searchsorted(off, s, "right") - 1
        ok = s + w <= off[doc + 1]
        s, at, doc = s[ok], at[ok], doc[ok]
        new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])])) \
            if len(s) else np.empty(0, np.int64)
        last = np.concatenate([new[1:], [len(s)]]) - 1 if len(new) else new
        a, d = at[new], doc[new]
        left = np.maximum(off[d], a - spec.reach)
        right = np.minimum(off[d + 1], a + w)
        c = tx.mix(tx.span_hash(p, left - lo, right - lo) + (a - left).astype(np.uint64))
        out.append((d, a - off[d], s[new] - off[d], s[last] - off[d], h[a - x], c))
    d, a, first, last, k, c = (np.concatenate(x) for x in zip(*out, strict=True))
    # a run that a chunk's border cuts in two is one
    new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (d[1:] != d[:-1])])) if len(a) else a
    end = np.concatenate([new[1:], [len(a)]])[:len(new)] - 1
    return d[new], a[new], first[new], last[end], k[new], c[new]


def _find(spec: Windows):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tx.slices(batch, "text"):
                buf, off = tx.strings(part.column(1))
                ids = [part.column(i).to_numpy(zero_copy_only=False) for i in (2, 3)]
                d, a, first, last, k, c = anchors(spec, *units(spec, buf, off))
                at = a << 20 | (a - first) << 10 | (a - last)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (k.view(np.int64), c.view(np.int64), ids[0][d], ids[1][d], at)],
                    ["k", "c", "_d", "_h", "at"])
    return run


def _contexts(spec: Windows):
    """Cuts the contexts of a document's anchors out of its text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tx.slices(batch, "text"):
                names = part.schema.names
                buf, off = tx.strings(part.column(names.index("text")))
                want = part.column(names.index("want"))
                doc = np.repeat(np.arange(part.num_rows), pc.list_value_length(want).to_numpy())
                k, c, n, at = (x.to_numpy() for x in want.flatten().flatten())
                edge = off
                if spec.unit == "words":
                    start, end, owner = tx.words(buf, off)
                    edge = np.searchsorted(owner, np.arange(len(off)))
                a = edge[doc] + (at >> 20)
                lo, hi = np.maximum(edge[doc], a - spec.reach), np.minimum(edge[doc + 1], a + spec.window)
                if spec.unit == "words":
                    text = [b" ".join(bytes(buf[start[x]: end[y - 1]]).split())
                            for x, y in zip(lo, hi, strict=True)]
                else:
                    text = [bytes(buf[x:y]) for x, y in zip(lo, hi, strict=True)]
                ids = [part.column(names.index(x)).to_numpy(zero_copy_only=False)[doc] for x in ("_d", "_h")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k), pa.array(c), pa.array(n), pa.array(ids[0]), pa.array(ids[1]), pa.array(at),
                     pa.array((a - lo).astype(np.int32)), pa.array(text, pa.binary())],
                    ["k", "c", "n", "_d", "_h", "at", "lft", "ctx"])
    return run


def _part(spec: Windows, first, last):
    """Hash of the context from ``first`` units before the anchor to the end of
    the window that begins ``last`` units before it."""
    start, size = F.col("lft") - first + 1, F.lit(spec.window) - last + first
    text = F.col("ctx") if spec.unit == "bytes" else F.split(F.col("ctx").cast("string"), " ")
    part = F.substring(text, start, size) if spec.unit == "bytes" else F.slice(text, start, size)
    return F.xxhash64("key", "low", "high", first, last, part)


def grouped(contexts: DataFrame, spec: Windows) -> tuple[DataFrame, list[DataFrame]]:
    """Contexts with a group ``key`` and offsets ``low..high`` such that no group
    is larger than ``group_rows``, and tables of spans that repeat (``_d, _h, a,
    b``) found while larger groups were split.

    A split halves the offsets.  The windows of a half have a longer core in
    common, whose hash is the new key.  Contexts that agree over the whole half
    repeat each other there: one of them goes on.  So a passage that a great many
    documents share leaves few rows, and a context is in few groups."""
    todo = contexts.withColumns({"key": F.col("k"), "low": F.lit(0), "high": F.lit(spec.reach)})
    done, spans = None, []
    own_low, own_high = F.col("at").bitwiseAND(F.lit(1023)), F.shiftright("at", 10).bitwiseAND(F.lit(1023))
    low, high = F.greatest(F.col("low"), own_low.cast("int")), F.least(F.col("high"), own_high.cast("int"))
    while True:
        big = todo.groupBy("key").count().where(F.col("count") > spec.group_rows).select("key")
        if big.isEmpty():
            return todo if done is None else done.unionByName(todo), spans
        big = written(big, "repeats-big")
        rest = todo.join(big, "key", "left_anti")
        done = rest if done is None else done.unionByName(rest)
        mid = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
        halves = todo.join(big, "key").withColumn("half", F.explode(F.array(
            F.struct(F.col("low").alias("a"), mid.alias("b")),
            F.struct((mid + 1).alias("a"), F.col("high").alias("b")))))
        halves = halves.withColumns({"low": F.col("half.a"), "high": F.col("half.b")}).drop("half")
        # windows at other offsets than the anchor's own have another anchor
        halves = halves.where(low <= high).withColumn("key", _part(spec, F.col("low"), F.col("high")))
        halves = written(halves.withColumn("hull", _part(spec, high, low)), "repeats-halves")
        same = written(halves.groupBy("key", "hull").agg(F.count("*").alias("m"), F.min(F.struct(*_AT)).alias("o")),
                       "repeats-hulls")
        again = halves.join(same.where("m > 1"), ["key", "hull"])
        if not spec.every:
            again = again.where(~F.col("o").eqNullSafe(F.struct(*_AT)))
        at = F.shiftright("at", 20)
        spans.append(again.select("_d", "_h", (at - high).alias("a"), (at - low + spec.window).alias("b")))
        first = same.select("key", "hull", *[F.col(f"o.{c}").alias(f"o_{c}") for c in _AT])
        todo = halves.join(first, ["key", "hull"]).where(
            " AND ".join(f"{c} = o_{c}" for c in _AT)).drop("hull", *[f"o_{c}" for c in _AT])
        todo = written(todo, "repeats-left")


#: (spec, group, low, high, lft, order, bytes, offsets) of the contexts of whole
#: groups -> (row, offset) of the windows that repeat, in any order.  The windows of a context begin low..high units before its anchor, which is its
#: unit number ``lft``.
Resolver = Callable[..., tuple[np.ndarray, np.ndarray]]


def offsets_of(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, offset) of every window of every context."""
    n = np.maximum(high - low + 1, 0)
    row = np.repeat(np.arange(len(n)), n)
    return row, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + low[row]


def _runs(row: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first, last) of the runs of adjoining offsets."""
    order = np.lexsort((offset, row))
    row, offset = row[order], offset[order]
    new = np.concatenate([[True], (row[1:] != row[:-1]) | (offset[1:] != offset[:-1] + 1)])[:len(row)]
    return row[new], offset[new], offset[np.concatenate([new[1:], [True]])[:len(row)]]


def _resolve(spec: Windows, resolver: Resolver):
    def spans(rows: pa.Table) -> pa.RecordBatch:
        col = {n: rows.column(n).to_numpy() for n in ("key", "low", "high", "lft", "_d", "_h", "at")}
        gid = np.cumsum(np.concatenate([[0], col["key"][1:] != col["key"][:-1]]))
        order = np.empty(len(gid), np.int64)
        order[np.lexsort((col["at"], col["_h"], col["_d"]))] = np.arange(len(gid))
        ctx = rows.column("ctx").combine_chunks().cast(pa.large_binary())
        buf, off = tx.strings(ctx)
        low = np.maximum(col["low"], col["at"] & 1023)
        high = np.minimum(col["high"], col["at"] >> 10 & 1023)
        row, first, last = _runs(*resolver(spec, gid, low, high, col["lft"], order, buf, off))
        a = col["at"][row] >> 20
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (col["_d"][row], col["_h"][row], a - last, a - first + spec.window)],
            ["_d", "_h", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            for part in tx.slices(batch, "ctx", _GROUP_BYTES):
                more = pa.Table.from_batches([part])
                held = more if held is None else pa.concat_tables([held, more])
                if held.column("ctx").nbytes >= _GROUP_BYTES:  # all groups but the last are whole
                    key = held.column("key").to_numpy()
                    cut = int(np.flatnonzero(key == key[-1])[0])
                    if cut:
                        yield spans(held.slice(0, cut))
                        held = held.slice(cut)
        if held is not None and held.num_rows:
            yield spans(held)
    return run


def repeated_spans(rows: DataFrame, spec: Windows, resolver: Resolver, name: str) -> DataFrame:
    """``_d, _h, spans`` (array of unit ranges a..b, not merged) of the documents
    in which windows repeat.  ``rows``: ``text, _d, _h`` (see ``keyed``); rows
    that agree in the key count as one document."""
    text = rows.select(F.lit(0).alias("x"), "text", "_d", "_h")
    found = written(arrow(text, _find(spec), "k long, c long, _d long, _h long, at long"), f"{name}-anchors")
    # counts are written before they are joined: only a join of plain tables is split where a key is hot
    often = written(found.groupBy("k").count().where("count > 1").select("k"), f"{name}-often")
    # repeated rows are found by document: a grouping that the join's own keys served would keep it whole
    found = written(found.join(often, "k").repartition("_d", "_h").distinct(), f"{name}-candidates")
    classes = written(found.groupBy(*_KEY).agg(F.count("*").alias("n"), F.min(F.struct(*_AT)).alias("o")),
                      f"{name}-classes")
    several = written(classes.groupBy("k").agg(F.count("*").alias("m")).where("m > 1").select("k"),
                      f"{name}-several")
    several = classes.join(several, "k").select("k", "c", "n", "o.*")

    wants = several.groupBy("_d", "_h").agg(F.collect_list(F.struct("k", "c", "n", "at")).alias("want"))
    once = rows.select("text", "_d", "_h").join(wants, ["_d", "_h"]).dropDuplicates(["_d", "_h"])
    contexts = written(arrow(
        once, _contexts(spec), "k long, c long, n long, _d long, _h long, at long, lft int, ctx binary"),
        f"{name}-contexts")
    groups, split = grouped(contexts, spec)
    parts = ["key", "low", "high", "lft", "_d", "_h", "at", "ctx"]
    groups = groups.select(*parts).repartition("key").sortWithinPartitions("key")
    shared = arrow(groups, _resolve(spec, resolver), "_d long, _h long, a long, b long")

    a = F.shiftright("at", 20)
    copies = found.join(classes.where("n > 1").select("k", "c", "o"), _KEY)
    if not spec.every:
        copies = copies.where(~F.col("o").eqNullSafe(F.struct(*_AT)))
    shared = shared.unionByName(copies.select(
        "_d", "_h", (a - F.shiftright("at", 10).bitwiseAND(F.lit(1023))).alias("a"),
        (a - F.col("at").bitwiseAND(F.lit(1023)) + spec.window).alias("b")))
    for more in split:
        shared = shared.unionByName(more)
    return shared.groupBy("_d", "_h").agg(F.collect_list(F.struct("a", "b")).alias("spans"))


def removed(spans: pa.Array, n: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each document its merged (starts, ends), given a list array of
    ranges; ``n`` is only used for its length."""
    size = pc.fill_null(pc.list_value_length(spans), 0).to_numpy(zero_copy_only=False)
    a, b = (x.to_numpy() for x in spans.flatten().flatten()) if size.sum() else (np.empty(0, np.int64),) * 2
    out, at = [], 0
    for i in range(len(n)):
        x, y = a[at: at + size[i]], b[at: at + size[i]]
        at += size[i]
        order = np.argsort(x, kind="stable")
        x, y = x[order], np.maximum.accumulate(y[order]) if len(x) else y
        new = np.concatenate([[True], x[1:] > y[:-1]]) if len(x) else np.empty(0, bool)
        out.append((x[new], np.concatenate([y[:-1][new[1:]], y[-1:]])))
    return out
