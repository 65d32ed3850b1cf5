"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints within ``radius`` bits agree in at least two of ``radius + 2``
blocks of bits, so each pair of blocks keys a table and only fingerprints with
an equal key meet.  A bucket's fingerprints are stored vertically: one bit
vector for each of the 64 planes.  Shifting the planes by ``k`` lanes pairs each
fingerprint with the k-th one after it, for all buckets of a batch at once;
differing planes are added into bitwise carry-save counters that overflow beyond
the radius, and a block of lanes is abandoned as soon as all have overflowed.

Buckets larger than ``tile`` are cut into tiles that meet pairwise in separate
groups.  A group gives a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import text as tx
from tidemark.llm.common import arrow, document_key, keyed, spare, table, written
from tidemark.llm.graph import components

SHINGLE = 3
SEED = 42
RADIUS = 3
#: Fingerprints of a bucket that one group compares with as many others.
TILE = 4096
_ROWS = 50_000
_LANES = 512  # bytes of a lane block


def fingerprint(data: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """SimHash of a text's word shingles (A-Z lower-cased, repeats included)."""
    words = data.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    end = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    start = np.concatenate([[0], end[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    start, end = start[:n].tolist(), end[min(shingle, len(words)) - 1:].tolist()
    count, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for i in range(0, n, 65536):
        h = np.array([digest(joined[a:b], seed) for a, b in
                      zip(start[i: i + 65536], end[i: i + 65536], strict=True)], np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * count > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``doc_id, _d, _h, fp`` (``fp``: the 64 bits as a long) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tx.slices(batch, "text"):
                buf, off = tx.strings(part.column(1))
                fp = [fingerprint(buf[a:b].tobytes(), shingle, seed)
                      for a, b in zip(off[:-1], off[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), part.column(3),
                     pa.array(np.array(fp, np.uint64).view(np.int64))], ["doc_id", "_d", "_h", "fp"])
    rows = keyed(docs)
    return arrow(rows, run, f"doc_id {dict(rows.dtypes)['doc_id']}, _d long, _h long, fp long")


def table_keys(fp: Column, radius: int = RADIUS) -> list[Column]:
    """One key for each pair of the ``radius + 2`` blocks of bits."""
    n = radius + 2
    edge = [64 * i // n for i in range(n + 1)]
    if 2 * max(b - a for a, b in zip(edge[:-1], edge[1:], strict=True)) > 56:
        raise ValueError(f"radius {radius}: a pair of blocks is wider than a key")
    block = [F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1).cast("long"))
             for a, b in zip(edge[:-1], edge[1:], strict=True)]
    return [F.shiftleft(F.lit(t).cast("long"), 57).bitwiseOR(
        F.shiftleft(block[i], edge[j + 1] - edge[j])).bitwiseOR(block[j])
        for t, (i, j) in enumerate(combinations(range(n), 2))]


def close_pairs(fp: np.ndarray, size: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j) index pairs within ``radius`` bits inside groups of adjoining
    rows; ``size`` (falling) are the groups' sizes."""
    n = len(fp)
    bits = np.unpackbits(fp.view(np.uint8).reshape(n, 8), axis=1, bitorder="little").T
    pad = np.zeros((64, 8 * _LANES + 8), np.uint8)
    bits = np.concatenate([bits, pad], axis=1)
    planes = [np.packbits(bits[:, r:], axis=1, bitorder="little") for r in range(8)]
    end = np.repeat(np.cumsum(size), size)
    reach = np.cumsum(size)
    width = max(1, int(radius).bit_length())
    for k in range(1, int(size[0]) if len(size) else 0):
        lanes = int(reach[np.searchsorted(-size, -k, "left") - 1])  # rows of groups larger than k
        blocks = -(-lanes // (8 * _LANES))
        valid = np.zeros(blocks * 8 * _LANES, bool)
        valid[:lanes] = np.arange(lanes) + k < end[:lanes]
        over = ~np.packbits(valid, bitorder="little").reshape(blocks, _LANES)
        # the counters start so high that they overflow at radius + 1
        spare = (1 << width) - 1 - radius
        count = [np.full_like(over, 255 if spare >> c & 1 else 0) for c in range(width)]
        live = np.arange(blocks)
        byte = np.arange(_LANES)
        for g in range(0, 64, 8):
            at = live[:, None] * _LANES + byte
            for b in range(g, g + 8):
                carry = planes[0][b].take(at, mode="clip") ^ planes[k % 8][b].take(at + k // 8, mode="clip")
                for c in range(width):
                    count[c], carry = count[c] ^ carry, count[c] & carry
                over |= carry
            keep = (over != 255).any(axis=1)
            if not keep.all():
                live, over, count = live[keep], over[keep], [c[keep] for c in count]
            if not len(live):
                break
        if len(live):
            hit = np.unpackbits(~over, axis=1, bitorder="little").nonzero()
            i = live[hit[0]] * 8 * _LANES + hit[1]
            yield i, i + k


def forest(fp: np.ndarray, size: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, root fingerprint) of every linked row that is no root."""
    label = np.arange(len(fp))
    pending: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0

    def settle() -> None:
        nonlocal held
        a = np.concatenate([x for x, _ in pending])
        b = np.concatenate([y for _, y in pending])
        while True:
            low = np.minimum(label[a], label[b])
            np.minimum.at(label, label[a], low)
            np.minimum.at(label, label[b], low)
            while not np.array_equal(label, label[label]):
                label[:] = label[label]
            if np.array_equal(label[a], label[b]):
                break
        pending.clear()
        held = 0

    for i, j in close_pairs(fp, size, radius):
        apart = label[i] != label[j]
        if apart.any():
            pending.append((i[apart], j[apart]))
            held += int(apart.sum())
            if held > 4 * len(fp):
                settle()
    if pending:
        settle()
    tied = np.flatnonzero(label != np.arange(len(fp)))
    return fp[tied], fp[label[tied]]


def _linker(radius: int):
    def links(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)]))
        size = np.diff(np.concatenate([new, [len(fp)]]))
        order = np.argsort(-size, kind="stable")
        take = np.repeat(new[order], size[order]) + np.arange(len(fp)) - np.repeat(
            np.cumsum(size[order]) - size[order], size[order])
        u, v = forest(np.ascontiguousarray(fp[take]), size[order], radius)
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fp = np.empty((0, 3), np.int64), np.empty(0, np.int64)
        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)]
            key = np.concatenate([key, np.stack(cols[:3], 1)])
            fp = np.concatenate([fp, cols[3]])
            if len(fp) >= _ROWS:  # all groups but the last are whole
                last = int(np.flatnonzero((key == key[-1]).all(axis=1))[0])
                if last:
                    yield links(key[:last], fp[:last])
                    key, fp = key[last:], fp[last:]
        if len(fp):
            yield links(key, fp)
    return run


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """``u, v``: links of distinct fingerprints (column ``fp``) that connect
    all that lie within ``radius`` bits of each other, directly or in steps."""
    rows = distinct.select("fp", F.explode(F.array(*table_keys(F.col("fp"), radius))).alias("key"))
    full = written(rows.groupBy("key").count().where("count > 1"), "simhash-buckets")
    rows = rows.join(full, "key").withColumn("n", F.ceil(F.col("count") / tile).cast("int"))
    own = F.pmod(F.xxhash64("fp"), F.col("n").cast("long")).cast("int")
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    rows = rows.select("key", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "fp")
    rows = rows.repartition("key", "a", "b").sortWithinPartitions("key", "a", "b")
    return arrow(rows, _linker(radius), "u long, v long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, seed: int = SEED,
                    tile: int = TILE) -> DataFrame:
    """``doc_id, fingerprint, component_id, is_first`` for every row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` reachable over links of
    ``radius`` bits or less; ``is_first`` marks the row that stands for its
    component (smallest id, then smallest text hash).  A null or empty text has
    fingerprint zero and links like any other.  A row without an id counts as
    the smallest for ``is_first`` but never names a component unless all its
    members lack ids (then null).  Repeated rows share one result, so each
    repeat of a first row is marked.  An empty table gives no rows.
    """
    rows = _components(docs, shingle, radius, seed, tile)
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id",
                       ((F.col("_d") == F.col("first._d")) & (F.col("_h") == F.col("first._h"))).alias("is_first"))


def _components(docs: DataFrame, shingle: int, radius: int, seed: int, tile: int) -> DataFrame:
    rows = written(fingerprints(docs, shingle, seed), "simhash")
    distinct = written(rows.groupBy("fp").agg(
        F.min("doc_id").alias("least"), F.min(F.struct("_d", "_h")).alias("first")), "simhash-distinct")
    tied = components(fingerprint_links(distinct.select("fp"), radius, tile), "simhash-components")
    named = distinct.join(tied, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", "first", F.coalesce("component", "fp").alias("component"))
    names = named.groupBy("component").agg(F.min("least").alias("component_id"), F.min("first").alias("first"))
    return rows.join(named.select("fp", "component").join(names, "component"), "fp")


def deduplicate(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, seed: int = SEED,
                tile: int = TILE) -> DataFrame:
    """The rows of ``docs`` with one document of each component: its first (see
    ``near_duplicates``), and that once even if the row is repeated.  All
    columns stay as they are."""
    first = _components(docs, shingle, radius, seed, tile).select("first").distinct().select(
        F.col("first._d").alias("_fd"), F.col("first._h").alias("_fh"))
    d, h, fd, fh = spare(docs, "_d", "_h", "_fd", "_fh")
    rows = docs.withColumns({d: document_key(docs), h: F.xxhash64("text")})
    first = first.withColumnsRenamed({"_fd": fd, "_fh": fh})
    kept = rows.join(first, (F.col(d) == F.col(fd)) & (F.col(h) == F.col(fh)), "left_semi")
    return kept.dropDuplicates([d, h]).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
