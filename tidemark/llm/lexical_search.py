"""Ranked lexical search by an Aho-Corasick scan of the documents.

No index of the documents is built.  The terms of all items form one automaton,
each guarded by a blank on either side; a slice of texts, with every byte that
belongs to no term made a blank, runs through it once, and what the automaton
puts out are whole terms with their places.  A first scan gathers the corpus
statistics (documents and their terms, documents with each term), a second one
counts again and scores: the automaton's outputs map to the items that hold the
term, and each task keeps its best documents of every item.

The automaton is broadcast for a block of items, dealt by their hash so that its
terms have about ``block_bytes`` bytes (and those of its longest item); more items
are more scans, never a larger broadcast.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import text as tx
from tidemark.llm.common import arrow, table, written

TOP = 20
#: Bytes of terms in one automaton (about 100 bytes of memory each), and items in a block.
BLOCK_BYTES = 1_000_000
BLOCK_ITEMS = 10_000
#: Matches, or shares of a term in an item's score, held at once in a task.
_HELD = 1 << 18
#: Tasks whose best documents are ranked together before the last ranking.
_FAN_IN = 1024


def _blanked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a slice: A-Z lower-cased, what belongs to no term a
    blank, and a blank before each text and behind the last."""
    buf, off = tx.strings(column)
    inside = np.where(tx.byte_class("alnum"), tx.lower_ascii(np.arange(256, dtype=np.uint8)), 0x20).astype(np.uint8)
    n = len(off) - 1
    out = np.full(len(buf) + n + 1, 0x20, np.uint8)
    # text i moves on by the i + 1 blanks before it
    out[np.arange(len(buf)) + np.repeat(np.arange(1, n + 1), np.diff(off))] = inside[buf]
    return out, off + np.arange(n + 1)


def _lengths(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Number of terms of each text: a term begins behind a blank."""
    first = np.flatnonzero((buf[1:] != 0x20) & (buf[:-1] == 0x20)) + 1
    return np.diff(np.searchsorted(first, off))


class Terms:
    """The automaton of a block's terms."""

    def __init__(self, terms: list[str]):
        import ahocorasick
        self.size = len(terms)
        self.automaton = ahocorasick.Automaton()
        for i, term in enumerate(terms):  # a byte is a Latin-1 character
            self.automaton.add_word(f" {term} ".encode().decode("latin-1"), i)
        if terms:
            self.automaton.make_automaton()

    def counts(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, term, occurrences) of the terms in each text of a slice."""
        found, n = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        hits = self.automaton.iter(buf.tobytes().decode("latin-1")) if self.size else iter(())
        while part := list(islice(hits, _HELD)):
            end, term = np.array(part, np.int64).T
            key = (np.searchsorted(off, end, "left") - 1) * self.size + term  # the end is the blank behind the term
            one, count = np.unique(key, return_counts=True)
            found.append(one)
            n.append(count)
        key, where = np.unique(np.concatenate(found), return_inverse=True)
        total = np.zeros(len(key), np.int64)
        np.add.at(total, where, np.concatenate(n))
        return key // max(self.size, 1), key % max(self.size, 1), total


# ------------------------------------------------------------------ items

def item_terms(items: DataFrame) -> DataFrame:
    """``item_id, digest, terms, times, size`` of every item with a term: its
    distinct terms, how often each is in it, and the bytes of all.  Rows that agree
    in id and text are one item, others with the same id are items of their own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tx.slices(batch, "text"):
                buf, off = _blanked(part.column(1))
                rows = [Counter(bytes(buf[a:b]).decode().split()) for a, b in zip(off[:-1], off[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([
                    part.column(0),
                    pa.array([hashlib.sha256(x.encode()).hexdigest() for x in part.column(1).to_pylist()], pa.string()),
                    pa.array([sorted(x) for x in rows], pa.list_(pa.string())),
                    pa.array([[x[t] for t in sorted(x)] for x in rows], pa.list_(pa.int64())),
                    pa.array([sum(len(t.encode()) + 2 for t in x) for x in rows], pa.int64()),
                ], ["item_id", "digest", "terms", "times", "size"])
    rows = items.select("item_id", "text").where("text IS NOT NULL").distinct()
    return arrow(rows, run, f"item_id {dict(items.dtypes)['item_id']}, digest string, terms array<string>, "
                            "times array<long>, size long").where("size > 0")


def _blocks(items: DataFrame, block_bytes: int, block_items: int) -> Iterator:
    """(items with their number in the block, vocabulary, broadcastable postings
    term -> items) for each block."""
    frame = written(item_terms(items), "search-items")
    total = frame.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size")).first()
    blocks = max(1, math.ceil((total["size"] or 0) / block_bytes), math.ceil(total["n"] / block_items))
    for b in range(blocks):
        part = frame if blocks == 1 else frame.where(F.pmod(F.xxhash64("item_id", "digest"), F.lit(blocks)) == b)
        rows = part.orderBy("item_id", "digest").toArrow()  # bounded by the block
        vocab = sorted({t for x in rows["terms"].to_pylist() for t in x})
        number = {t: i for i, t in enumerate(vocab)}
        term = np.array([number[t] for x in rows["terms"].to_pylist() for t in x], np.int64)
        item = np.repeat(np.arange(rows.num_rows), [len(x) for x in rows["terms"].to_pylist()]).astype(np.int64)
        times = np.array([t for x in rows["times"].to_pylist() for t in x], np.int64)
        order = np.argsort(term, kind="stable")
        first = np.searchsorted(term[order], np.arange(len(vocab) + 1))
        if rows.num_rows:
            yield rows["item_id"].combine_chunks(), vocab, (first, item[order], times[order])


# ------------------------------------------------------------------ scans

def _statistics(sent):
    """Per task: documents with each term (term >= 0), documents with a term (-1),
    their terms with repeats (-2)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms(sent.value)
        df, docs, length = np.zeros(terms.size, np.int64), 0, 0
        for batch in batches:
            for part in tx.slices(batch, "text"):
                buf, off = _blanked(part.column(0))
                n = _lengths(buf, off)
                docs, length = docs + int((n > 0).sum()), length + int(n.sum())
                df += np.bincount(terms.counts(buf, off)[1], minlength=terms.size)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([[-1, -2], np.flatnonzero(df)]), pa.int64()),
            pa.array(np.concatenate([[docs, length], df[df > 0]]), pa.int64())], ["term", "n"])
    return run


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class _Best:
    """The best ``top`` documents of each item so far; equal scores by ascending
    id, a null id last."""

    def __init__(self, n_items: int, kind: pa.DataType, top: int):
        self.top, self.floor = top, np.zeros(n_items, np.int64)
        self.item, self.score, self.id = np.empty(0, np.int64), np.empty(0, np.int64), pa.array([], kind)

    def add(self, item: np.ndarray, score: np.ndarray, ids: pa.Array) -> None:
        """One row for each item and document of a slice."""
        item, score = np.concatenate([self.item, item]), np.concatenate([self.score, score])
        ids = pa.concat_arrays([self.id, ids])
        rank = pc.rank(ids, sort_keys="ascending", null_placement="at_end", tiebreaker="dense").to_numpy()
        order = np.lexsort((rank, -score, item))
        first = np.searchsorted(item[order], item[order])
        order = order[np.arange(len(order)) - first < self.top]
        self.item, self.score, self.id = item[order], score[order], ids.take(pa.array(order))
        cut = np.searchsorted(self.item, np.arange(len(self.floor) + 1))
        full = np.flatnonzero(np.diff(cut) == self.top)
        self.floor[full] = self.score[cut[full + 1] - 1]


def _spread(n: np.ndarray, n_docs: int, length: int) -> np.ndarray:
    """A document's m; Python's integers, where 64 bits could overflow."""
    if len(n) and 25 * int(n.max()) * n_docs >= 2 ** 63:
        return np.array([75 + 25 * int(x) * n_docs // length for x in n], np.int64)
    return 75 + 25 * n * n_docs // max(length, 1)


def _search(sent, top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, (first, item, times), weights, n_docs, length, names = sent.value
        terms, n_items, best = Terms(vocab), len(names), None
        for batch in batches:
            best = best or _Best(n_items, batch.schema.field("doc_id").type, top)
            for part in tx.slices(batch, "text"):
                buf, off = _blanked(part.column(1))
                m = _spread(_lengths(buf, off), n_docs, length)
                text, term, tf = terms.counts(buf, off)
                share = weights[term] * (1_000_000_000 * tf // (1000 * tf + 12 * m[text]))
                wide = np.cumsum(first[term + 1] - first[term])
                cut = np.searchsorted(wide, np.arange(0, wide[-1] if len(wide) else 0, _HELD))
                # whole documents, about _HELD shares at once
                for s, e in zip(*_runs(text, cut), strict=True):
                    t = term[s:e]
                    n = first[t + 1] - first[t]
                    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[t], n)
                    key = np.repeat(text[s:e], n) * n_items + item[at]
                    got, where = np.unique(key, return_inverse=True)
                    score = np.zeros(len(got), np.int64)
                    np.add.at(score, where, np.repeat(share[s:e], n) * times[at])
                    keep = (score > 0) & (score >= best.floor[got % n_items])
                    if keep.any():
                        best.add(got[keep] % n_items, score[keep],
                                 part.column(0).take(pa.array(got[keep] // n_items)))
        if best is not None and len(best.item):
            yield pa.RecordBatch.from_arrays([
                pa.array(best.item), names.take(pa.array(best.item)), best.id, pa.array(best.score)],
                ["item", "item_id", "doc_id", "score"])
    return run


def _runs(text: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of rows that end with a document and begin at or
    behind each cut."""
    starts = np.unique(np.searchsorted(text, text[cut], "left")) if len(cut) else np.empty(0, np.int64)
    return starts, np.append(starts[1:], len(text))[:len(starts)]


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES,
           block_items: int = BLOCK_ITEMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` best documents of each item
    with a score above 0, equal scores by ascending ``doc_id``.

    Terms are runs of ASCII letters, digits and bytes above 0x7F, A-Z lower-cased.
    A null or empty text has no term: such a document isn't counted and such an
    item isn't in the result.  Every row of ``docs`` is a document, also one that
    repeats another; a null id comes behind the others.  Rows of ``items`` that
    agree in id and text are one item; others with the same id (also null) are
    ranked each on its own.  Other columns are not read; ids may be of any type
    that can be ordered; empty tables give no rows.
    """
    spark, out = docs.sparkSession, None
    kinds = dict(docs.dtypes)["doc_id"], dict(items.dtypes)["item_id"]
    for block, (names, vocab, postings) in enumerate(_blocks(items, block_bytes, block_items)):
        found = arrow(docs.select("text"), _statistics(spark.sparkContext.broadcast(vocab)), "term long, n long")
        # one row for each term of the block
        stats = {r["term"]: r["n"] for r in found.groupBy("term").agg(F.sum("n").alias("n")).collect()}
        n_docs, length = stats.pop(-1, 0), stats.pop(-2, 0)
        weights = np.array([weight(n_docs, stats.get(i, 0)) for i in range(len(vocab))], np.int64)
        sent = spark.sparkContext.broadcast((vocab, postings, weights, n_docs, length, names))
        rows = arrow(docs.select("doc_id", "text"), _search(sent, top),
                     f"item long, item_id {kinds[1]}, doc_id {kinds[0]}, score long")
        rows = rows.withColumns({"block": F.lit(block), "salt": F.floor(F.spark_partition_id() / _FAN_IN)})
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        return spark.createDataFrame([], f"item_id {kinds[1]}, rank int, doc_id {kinds[0]}, score long")
    by = [F.desc("score"), F.asc_nulls_last("doc_id")]
    for group in (["block", "item", "salt"], ["block", "item"]):
        out = out.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*by))).where(
            F.col("rank") <= top)
    return out.select("item_id", "rank", "doc_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH dt AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x{00}-\x{2F}\x{3A}-\x{40}\x{5B}-\x{60}\x{7B}-\x{7F}]+')) AS t FROM documents),
bt AS (
  SELECT item_id, t, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x{00}-\x{2F}\x{3A}-\x{40}\x{5B}-\x{60}\x{7B}-\x{7F}]+')) AS t FROM benchmark) GROUP BY ALL),
dl AS (SELECT doc_id, count(*) AS n FROM dt GROUP BY doc_id),
c AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS len FROM dl),
tf AS (SELECT doc_id, t, count(*) AS tf FROM dt WHERE t IN (SELECT t FROM bt) GROUP BY ALL),
w AS (SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
      FROM tf, c GROUP BY t, docs),
m AS (SELECT doc_id, 75 + (25 * n * docs) // len AS m FROM dl, c),
s AS (SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
      FROM bt JOIN tf USING (t) JOIN w USING (t) JOIN m USING (doc_id) GROUP BY ALL),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank,
             doc_id, score FROM s WHERE score > 0)
SELECT * FROM r WHERE rank <= 20
"""
