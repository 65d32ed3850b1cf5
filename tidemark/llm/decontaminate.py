"""Benchmark decontamination with a stored positional inverted index.

``build_index`` reads the documents once and stores the postings of every token:
for each term and each slice of about a batch of documents, the positions.  A
frequent term has a row in every slice, so no list grows with the corpus.  A test
phrase is looked up from its rarest term, by the counts of the whole corpus: the
slices that hold that term are its candidates; there its lists, shifted to the
phrase's start, are intersected from the rarest term on by binary search.  The same
lists answer proximity queries: one term has to stand in its place and every other
within ``slop`` words of it.

Documents are not read again, whatever the number of test items; phrases meet
postings in joins, and a task holds one slice's lists of the terms of at most about
``block_windows`` phrases.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import text as tx
from tidemark.llm.common import arrow, document_key, spare, table, written
from tidemark.session import shared_dir

WINDOW = 10
#: Phrases looked up in a slice by one task, about.
BLOCK_WINDOWS = 50_000
#: Bytes of text in a slice of the index, at most (but for a longer text).
SLICE_BYTES = 4_000_000
#: Candidate places checked at once in a task.
_CANDIDATES = 1_000_000
#: Documents found (16 bytes each) whose keys are broadcast; more are joined.
_SENT_KEYS = 1_000_000


def phrases(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``item, terms`` (term hashes in order): every run of ``window`` words of
    an item, or all its words if it has fewer; none for an item without words.
    Equal phrases of one item are kept once.  An item without an id is named ''."""
    def run(batches):
        for batch in batches:
            for part in tx.slices(batch, "text"):
                ids = part.column(0).to_pylist()
                buf, off = tx.strings(part.column(1))
                buf = tx.lower_ascii(buf)
                start, end, doc = tx.words(buf, off, "alnum")
                h = tx.word_hashes(buf, start, end).view(np.int64)
                first = np.searchsorted(doc, np.arange(len(ids) + 1))
                item, terms = [], []
                for i, name in enumerate(ids):
                    w = h[first[i]: first[i + 1]]
                    runs = {tuple(w[j: j + window].tolist())
                            for j in range(max(1, len(w) - window + 1))} if len(w) else ()
                    item += [name] * len(runs)
                    terms += [list(r) for r in runs]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(item, pa.string()), pa.array(terms, pa.list_(pa.int64()))],
                    ["item", "terms"])
    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    return arrow(rows, run, "item string, terms array<long>").distinct()


class Index:
    """Sorted positional postings of the query terms in one slice."""

    def __init__(self, vocab: np.ndarray, lists: list[np.ndarray], n_words: int):
        self.width = np.int64(n_words + 1)
        number = np.repeat(np.arange(len(vocab)), [len(x) for x in lists])
        at = np.concatenate([np.empty(0, np.int64), *lists]).astype(np.int64)
        self.post = np.sort(number * self.width + at)
        self.first = np.searchsorted(self.post, np.arange(len(vocab) + 1, dtype=np.int64) * self.width)
        self.count = np.diff(self.first)

    def places(self, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query row, position) of every posting of each row's term."""
        n = self.count[term]
        row = np.repeat(np.arange(len(term)), n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.first[term], n)
        return row, self.post[at] % self.width

    def near(self, term: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Whether the term has a posting in [lo, hi]."""
        base = term * self.width
        a = np.searchsorted(self.post, base + np.maximum(lo, 0), "left")
        b = np.searchsorted(self.post, base + np.minimum(hi, self.width - 1), "right")
        return b > a


def find(index: Index, terms: np.ndarray, length: np.ndarray, first: np.ndarray,
         last: np.ndarray, doc: np.ndarray, slop: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(phrase, start position, document) of every match.  ``terms``: phrases x
    window term numbers, -1 for terms that the slice lacks or beyond ``length``.
    With ``slop`` a start may lie outside the document, and may come repeatedly."""
    inside = np.arange(terms.shape[1])[None, :] < length[:, None]
    freq = np.where(inside, np.where(terms >= 0, index.count[np.maximum(terms, 0)], 0),
                    np.iinfo(np.int64).max)
    alive = np.flatnonzero((freq > 0).all(axis=1))
    order = np.argsort(freq[alive], axis=1, kind="stable")  # the rarest term first
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = freq[alive, order[:, 0]] if len(alive) else np.empty(0, np.int64)
    block = np.cumsum(size) // _CANDIDATES
    for b in np.unique(block):
        rows = np.flatnonzero(block == b)
        p, o = alive[rows], order[rows]
        postings, at = index.places(terms[p, o[:, 0]])
        for shift in range(-slop, slop + 1):  # of the rarest term from its place
            r, start, d = postings, at - o[postings, 0] - shift, doc[at]
            placed = np.full(len(r), shift == 0)  # a term stands in its place
            if not slop:
                keep = (start >= first[d]) & (start + length[p[r]] <= last[d])
                r, start, d, placed = r[keep], start[keep], d[keep], placed[keep]
            for j in range(1, terms.shape[1]):
                used = j < length[p[r]]
                term, want = terms[p[r], o[r, j]][used], (start + o[r, j])[used]
                lo, hi = first[d][used], last[d][used] - 1
                ok = ~used
                ok[used] = index.near(term, np.maximum(want - slop, lo), np.minimum(want + slop, hi))
                if slop:
                    placed[used] |= index.near(term, np.maximum(want, lo), np.minimum(want, hi))
                r, start, d, placed = r[ok], start[ok], d[ok], placed[ok]
            found.append((p[r[placed]], start[placed], d[placed]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


# ------------------------------------------------------------------ index

def _indexer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the index: of each slice its documents (``doc``: number in the
    slice), and its postings, by term; the row without a term has the documents'
    first positions and the number of words."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        for part in tx.slices(batch, "text", SLICE_BYTES):
            n = part.num_rows
            buf, off = tx.strings(part.column(1))
            buf = tx.lower_ascii(buf)
            start, end, owner = tx.words(buf, off, "alnum")
            term = tx.word_hashes(buf, start, end).view(np.int64)
            order = np.argsort(term, kind="stable")
            cut = np.flatnonzero(np.concatenate([[True], term[order][1:] != term[order][:-1]])[:len(term)])
            known = pa.array(term[order][cut])
            first = np.searchsorted(owner, np.arange(n + 1))
            at = np.concatenate([order, first]).astype(np.int32)
            edge = np.concatenate([cut, [len(order), len(at)]])
            m = len(cut) + 1
            none = pa.nulls(m, part.schema.field(0).type)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(m, number)), pa.concat_arrays([known, pa.nulls(1, pa.int64())]),
                pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(at)), pa.nulls(m, pa.int32()), none,
                pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64())], _COLUMNS)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(n, number)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(pa.int32())),
                pa.array(np.arange(n, dtype=np.int32)), part.column(0), part.column(2), part.column(3),
                pa.array(np.diff(first))], _COLUMNS)
            number += 1


_COLUMNS = ["slice", "term", "at", "doc", "doc_id", "_d", "_h", "n_words"]


def build_index(docs: DataFrame) -> str:
    """Write the index of ``doc_id, text``; returns its folder.  A null text has no
    words; every row is a document of its own."""
    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", "text", document_key(docs).alias("_d"), F.xxhash64("text").alias("_h"))
    out = arrow(rows, _indexer, f"slice long, term long, at array<int>, doc int, doc_id {kind}, _d long, _h long, n_words long")
    path = shared_dir(docs.sparkSession, "postings")
    out.withColumn("kind", F.when(F.col("doc").isNull(), "terms").otherwise("docs")).write.option(
        "compression", "zstd").partitionBy("kind").parquet(path)
    return path


def _part(spark: SparkSession, path: str, kind: str, columns: str) -> DataFrame:
    """A half of the index; without rows there is no folder."""
    whole = spark.read.schema(f"{columns}, kind string").parquet(path)
    return whole.where(F.col("kind") == kind).drop("kind")


# ------------------------------------------------------------------ look-up

def _found(slop: int):
    def run(postings: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        """Hits in one slice: ``postings`` (edges: where its documents begin, or the
        list of a term), ``wanted`` (item, terms)."""
        out = {"slice": [], "doc": [], "spans": [], "items": [], "near_items": []}
        marks = postings[postings["edges"]]
        if len(marks) and len(wanted):
            edge = np.asarray(marks["at"].iloc[0], np.int64)
            lists = postings[~postings["edges"]].sort_values("term")
            vocab = lists["term"].to_numpy(np.int64)
            index = Index(vocab, [np.asarray(x) for x in lists["at"]], int(edge[-1]))
            first, last, n = edge[:-1], edge[1:], len(edge) - 1
            doc = np.repeat(np.arange(n), np.diff(edge))
            length = np.array([len(x) for x in wanted["terms"]], np.int64)
            flat = np.concatenate([np.empty(0, np.int64), *wanted["terms"]]).astype(np.int64)
            at = np.minimum(np.searchsorted(vocab, flat), max(len(vocab) - 1, 0))
            flat = np.where(vocab[at] == flat, at, -1) if len(vocab) else np.full(len(flat), -1)
            terms = np.full((len(wanted), int(length.max())), -1, np.int64)
            terms[np.arange(terms.shape[1]) < length[:, None]] = flat
            names = sorted(set(wanted["item"]))
            owner = np.searchsorted(names, wanted["item"].to_numpy(str)) if names else np.empty(0, int)
            spans, exact = _by_document(find(index, terms, length, first, last, doc), owner, length, first, n)
            near: list[list[int]] = [[] for _ in range(n)]
            if slop:
                p, _, d = find(index, terms, length, first, last, doc, slop)
                near = _items_of(d, owner[p], n)
            hit = [i for i in range(n) if spans[i] or near[i]]
            out = {"slice": [int(postings["slice"].iloc[0])] * len(hit), "doc": hit, "spans": [spans[i] for i in hit],
                   "items": [[names[j] for j in exact[i]] for i in hit],
                   "near_items": [[names[j] for j in near[i]] for i in hit]}
        return pd.DataFrame({k: pd.Series(v, dtype="int64" if k in ("slice", "doc") else object) for k, v in out.items()})
    return run


def lookup(spark: SparkSession, path: str, items: DataFrame, window: int = WINDOW, slop: int = 0,
           block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """``slice, doc, spans, items, near_items``: the documents of the index in which
    phrases of the items are found (see ``matches``)."""
    wanted = phrases(items, window).withColumn("id", F.xxhash64("item", "terms"))
    groups = max(1, -(-wanted.count() // block_windows))
    wanted = written(wanted.withColumn("block", F.pmod("id", F.lit(groups)).cast("int")), "phrases")
    terms = wanted.select("block", "id", F.size("terms").alias("size"), F.explode("terms").alias("term"))
    vocab = written(terms.select("term").distinct(), "phrase-terms")
    postings = _part(spark, path, "terms", "slice long, term long, at array<int>")
    lists = written(postings.join(vocab, "term", "left_semi"), "phrase-postings")
    counts = lists.groupBy("term").agg(F.sum(F.size("at")).alias("n"))
    # a phrase with a term that the corpus lacks is nowhere; the rarest term names the candidates
    rarest = terms.distinct().join(counts, "term", "left").groupBy("block", "id").agg(
        F.count_if(F.col("n").isNull()).alias("lacks"), F.min(F.struct("n", "term")).alias("rare")).where(
        "lacks = 0").select("block", "id", F.col("rare.term").alias("term"))
    found = rarest.join(lists.select("slice", "term"), "term").select("slice", "block", "id")
    found = written(found.join(wanted.select("id", "item", "terms"), "id"), "phrase-candidates")
    # the lists of a block's terms, where a phrase of the block has a candidate
    places = written(found.select("slice", "block").distinct(), "phrase-slices")
    needed = lists.join(terms.select("block", "term").distinct(), "term").join(places, ["slice", "block"], "left_semi")
    marks = postings.where("term IS NULL").join(places, "slice")
    # never a null term: pandas would hold the others as floats
    rows = needed.select("slice", "block", F.lit(False).alias("edges"), "term", "at").unionByName(
        marks.select("slice", "block", F.lit(True).alias("edges"), F.lit(0).cast("long").alias("term"), "at"))
    hits = rows.groupBy("slice", "block").cogroup(found.groupBy("slice", "block")).applyInPandas(
        _found(slop), "slice long, doc int, spans array<long>, items array<string>, near_items array<string>")
    both = hits.groupBy("slice", "doc").agg(*[F.flatten(F.collect_list(c)).alias(c)
                                              for c in ("spans", "items", "near_items")])
    return both.select("slice", "doc", "spans", *[F.array_sort(F.array_distinct(c)).alias(c)
                                                  for c in ("items", "near_items")])


def _items_of(doc: np.ndarray, item: np.ndarray, n: int) -> list[list[int]]:
    pairs = np.unique(np.stack([doc, item], 1), axis=0) if len(doc) else np.empty((0, 2), np.int64)
    cut = np.searchsorted(pairs[:, 0], np.arange(n + 1))
    return [pairs[cut[i]: cut[i + 1], 1].tolist() for i in range(n)]


def _by_document(hits, owner, length, first, n: int):
    """Per document: merged hit spans (flat list start, end, ... in words from
    the document's start) and the items found."""
    p, s, d = hits
    spans: list[list[int]] = [[] for _ in range(n)]
    order = np.argsort(s, kind="stable")
    for i in order:
        a = int(s[i] - first[d[i]])
        b = a + int(length[p[i]])
        own = spans[d[i]]
        if own and a <= own[-1]:
            own[-1] = max(own[-1], b)
        else:
            own += [a, b]
    return spans, _items_of(d, owner[p], n)


def _merged(spans: list) -> list[int]:
    """A flat list of spans, merged."""
    out: list[int] = []
    for a, b in sorted(zip(spans[::2], spans[1::2], strict=True)):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def _indexed(docs: DataFrame, items: DataFrame, window: int, slop: int, block_windows: int) -> DataFrame:
    """Documents of the index (``doc_id, _d, _h, n_words``) with what is found in
    them; ``spans`` of several blocks follow each other, unmerged."""
    spark, path = docs.sparkSession, build_index(docs)
    own = _part(spark, path, "docs", f"slice long, doc int, doc_id {dict(docs.dtypes)['doc_id']}, _d long, _h long, "
                                     "n_words long")
    hits = written(lookup(spark, path, items, window, slop, block_windows), "phrase-hits")
    return own.join(hits, ["slice", "doc"], "left").drop("slice", "doc")


def matches(docs: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = 0,
            block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Exact phrase (and, if ``slop``, proximity) matches of the items.

    Returns one row for each row of ``docs``: ``doc_id, n_words, spans`` (start
    and end word of each merged exact hit), ``items`` (ids found exactly),
    ``near_items`` (ids of which a phrase occurs with one term in its place and
    each other at most ``slop`` words off, all in the document; empty if ``slop``
    is 0).

    A null text has no words, and no item without words is ever found.  Words
    are compared by 64-bit hashes.  Repeated rows get a row each; ties do not
    arise.  An empty ``docs`` gives no rows, an empty ``items`` no hits.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [_merged(x or []) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, pa.list_(pa.int64())),
                                              batch.column(3), batch.column(4)], batch.schema.names)
    none = F.array().cast("array<string>")
    rows = _indexed(docs, items, window, slop, block_windows).select(
        "doc_id", "n_words", "spans", F.coalesce("items", none).alias("items"),
        F.coalesce("near_items", none).alias("near_items"))
    return arrow(rows, run, f"doc_id {dict(docs.dtypes)['doc_id']}, n_words long, spans array<long>, items array<string>, "
                            "near_items array<string>")


def clean(docs: DataFrame, items: DataFrame, window: int = WINDOW,
          block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """The rows of ``docs`` in which no phrase of the items occurs, unchanged."""
    found = _indexed(docs, items, window, 0, block_windows).where("spans IS NOT NULL")
    d, h = spare(docs, "_d", "_h")
    found = written(found.select(F.col("_d").alias(d), F.col("_h").alias(h)).distinct(), "contaminated")
    if found.count() <= _SENT_KEYS:
        found = F.broadcast(found)
    rows = docs.withColumns({d: document_key(docs), h: F.xxhash64("text")})
    return rows.join(found, [d, h], "left_anti").select(*docs.columns)


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW,
                  block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` for each
    row of ``docs`` (see ``matches`` for nulls, repeats and empty tables)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = [sum(x[1::2]) - sum(x[::2]) for x in (_merged(y or []) for y in batch.column(2).to_pylist())]
            items = [x or [] for x in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(hit, pa.int64()), pa.array([len(x) for x in items], pa.int64()),
                pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items], pa.string()),
                pa.array([x > 0 for x in hit], pa.bool_()),
            ], ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])
    rows = _indexed(docs, items, window, 0, block_windows).select("doc_id", "n_words", "spans", "items")
    return arrow(rows, run, f"doc_id {dict(docs.dtypes)['doc_id']}, n_words long, n_hit long, n_items long, "
                            "items_sha256 string, contaminated boolean")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH dw AS (
  SELECT doc_id, pos, w FROM (
    SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') AS ws FROM documents))),
bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') AS ws FROM benchmark),
grams AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS n,
         array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS g
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 10, 0) + 2)) AS i
        FROM bw WHERE len(ws) > 0)),
lens AS (SELECT DISTINCT n FROM grams),
da AS (SELECT doc_id, list(w ORDER BY pos) AS ws FROM dw GROUP BY doc_id),
dg AS (
  SELECT doc_id, i, n, array_to_string(ws[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i
        FROM da, lens WHERE len(ws) >= n)),
hits AS (SELECT doc_id, i, n, item_id FROM dg JOIN grams USING (n, g)),
hw AS (SELECT doc_id, count(*) AS n_hit FROM (
         SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p
         FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY doc_id),
hi AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(da.ws), 0) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM documents d LEFT JOIN da USING (doc_id) LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)
"""
