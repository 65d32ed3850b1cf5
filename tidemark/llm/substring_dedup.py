"""Substring dedup with partitioned suffix trees.

The suffixes that may repeat (see ``repeats``) are split into groups by hashes
of a common core inside the window, short where few share one and longer where
many do, so that a group fits in memory; these stand in for prefixes.  Copies of
equal contexts are found there by their hashes and are in no tree.  A group's tree is grown level by
level: a node's suffixes are divided by their next word, and a suffix alone in
its node is a leaf and grows no further.  Nodes as deep as the window are the
maximal repeats; of the suffixes below one, all but the earliest are removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import text as tx
from tidemark.llm.common import arrow, document_key, keyed, spare, table
from tidemark.llm.repeats import Windows, offsets_of, removed, repeated_spans

WINDOW = 20
#: Words of an anchor (see ``repeats``).
GRAM = 6


def deep_nodes(group: np.ndarray, start: np.ndarray, code: np.ndarray, depth: int):
    """(suffix, node) of the suffixes below nodes of that depth with two or more
    leaves.  ``start``: where a suffix begins in the word codes ``code``."""
    alive, node = np.arange(len(start)), group.astype(np.int64)
    width = np.int64(code.max() + 1) if len(code) else np.int64(1)
    for level in range(depth):
        _, node, size = np.unique(node * width + code[start[alive] + level], return_inverse=True,
                                  return_counts=True)
        keep = size[node] > 1
        alive, node = alive[keep], node[keep]
        if not len(alive):
            break
    return alive, node


def resolve(spec: Windows, group, low, high, lft, order, buf, off):
    """Windows of the contexts that begin earlier in another one."""
    first, end, doc = tx.words(buf, off)
    code = np.unique(tx.word_hashes(buf, first, end), return_inverse=True)[1].astype(np.int64)
    edge = np.searchsorted(doc, np.arange(len(off)))
    row, o = offsets_of(low, high)
    suffix, node = deep_nodes(group[row], edge[row] + lft[row] - o, code, spec.window)
    row, o = row[suffix], o[suffix]
    least = np.full(node.max() + 1 if len(node) else 0, np.iinfo(np.int64).max)
    np.minimum.at(least, node, order[row])
    later = order[row] > least[node]
    row, o = row[later], o[later]
    return row, o


def _digest(keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tx.slices(batch, "text"):
                names = part.schema.names
                texts = [(x or "").encode().split() for x in part.column(names.index("text")).to_pylist()]
                n = np.array([len(x) for x in texts], np.int64)
                cuts = removed(part.column(names.index("spans")), n)
                kept, gone = [], []
                for w, (a, b) in zip(texts, cuts, strict=True):
                    gone.append(int((b - a).sum()))
                    if len(a):
                        w = [x for s, e in zip([0, *b], [*a, len(w)], strict=True) for x in w[s:e]]
                    kept.append(b" ".join(w))
                yield pa.RecordBatch.from_arrays([
                    part.column(names.index("doc_id")), part.column(names.index("_d")),
                    part.column(names.index("_h")), pa.array(n), pa.array(gone, pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in kept]),
                    pa.array([x.decode() if keep_text else None for x in kept], pa.string()),
                ], ["doc_id", "_d", "_h", "n_words", "n_removed", "kept_sha256", "kept"])
    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, group_rows: int = 4096,
                   keep_text: bool = True) -> DataFrame:
    """``doc_id, _d, _h, n_words, n_removed, kept_sha256, kept`` for every row:
    words in windows whose word sequence also starts earlier (smaller ``doc_id``,
    or the same document and an earlier start) are removed; ``kept`` joins the
    others by one space (null unless ``keep_text``).  ``window`` may be at most 511
    words longer than ``gram`` (else ValueError).

    A null text has no words.  Rows that repeat an id and a text are one
    document: each gets its result.  Rows that share an id but not the text are
    ordered by their texts' hashes; a null id comes first; ids that aren't whole
    numbers are ordered by their hashes.  Other columns are
    not read; an empty table gives no rows.
    """
    spec = Windows("words", window, gram, every=False, group_rows=group_rows)
    rows = keyed(docs)
    spans = repeated_spans(rows, spec, resolve, "substrings")
    kind = dict(docs.dtypes)["doc_id"]
    return arrow(rows.join(spans, ["_d", "_h"], "left"), _digest(keep_text),
                 f"doc_id {kind}, _d long, _h long, n_words long, n_removed long, kept_sha256 string, kept string")


def _cleaner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in tx.slices(batch, "text"):
            names = part.schema.names
            at = names.index("text")
            texts = part.column(at).to_pylist()
            cuts = removed(part.column(len(names) - 1), np.zeros(len(texts)))
            for i, (a, b) in enumerate(cuts):
                if len(a):
                    w = texts[i].encode().split()
                    texts[i] = b" ".join(
                        x for s, e in zip([0, *b], [*a, len(w)], strict=True) for x in w[s:e]).decode()
            columns = [pa.array(texts, pa.string()) if i == at else part.column(i) for i in range(len(names) - 1)]
            yield pa.RecordBatch.from_arrays(columns, names[:-1])


def clean(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, group_rows: int = 4096) -> DataFrame:
    """The rows of ``docs`` with the words of earlier windows gone from
    ``text``: a text that loses words is its other words joined by one space
    (maybe none), all others stay as they are.  Other columns are unchanged;
    nulls and repeats are treated as in ``remove_repeats``."""
    spec = Windows("words", window, gram, every=False, group_rows=group_rows)
    d, h, gone = spare(docs, "_d", "_h", "_spans")
    spans = repeated_spans(keyed(docs), spec, resolve, "substrings").select(
        F.col("_d").alias(d), F.col("_h").alias(h), F.col("spans").alias(gone))
    rows = docs.withColumns({d: document_key(docs), h: F.xxhash64("text")})
    rows = rows.join(spans, [d, h], "left").select(*docs.columns, gone)
    return arrow(rows, _cleaner, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), keep_text=False).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 19], ' ')) AS g
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM d WHERE len(ws) >= 20)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS k FROM w)
      WHERE k > 1),
x AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM r),
t AS (SELECT doc_id, p, ws[p] AS word FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS p FROM d)),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n
      FROM t WHERE NOT EXISTS (SELECT 1 FROM x WHERE x.doc_id = t.doc_id AND x.p = t.p) GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""
