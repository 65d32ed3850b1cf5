"""Language identification with a byte convolutional network.

A text is cut into windows of ``WINDOW`` bytes (all of it, to the last byte).
Filters of several widths run over a window's byte symbols, each filter's
largest response is kept, and a softmax layer gives language probabilities; a
document's are the mean of its windows', weighted by their lengths.  The network
is trained in numpy on a bounded sample and sent to the tasks, which score
fixed-size batches of windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import text as tx
from tidemark.llm.common import arrow, held_out, learnable, spare, table
from tidemark.llm.nn import Adam, bounded_sample, excerpts, softmax

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 10
#: Labelled documents that the network learns from, at most.
TRAIN_DOCUMENTS = 2_400
#: Windows taken from one of them, evenly spread.
TRAIN_WINDOWS = 4
#: Optimiser steps of 256 windows, whatever the sample's size.
STEPS = 220
UNKNOWN = "und"
_BATCH = 1_024


def symbols() -> np.ndarray:
    """Byte to symbol: 0 padding, 1 anything without a letter, 2-27 letters
    whatever their case, then the bytes of UTF-8 sequences one by one."""
    t = np.ones(256, np.uint8)
    for case in (0x41, 0x61):
        t[case: case + 26] = np.arange(2, 28)
    t[0x80:] = np.arange(28, 156)
    return t


N_SYMBOLS = 156


def windows(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, doc) of consecutive windows that cover every text."""
    size = np.diff(offsets)
    n = -(-size // WINDOW)
    doc = np.repeat(np.arange(len(size)), n)
    i = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    start = offsets[doc] + i * WINDOW
    return start, np.minimum(WINDOW, offsets[doc + 1] - start), doc


def cut(sym: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Windows as rows of WINDOW symbols, padded with 0."""
    at = start[:, None] + np.arange(WINDOW)[None, :]
    out = sym[np.minimum(at, len(sym) - 1)]
    out[np.arange(WINDOW)[None, :] >= length[:, None]] = 0
    return out


class Network:
    """Weights: one symbol table for each place of each filter width."""

    def __init__(self, params: dict[str, np.ndarray], languages: list[str]):
        self.params, self.languages = params, languages

    @classmethod
    def fresh(cls, languages: list[str], seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        p = {f"conv{w}": rng.normal(0, 0.3, (w, N_SYMBOLS, FILTERS)).astype(np.float32) for w in WIDTHS}
        p["dense"] = rng.normal(0, 0.2, (FILTERS * len(WIDTHS), len(languages))).astype(np.float32)
        p["bias"] = np.zeros(len(languages), np.float32)
        return cls(p, languages)

    def pool(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Largest response of every filter, and where it is."""
        out, where = [], []
        for w in WIDTHS:
            tables = self.params[f"conv{w}"]
            n = x.shape[1] - w + 1
            r = tables[0][x[:, :n]]
            for j in range(1, w):
                r += tables[j][x[:, j: j + n]]
            at = r.argmax(axis=1)
            out.append(np.take_along_axis(r, at[:, None, :], 1)[:, 0])
            where.append(at)
        return np.concatenate(out, 1), where

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """Language probabilities of window rows, in batches."""
        out = np.empty((len(x), len(self.languages)))
        for i in range(0, len(x), _BATCH):
            part = x[i: i + _BATCH]
            best = []
            for w in WIDTHS:
                tables = self.params[f"conv{w}"]
                n = part.shape[1] - w + 1
                r = tables[0][part[:, :n]]
                for j in range(1, w):
                    r += tables[j][part[:, j: j + n]]
                best.append(r.max(axis=1))
            h = np.tanh(np.concatenate(best, 1))
            out[i: i + _BATCH] = softmax(h @ self.params["dense"] + self.params["bias"])
        return out

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int, seed: int = 11) -> None:
        rng, opt = np.random.default_rng(seed), Adam(self.params, 0.01)
        while opt.t < steps:
            order = rng.permutation(len(x))
            for i in range(0, len(x), 256):
                b = order[i: i + 256]
                top, where = self.pool(x[b])
                h = np.tanh(top)
                d = softmax(h @ self.params["dense"] + self.params["bias"])
                d[np.arange(len(b)), y[b]] -= 1
                d /= len(b)
                grads = {"dense": h.T @ d, "bias": d.sum(0)}
                g = (d @ self.params["dense"].T) * (1 - h * h)
                for k, w in enumerate(WIDTHS):
                    gt = np.zeros_like(self.params[f"conv{w}"])
                    part = g[:, k * FILTERS: (k + 1) * FILTERS]
                    f = np.broadcast_to(np.arange(FILTERS), part.shape)
                    for j in range(w):
                        s = np.take_along_axis(x[b], where[k] + j, 1)
                        np.add.at(gt[j], (s, f), part)
                    grads[f"conv{w}"] = gt
                opt.step({k: v.astype(np.float32) for k, v in grads.items()})


def train(docs: DataFrame, documents: int = TRAIN_DOCUMENTS, steps: int = STEPS) -> Network | None:
    """A network learned from at most ``documents`` rows with a text and a
    ``lang``, every language having its share; None if there are none."""
    rows = excerpts(bounded_sample(docs.where("text is not null and lang is not null and text <> ''")
                                   .select("doc_id", "text", "lang"), documents, F.col("lang")), WINDOW, TRAIN_WINDOWS)
    if not rows:
        return None
    languages = sorted({r["lang"] for r in rows})
    net = Network.fresh(languages)
    buf, off = tx.strings(pa.array([bytes(r["text"]) for r in rows], pa.large_binary()))
    start, length, doc = windows(buf, off)
    label = np.array([languages.index(r["lang"]) for r in rows])
    net.fit(cut(symbols()[buf], start, length), label[doc], steps)
    return net


def predict(net: Network | None, column: pa.Array, letters: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Language and score of every text of a slice."""
    sym = symbols()
    total = np.zeros((len(column), len(net.languages) if net else 1))
    weight = np.zeros(len(column))
    buf, off = tx.strings(column)
    start, length, doc = windows(buf, off)
    s = sym[buf]
    for i in range(0, len(start) if net else 0, _BATCH):
        j = slice(i, i + _BATCH)
        p = net.probabilities(cut(s, start[j], length[j]))
        np.add.at(total, doc[j], p * length[j, None])
        np.add.at(weight, doc[j], length[j])
    total /= np.maximum(weight, 1)[:, None]
    known = letters & (weight > 0)
    names = [net.languages[b] if k else UNKNOWN for b, k in zip(total.argmax(axis=1), known, strict=True)]
    return names, np.where(known, np.minimum(total.max(axis=1), 1.0), 0.0)


def _scorer(sent, only_known: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tx.slices(batch, "text"):
                names = part.schema.names
                letters = part.column(len(names) - 1).to_numpy(zero_copy_only=False)
                language, score = predict(sent.value, part.column(names.index("text")), letters)
                if only_known:
                    yield part.select(names[:-1]).filter(pa.array(
                        letters if sent.value is None else [x != UNKNOWN for x in language], pa.bool_()))
                else:
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), part.column(1), pa.array(language, pa.string()), pa.array(score)],
                        ["doc_id", "held_out", "lang_pred", "score"])
    return run


_LETTERS = r"\p{L}"


def identify(docs: DataFrame, net: Network | None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs``.

    ``und`` with score 0 stands for a null text, a text without letters, and
    every text if the network is None.  Every row is scored alone, so repeated
    rows get equal results; equal probabilities go to the first language by
    name.  Other columns are not read; an empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(net)  # about 60 kB, whatever the input
    rows = docs.select("doc_id", held_out().alias("held_out"), "text",
                       F.coalesce(F.col("text").rlike(_LETTERS), F.lit(False)).alias("letters"))
    return arrow(rows, _scorer(sent, False), f"doc_id {dict(docs.dtypes)['doc_id']}, held_out boolean, "
                                             "lang_pred string, score double")


def accept(docs: DataFrame, net: Network | None) -> DataFrame:
    """The rows of ``docs`` that get a language (not ``und``), unchanged; if the
    network is None, the rows whose text has letters."""
    sent = docs.sparkSession.sparkContext.broadcast(net)
    rows = docs.select("*", F.coalesce(F.col("text").rlike(_LETTERS), F.lit(False)).alias(spare(docs, "_letters")[0]))
    return arrow(rows, _scorer(sent, True), docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, train(docs.where(learnable())))
