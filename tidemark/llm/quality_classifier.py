"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` bytes that together are its whole
text.  Every passage is encoded; gated attention, learned from labels of whole
documents only, weighs the encodings; a linear layer scores the weighted mean.
The network is trained in numpy on a bounded sample of labelled documents and
sent to the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import text as tx
from tidemark.llm.common import arrow, held_out, learnable, table
from tidemark.llm.nn import Adam, bounded_sample, excerpts

PASSAGE = 384
#: Hashed byte pairs, byte classes, distinct three-byte strings.
PAIRS, CLASSES, TRIPLES = 128, 8, 1024
FEATURES = PAIRS + CLASSES + 1
HIDDEN, ATTENTION = 24, 12
#: Labelled documents that the network learns from, at most.
TRAIN_DOCUMENTS = 2_000
#: Passages of one of them that a training step reads, evenly spread.
TRAIN_PASSAGES = 32
STEPS = 300
_BATCH = 64


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Byte classes: other symbols, capitals, small letters, digits, blanks,
    sentence marks, bytes of UTF-8 sequences, repeated-symbol marks."""
    t = np.zeros(256, np.int64)
    for c, spans in ((1, [(65, 90)]), (2, [(97, 122)]), (3, [(48, 57)]), (4, [(9, 13), (32, 32)]),
                     (5, [(44, 44), (46, 46), (58, 59), (63, 63)]), (6, [(128, 255)]),
                     (7, [(33, 33), (35, 38), (42, 42), (60, 60), (62, 62), (124, 124)])):
        for a, b in spans:
            t[a: b + 1] = c
    return t


def _features(part: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Features of adjoining passages that together are ``part``."""
    total = len(length)
    out = np.zeros((total, FEATURES), np.float32)
    b = part.astype(np.int64)
    bag = np.repeat(np.arange(total), length)
    n = np.maximum(length, 1)[:, None].astype(np.float32)
    same = bag[1:] == bag[:-1]
    pair = ((b[:-1] * 31 + b[1:]) * 40503 >> 4) % PAIRS
    counts = np.bincount((bag[:-1] * PAIRS + pair)[same], minlength=total * PAIRS)
    out[:, :PAIRS] = np.sqrt(counts.reshape(total, PAIRS) / n)
    counts = np.bincount(bag * CLASSES + classes()[b], minlength=total * CLASSES)
    out[:, PAIRS: PAIRS + CLASSES] = counts.reshape(total, CLASSES) / n
    same = bag[2:] == bag[:-2]
    triple = ((b[:-2] * 961 + b[1:-1] * 31 + b[2:]) * 40503 >> 4) % TRIPLES
    seen = np.zeros(total * TRIPLES, bool)
    seen[(bag[:-2] * TRIPLES + triple)[same]] = True
    out[:, -1] = seen.reshape(total, TRIPLES).sum(1) / n[:, 0]
    return out


def passages(buf: np.ndarray, offsets: np.ndarray, block: int = 2_048) -> tuple[np.ndarray, np.ndarray]:
    """(features, doc) of every passage; an empty text has one, all zero."""
    size = np.diff(offsets)
    n = np.maximum(-(-size // PASSAGE), 1)
    doc = np.repeat(np.arange(len(size)), n)
    at = (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * PASSAGE
    length = np.minimum(PASSAGE, size[doc] - at)
    start = offsets[doc] + at
    out = [_features(buf[start[k]: start[min(k + block, len(start)) - 1] + length[min(k + block, len(start)) - 1]],
                     length[k: k + block]) for k in range(0, len(start), block)]
    return np.concatenate([np.empty((0, FEATURES), np.float32), *out]), doc


def _sum(x: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Sums of rows by document; ``doc`` is sorted and has every number."""
    return np.add.reduceat(x, np.searchsorted(doc, np.arange(n)), axis=0)


class Network:
    """Encoder, gated attention and scorer."""

    def __init__(self, params: dict[str, np.ndarray], mean: np.ndarray, std: np.ndarray):
        self.params, self.mean, self.std = params, mean, std

    @classmethod
    def fresh(cls, mean: np.ndarray, std: np.ndarray, seed: int = 5) -> Network:
        rng = np.random.default_rng(seed)
        def w(a: int, b: int) -> np.ndarray:
            return rng.normal(0, 1 / np.sqrt(a), (a, b))
        return cls({"encode": w(FEATURES, HIDDEN), "encode_b": np.zeros(HIDDEN),
                    "tanh": w(HIDDEN, ATTENTION), "gate": w(HIDDEN, ATTENTION), "weigh": w(ATTENTION, 1),
                    "score": w(HIDDEN, 1), "score_b": np.zeros(1)}, mean, std)

    def forward(self, x: np.ndarray, doc: np.ndarray, n: int) -> dict[str, np.ndarray]:
        p = self.params
        x = (x - self.mean) / self.std
        h = np.tanh(x @ p["encode"] + p["encode_b"])
        t, g = np.tanh(h @ p["tanh"]), 1 / (1 + np.exp(-(h @ p["gate"])))
        e = ((t * g) @ p["weigh"])[:, 0]
        top = np.maximum.reduceat(e, np.searchsorted(doc, np.arange(n)))
        a = np.exp(e - top[doc])
        a /= _sum(a, doc, n)[doc]
        z = _sum(a[:, None] * h, doc, n)
        s = (z @ p["score"] + p["score_b"])[:, 0]
        return {"x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "p": 1 / (1 + np.exp(-np.clip(s, -30, 30)))}

    def gradients(self, f: dict, doc: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict:
        p = self.params
        ds = ((f["p"] - y) * weight / weight.sum())[:, None]
        dz = ds @ p["score"].T
        dh = f["a"][:, None] * dz[doc]
        da = (f["h"] * dz[doc]).sum(1)
        de = f["a"] * (da - _sum(f["a"] * da, doc, len(y))[doc])
        dtg = de[:, None] @ p["weigh"].T
        dt = dtg * f["g"] * (1 - f["t"] ** 2)
        dg = dtg * f["t"] * f["g"] * (1 - f["g"])
        dh += dt @ p["tanh"].T + dg @ p["gate"].T
        dpre = dh * (1 - f["h"] ** 2)
        decay = 1e-4
        grads = {"score": f["z"].T @ ds, "score_b": ds.sum(0), "weigh": (f["t"] * f["g"]).T @ de[:, None],
                 "tanh": f["h"].T @ dt, "gate": f["h"].T @ dg, "encode": f["x"].T @ dpre,
                 "encode_b": dpre.sum(0)}
        return {k: v + decay * p[k] for k, v in grads.items()}


def train(labelled: DataFrame, documents: int = TRAIN_DOCUMENTS, steps: int = STEPS) -> Network | float:
    """A network learned from at most ``documents`` rows of ``doc_id, text,
    quality``, both classes having a half of them if there are enough, and
    weighing the same.  With only one class (or no
    rows) that class (or 0.5) is the answer for every text."""
    rows = excerpts(bounded_sample(labelled.select("doc_id", "text", "quality"), documents, F.col("quality") >= 1),
                    PASSAGE, TRAIN_PASSAGES)
    y = np.array([float(r["quality"] >= 1) for r in rows])
    if len(set(y)) < 2:
        return float(y[0]) if len(y) else 0.5
    buf, off = tx.strings(pa.array([bytes(r["text"]) for r in rows], pa.large_binary()))
    x, doc = passages(buf, off)
    edge = np.searchsorted(doc, np.arange(len(rows) + 1))
    pick = [np.arange(a, b) for a, b in zip(edge[:-1], edge[1:], strict=True)]
    net = Network.fresh(x.mean(0), x.std(0) + 1e-3)
    rng, opt = np.random.default_rng(3), Adam(net.params, 0.01)
    weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    while opt.t < steps:
        order = rng.permutation(len(rows))
        for i in range(0, len(rows), _BATCH):
            b = order[i: i + _BATCH]
            at = np.concatenate([pick[j] for j in b])
            own = np.repeat(np.arange(len(b)), [len(pick[j]) for j in b])
            f = net.forward(x[at], own, len(b))
            opt.step(net.gradients(f, own, y[b], weight[b]))
    return net


def _scorer(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = sent.value
        for batch in batches:
            for part in tx.slices(batch, "text", 1_000_000):
                names = part.schema.names
                n = part.num_rows
                if isinstance(net, float):
                    score, n_passages = np.full(n, net), np.zeros(n, np.int64)
                else:
                    x, doc = passages(*tx.strings(part.column(names.index("text"))))
                    score, n_passages = net.forward(x, doc, n)["p"], np.bincount(doc, minlength=n)
                yield pa.RecordBatch.from_arrays([
                    part.column(names.index("doc_id")), part.column(names.index("held_out")),
                    pa.array(score), pa.array((score >= 0.5).astype(np.int32)),
                    pa.array(n_passages, pa.int64()),
                ], ["doc_id", "held_out", "score", "predicted", "n_passages"])
    return run


def score(docs: DataFrame, net: Network | float) -> DataFrame:
    """``doc_id, held_out, score, predicted, n_passages`` for every row.

    A null text counts as empty; an empty text is one passage of zeros and gets
    a score like any other.  Each row is scored alone: repeated rows get equal
    scores, a score of exactly 0.5 predicts 1.  Other columns are not read; an
    empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(net)  # about 40 kB, whatever the input
    return arrow(docs.select("doc_id", "text", held_out().alias("held_out")), _scorer(sent),
                 f"doc_id {dict(docs.dtypes)['doc_id']}, held_out boolean, score double, "
                 "predicted int, n_passages long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(learnable()).where("quality is not null")
    # only the labelled rows that the sample may hold meet the texts
    few = bounded_sample(labels.select("doc_id", "quality"), TRAIN_DOCUMENTS, F.col("quality") >= 1).drop("__h")
    few = spark.createDataFrame(few.distinct().collect(), few.schema)
    net = train(docs.select("doc_id", "text").join(F.broadcast(few), "doc_id"))
    return score(docs, net)
