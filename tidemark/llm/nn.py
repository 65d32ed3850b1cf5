"""Training helpers for the small numpy models."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import arrow, written

_HELD_ROWS = 50_000
_SPARE = 4


def _smallest(n: int):
    """The ``n`` smallest hashes of each value in a task's rows."""
    def cut(parts: list[pd.DataFrame]) -> pd.DataFrame:
        return pd.concat(parts).drop_duplicates().sort_values("__h").groupby("value", dropna=False).head(n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pd.DataFrame] = []
        rows, limit = 0, _HELD_ROWS
        for batch in batches:
            parts.append(batch.to_pandas())
            rows += batch.num_rows
            if rows > limit:
                parts = [cut(parts)]
                rows = len(parts[0])
                limit = 2 * rows + _HELD_ROWS
        if parts:
            yield pa.RecordBatch.from_pandas(cut(parts), preserve_index=False, schema=pa.schema(
                [("value", pa.string()), ("__h", pa.int64())]))
    return run


def bounded_sample(df: DataFrame, n: int, by: Column, seed: int = 0) -> DataFrame:
    """At most ``n`` different rows of ``df``, spread evenly over the values of
    ``by``: of each, those whose hash ``__h`` over all columns is smallest, and
    more of the others where a value has too few.  The same rows on every run.

    Rows are counted by value first; only those with a hash below a threshold, in
    which some ``_SPARE * n`` rows of a value are expected, are ranked, so that a
    value with a third of all rows doesn't meet whole in one task.  Where repeated
    rows leave too few, the threshold is raised."""
    rows = df.withColumn("__h", F.xxhash64(*df.columns, F.lit(seed)))
    keys = rows.select(by.cast("string").alias("value"), "__h")
    count = written(keys.groupBy("value").count(), "sample-classes").withColumnRenamed("value", "_v")
    share = _SPARE * n
    while True:
        # hashes lie evenly between -2^63 and 2^63
        below = F.least(F.lit(1.0), F.lit(float(share)) / F.col("count"))
        limit = (below - 0.5) * 2.0 ** 64
        near = keys.join(count, F.col("value").eqNullSafe(F.col("_v"))).where(
            (below >= 1.0) | (F.col("__h").cast("double") <= limit)).select("value", "__h")
        near = arrow(near, _smallest(n), "value string, __h long").distinct()
        rank = F.row_number().over(Window.partitionBy("value").orderBy("__h"))
        top = written(near.withColumn("rank", rank).where(F.col("rank") <= n), "sample")
        kept = top.groupBy("value").agg(F.max("rank").alias("_kept"))
        short = count.join(kept, F.col("value").eqNullSafe(F.col("_v")), "left").where(
            (F.col("count") > share) & (F.coalesce("_kept", F.lit(0)) < n))
        if short.isEmpty():
            break
        share *= 16
    top = top.orderBy("rank", "__h").limit(n).select("__h")
    return rows.join(F.broadcast(top), "__h").select(*df.columns, "__h")


def excerpts(rows: DataFrame, unit: int, pieces: int) -> list:
    """The rows of a sample in order of ``__h``, each once, with at most
    ``pieces`` runs of ``unit`` bytes of ``text``, evenly spread, the last one
    too.  The texts are cut in the tasks, before they reach the driver."""
    def cut(text: bytes | None) -> bytes:
        text = text or b""
        n = -(-len(text) // unit)
        if n <= pieces:
            return text
        return b"".join(text[i * unit: (i + 1) * unit]
                        for i in np.unique(np.linspace(0, n - 1, pieces).astype(int)).tolist())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            short = pa.array([cut(x) for x in batch.column(at).cast(pa.large_binary()).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([short if i == at else c for i, c in enumerate(batch.columns)],
                                             batch.schema.names)

    schema = ", ".join(f"{c} {'binary' if c == 'text' else t}" for c, t in rows.dtypes)
    return sorted(arrow(rows, run, schema).distinct().collect(), key=lambda r: r["__h"])


class Adam:
    """Adam steps on a dict of arrays, in place."""

    def __init__(self, params: dict[str, np.ndarray], rate: float):
        self.params, self.rate, self.t = params, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, g in grads.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            m = self.m[k] / (1 - 0.9 ** self.t)
            v = self.v[k] / (1 - 0.999 ** self.t)
            self.params[k] -= self.rate * m / (np.sqrt(v) + 1e-8)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)
