"""SimHash near-duplicates and connected components against brute force."""

import numpy as np
import pytest
from data import awkward, components_of, fingerprint, frame

from tidemark.llm import simhash
from tidemark.llm.graph import components


def check(spark, rows, got):
    prints = [fingerprint(t) for _, t in rows]
    label = components_of(prints)
    least = {}
    for (i, _), c in zip(rows, label, strict=True):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    want = sorted(((i, format(p, "016x"), least.get(c)) for (i, _), p, c in zip(rows, prints, label, strict=True)),
                  key=str)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got.collect()), key=str) == want


@pytest.mark.parametrize("tile", [4096, 2])
def test_against_all_pairs(spark, tile):
    base = "one two three four five six seven eight nine ten " * 6
    rows = awkward() + [(200 + i, base + f"tail{i % 7}") for i in range(30)]
    check(spark, rows, simhash.near_duplicates(frame(spark, rows), tile=tile))


def test_empty(spark):
    assert simhash.near_duplicates(frame(spark, [])).count() == 0
    assert simhash.deduplicate(frame(spark, [])).count() == 0


def test_one_document_of_each_stays(spark):
    rows = awkward()
    docs = frame(spark, rows)
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    label = components_of([fingerprint(t) for _, t in rows])
    assert kept.count() == len(set(label))


@pytest.mark.parametrize("radius", [0, 1, 3, 5])
def test_close_pairs(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 2 ** 63, 9, dtype=np.int64)
    fp = np.repeat(base, 40)
    for i in range(len(fp)):
        for b in rng.integers(0, 64, rng.integers(0, 5)):
            fp[i] ^= np.int64(1) << np.int64(b)
    size = np.array([200, 100, 40, 15, 5])
    got = {(int(a), int(b)) for i, j in simhash.close_pairs(fp, size, radius) for a, b in zip(i, j, strict=True)}
    group = np.repeat(np.arange(5), size)
    want = {(i, j) for i in range(360) for j in range(i + 1, 360) if group[i] == group[j]
            and int(np.bitwise_count((fp[i] ^ fp[j]).view(np.uint64))) <= radius}
    assert got == want


def test_pairs_within_radius_share_a_table(spark):
    rng = np.random.default_rng(2)
    pairs = []
    for _ in range(200):
        a = int(rng.integers(-2 ** 63, 2 ** 63))
        b = a
        for bit in rng.choice(64, 3, replace=False):
            b ^= (1 << int(bit)) if bit < 63 else -(1 << 63)
        pairs.append((a, b))
    from pyspark.sql import functions as F
    df = spark.createDataFrame(pairs, "a long, b long")
    same = df.select(F.arrays_overlap(F.array(*simhash.table_keys(F.col("a"))),
                                      F.array(*simhash.table_keys(F.col("b")))).alias("x"))
    assert same.where("not x").count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 50)]
    edges = chain + star + [(5, 5), (None, 7), (60, 0), (1, 0), (2000, 2001), (2001, 2000)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(50)} | {2000: 2000, 2001: 2000}
    assert got == want
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
