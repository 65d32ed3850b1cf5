"""Substring and suffix dedup against brute force."""

import random

import pytest
from data import WORD, awkward, frame, repeats, sha

from tidemark.llm import substring_dedup, suffix_dedup


def words(text):
    return WORD.findall(text or "")


def periodic(seed, n=24):
    """Few letters, so that windows repeat, overlap and tie."""
    rng = random.Random(seed)
    parts = ["".join(rng.choice("ab ") for _ in range(60)) for _ in range(4)]
    out = []
    for i in range(n):
        text = "".join(rng.choice(parts)[rng.randrange(20):] + rng.choice(["", "c", "ba", "é "]) for _ in range(4))
        out.append((i, text))
    return out + [(50, "ab" * 120), (51, "ab" * 100 + "c"), (52, None), (53, "")]


def check_bytes(spark, rows, window, gram, group_rows):
    got = suffix_dedup.remove_repeats(frame(spark, rows), window, gram, group_rows).collect()
    gone = repeats(lambda t: (t or "").encode(), rows, window, every=True)
    want = []
    for i, t in rows:
        data, cut = (t or "").encode(), gone[i, t]
        kept = bytes(b for p, b in enumerate(data) if p not in cut)
        spans = sum(1 for p in cut if p - 1 not in cut)
        want.append((i, len(data), len(cut), spans, sha(kept), kept))
    assert sorted((tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in got), key=str) \
        == sorted(want, key=str)


def check_words(spark, rows, window, gram, group_rows):
    got = substring_dedup.remove_repeats(frame(spark, rows), window, gram, group_rows)
    gone = repeats(words, rows, window, every=False)
    want = []
    for i, t in rows:
        w, cut = words(t), gone[i, t]
        kept = " ".join(x for p, x in enumerate(w) if p not in cut)
        want.append((i, len(w), len(cut), sha(kept.encode()), kept))
    assert sorted(map(tuple, got.drop("_d", "_h").collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("seed, group_rows", [(1, 4096), (2, 3)])
def test_bytes(spark, seed, group_rows):
    check_bytes(spark, periodic(seed), 24, 6, group_rows)


def test_bytes_awkward(spark):
    check_bytes(spark, awkward(), 400, 100, 4096)


@pytest.mark.parametrize("seed, group_rows", [(1, 4096), (3, 2)])
def test_words(spark, seed, group_rows):
    check_words(spark, periodic(seed, 40), 6, 2, group_rows)


def test_words_awkward(spark):
    rows = [r for r in awkward() if not (r[0] == 5 and r[1].startswith("same id"))]
    rows = [r for r in rows if r != (None, None)]  # two rows without id have no defined text order
    check_words(spark, rows, 20, 6, 4096)


def test_clean_keeps_other_texts(spark):
    rows = [(1, "a  b\tc " * 12), (2, "x " + "a b c " * 12), (3, "short\n text "), (4, None)]
    docs = frame(spark, rows)
    got = substring_dedup.clean(docs)
    assert got.columns == docs.columns
    text = {r.doc_id: r.text for r in got.collect()}
    assert text[3] == "short\n text " and text[4] is None
    # of the periodic text, the words of the first three windows stay, all different
    assert text[1] == "a b c" and text[2] == "x"


def test_empty(spark):
    assert suffix_dedup.remove_repeats(frame(spark, [])).count() == 0
    assert substring_dedup.remove_repeats(frame(spark, [])).count() == 0


def test_mergesort_orders_suffixes():
    import numpy as np
    rng = np.random.default_rng(0)
    buf = rng.integers(97, 99, 3000).astype(np.uint8)
    start = rng.permutation(2900)[:500]
    size = np.array([300, 150, 49, 1])
    first = np.cumsum(size) - size
    s = suffix_dedup.Suffixes(buf, 64)
    got = s.sort(start, first, size)
    for f, n in zip(first, size, strict=True):
        want = sorted(start[f:f + n], key=lambda x: bytes(buf[x:x + 64]))
        assert [bytes(buf[x:x + 64]) for x in got[f:f + n]] == [bytes(buf[x:x + 64]) for x in want]
