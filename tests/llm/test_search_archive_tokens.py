"""Lexical search, the archive and the alignment of two tokenizers against brute
force and round trips."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from data import awkward, frame, lower, sha
from pyspark.sql import functions as F

from tidemark.llm import lexical_search, token_alignment, warc_archive
from tidemark.session import shared_dir

SEARCH_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


# ------------------------------------------------------------------ search

def ranked(rows, items, top):
    """(item, rank, doc, score), counting every term of every document."""
    docs = [(i, Counter(SEARCH_TERM.findall(lower(t)))) for i, t in rows]
    docs = [(i, c) for i, c in docs if c]
    n, total = len(docs), sum(sum(c.values()) for _, c in docs)
    out = []
    for item, text in set(items):
        scored = []
        for doc, c in docs:
            m, score = 75 + 25 * sum(c.values()) * n // total, 0
            for t, times in Counter(SEARCH_TERM.findall(lower(text))).items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * sum(t in x for _, x in docs) + 1)))
                    score += times * w * (10 ** 9 * c[t] // (1000 * c[t] + 12 * m))
            if score > 0:
                scored.append((-score, doc is None, doc))
        scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, k + 1, d, -s) for k, (s, _, d) in enumerate(scored[:top])]
    return sorted(out, key=str)


ITEMS = [(1, "the OF alpha"), (2, None), (3, " -- |"), (4, "x1 x1 é 日本"), (5, "nowhere"), (None, "a b ## the"),
         (6, "The\tthe-THE the, alpha"), (6, "another text of six, beta"), (1, "the OF alpha"), (7, "12 34"),
         (8, "al pha alphabeta _beta_ x 1")]


@pytest.mark.parametrize("block_bytes,top", [(1_000_000, 20), (1_000_000, 3), (8, 5)])
def test_search_ranks_like_brute_force(spark, block_bytes, top):
    rows = awkward() + [(200, "alpha_beta/x1 [the] {of}"), (201, "ALPHA Alpha alphas"), (202, "the the the")]
    got = lexical_search.search(frame(spark, rows), spark.createDataFrame(ITEMS, "item_id long, text string"),
                                top=top, block_bytes=block_bytes).collect()
    assert sorted(map(tuple, got), key=str) == ranked(rows, ITEMS, top)


def test_search_of_small_pieces_and_string_ids(spark, monkeypatch):
    rows = awkward()
    want = ranked(rows, ITEMS, 4)
    monkeypatch.setattr(lexical_search, "_HELD", 7)  # the functions are sent with the module's value
    docs = frame(spark, rows).withColumn("doc_id", F.col("doc_id").cast("string")).repartition(3)
    got = lexical_search.search(docs, spark.createDataFrame(ITEMS, "item_id long, text string"), top=4).collect()
    # equal scores: strings are in another order than numbers
    assert sorted((r.item_id, r.rank, r.score) for r in got if r.item_id) == sorted(
        (i, k, s) for i, k, _, s in want if i)


def test_search_of_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical_search.search(frame(spark, []), items).count() == 0
    none = lexical_search.search(frame(spark, awkward()), items.limit(0))
    assert none.count() == 0 and none.columns == ["item_id", "rank", "doc_id", "score"]
    assert lexical_search.search(frame(spark, [(1, None), (2, "--")]), items).count() == 0


def test_parts_of_a_slice():
    import pyarrow as pa
    texts = ["a b a", None, "", "B", "ab a", "--", "b"]
    buf, off = lexical_search._blanked(pa.array(texts))
    assert lexical_search._lengths(buf, off).tolist() == [3, 0, 0, 1, 2, 0, 1]
    text, term, n = lexical_search.Terms(["a", "b"]).counts(buf, off)
    assert list(zip(text.tolist(), term.tolist(), n.tolist(), strict=True)) == [
        (0, 0, 2), (0, 1, 1), (3, 1, 1), (4, 0, 1), (6, 1, 1)]
    big = lexical_search._spread(np.array([10 ** 9, 3]), 10 ** 12, 10 ** 13)
    assert big.tolist() == [75 + 25 * 10 ** 8, 75 + 25 * 3 // 10]


# ------------------------------------------------------------------ archive

def pages(spark, n=60):
    rng = random.Random(4)
    html = [None, "", "short", "<p>" + "x" * 200, "<p>é日本" * 30, "a\r\n\r\nWARC/1.1\r\nContent-Length: 9\r\n\r\n" * 9,
            "<p>" + "y" * 100_000]
    rows = [(i, f"http://h{i}.org/?q=ü&x", rng.choice(html)) for i in range(n)]
    rows += [(None, "http://no.id/", html[3]), (None, None, "only without id " * 20), (None, None, "only without id " * 20),
             (500, "http://evil.org/\r\nWARC-Type: revisit\r\n", html[4]), rows[7], rows[7], (3, "again", html[6])]
    schema = "page_id long, url string, html string, head string, payload string, address string, first long, digest string"
    return rows, spark.createDataFrame([(*r, "z", "z", "z", 1, "z") for r in rows], schema)


def described(rows):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        again = len(data) >= 100 and (h or "") in first and i != first[h or ""]
        out.append((i, "revisit" if again else "response", first[h or ""] if again else None, data))
    return sorted(out, key=str)


def test_archive_gives_the_records_back(spark):
    rows, df = pages(spark)
    root = warc_archive.archive(df, shared_dir(spark, "test-warc"))
    got = warc_archive.records(spark, root).collect()
    assert sorted(((r.page_id, r.record_type, r.refers_to, bytes(r.payload)) for r in got), key=str) == described(rows)
    stored = spark.read.parquet(f"{root}/payloads").collect()
    assert sorted(bytes(r.payload) for r in stored) == sorted({(h or "").encode() for _, _, h in rows})
    assert all(sha(bytes(r.payload)) == r.address for r in stored)
    assert "payload" not in spark.read.parquet(f"{root}/records").columns
    for r in got:
        head = bytes(r["head"]).decode()
        warc, http, rest = head.split("\r\n\r\n")
        assert rest == "" and f"WARC-Payload-Digest: sha256:{sha(bytes(r.payload))}" in warc
        size = len(http) + 4 + (len(r.payload) if r.record_type == "response" else 0)
        assert warc.count("WARC-Type: ") == 1 + ("evil" in warc) and warc.endswith(f"\r\nContent-Length: {size}")
        assert len(re.findall(r"^WARC-Type: ", warc, re.M)) == 1


def test_archive_files_round_trip(spark):
    rows, df = pages(spark)
    root = warc_archive.archive(df, shared_dir(spark, "test-warc"))
    path = shared_dir(spark, "test-warc-files")
    warc_archive.export(spark, root, path, records_per_file=3)
    files = warc_archive.read_files(spark, path)
    want = {(h["page_id"], bytes(h["head"]), bytes(h["payload"]) if h["record_type"] == "response" else b"")
            for h in warc_archive.records(spark, root).collect()}
    got = files.collect()
    assert len(got) == len(rows) and {(r.page_id, bytes(r["head"]), bytes(r.payload)) for r in got} == want
    assert {(r.page_id, r.record_type, r.refers_to) for r in got} == {x[:3] for x in described(rows)}


def test_archive_proves_its_addresses(spark):
    _, df = pages(spark)
    with pytest.raises(Exception, match="different payloads under one address"):
        warc_archive.archive(df, shared_dir(spark, "test-warc"), address=lambda p: F.length(p) % 7)


def test_archive_of_nothing_and_of_string_ids(spark):
    _, df = pages(spark)
    empty = warc_archive.archive(df.limit(0), shared_dir(spark, "test-warc"))
    assert warc_archive.records(spark, empty).count() == 0
    odd = spark.createDataFrame([("b>\r\n%", "u", "x" * 150), ("a b", "u", "x" * 150), ("ü", None, "y")],
                                "page_id string, url string, html string")
    got = warc_archive.records(spark, warc_archive.archive(odd, shared_dir(spark, "test-warc"))).collect()
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in got) == [
        ("a b", "response", None), ("b>\r\n%", "revisit", "a b"), ("ü", "response", None)]


# ------------------------------------------------------------------ tokenizers

@pytest.fixture(scope="module")
def pair():
    def read(path):
        with open(path, "rb") as f:
            return f.read()
    return token_alignment.Pair(read(token_alignment.BYTE_BPE), read(token_alignment.PIECE_BPE))


def tokens(pair, text):
    """Both id lists of a whole text, encoded at once."""
    if not text:
        return [], []
    a = pair.a.encode(" " + text, add_special_tokens=False).ids
    b = pair.b.encode(text)
    want = b" " + text.encode()
    if b"".join(pair.a_bytes[x] for x in a) != want or b"".join(pair.b_bytes[x] for x in b) != want:
        return [], []
    return a, b


def grouped(pair, a, b):
    """Groups of a text, one byte offset after the other."""
    ends_a = list(np.cumsum([len(pair.a_bytes[x]) for x in a]))
    ends_b = list(np.cumsum([len(pair.b_bytes[x]) for x in b]))
    out, i, j = [], 0, 0
    for end in [x for x in ends_a if x in set(ends_b)]:
        x, y = ends_a.index(end) + 1, ends_b.index(end) + 1
        out.append((a[i:x], b[j:y]))
        i, j = x, y
    return out, ends_a, ends_b


def linked(pair, rows):
    found = []
    for i, t in rows:
        a, b = tokens(pair, t)
        groups, ea, eb = grouped(pair, a, b)
        links = [(a[x], b[y]) for x in range(len(a)) for y in range(len(b))
                 if max(([0] + ea)[x], ([0] + eb)[y]) < min(ea[x], eb[y])]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        found.append((i, a, b, groups, links, sha(text.encode()) if a else ""))
    count = Counter(x for f in found for x in f[4])
    most = {}
    for (_, b), n in count.items():
        most[b] = max(n, most.get(b, 0))
    return sorted(((i, len(a), len(b), len(g), len(ls), sum(count[x] == most[x[1]] for x in ls),
                    sum(count[x] for x in ls), digest) for i, a, b, g, ls, digest in found), key=str)


ODD_TEXTS = [" lead", "trail ", "two  blanks", "tab\tand\nline\n\n end", "<s> </s> <unk> <|endoftext|> <0x41>", "▁ piece",
             "a b   c", "naïve é 🙂🙂 ‍ x", "\x00 zero \x01", "don't we'll 1234567 3.14 !!!", " ", "\n",
             "日本語のテキスト と 空白", "a" * 500, "x\r\ny \r\n z", "ﬁ ２ Å", "The quick brown fox " * 40]


def token_rows():
    rows = [(i, t if t is None or len(t) < 2000 else t[:700]) for i, t in awkward()]
    return rows + [(1000 + i, t) for i, t in enumerate(ODD_TEXTS)]


@pytest.mark.parametrize("common", [1_000_000, 40, 0])
def test_links_like_brute_force(spark, pair, common):
    rows = token_rows()
    got = token_alignment.link_counts(frame(spark, rows), common_pairs=common).collect()
    assert sorted(map(tuple, got), key=str) == linked(pair, rows)


def test_alignment_gives_groups(spark, pair):
    rows = token_rows()
    got = token_alignment.align(frame(spark, rows)).collect()
    want = []
    for i, t in rows:
        a, b = tokens(pair, t)
        groups = grouped(pair, a, b)[0]
        want.append((i, a, b, np.cumsum([len(x) for x, _ in groups], dtype=int).tolist(),
                     np.cumsum([len(y) for _, y in groups], dtype=int).tolist()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_alignment_of_empty_table_and_string_ids(spark):
    assert token_alignment.link_counts(frame(spark, [])).count() == 0
    docs = spark.createDataFrame([("x", "one two"), (None, "one two"), ("y", None)], "doc_id string, text string")
    got = {r.doc_id: (r.n_a, r.n_links, r.groups_sha256) for r in token_alignment.link_counts(docs).collect()}
    assert got["x"] == got[None] and got["x"][0] > 0 and got["y"] == (0, 0, "")


@pytest.mark.parametrize("lane", [1, 3, 64])
def test_skipped_runs_are_the_common_ends(lane):
    rng = np.random.default_rng(lane)
    for density in (0.05, 0.5, 0.95):
        for n in (1, 2, 7, 500):
            a, b = (np.append(np.flatnonzero(rng.random(n) < density), n) for _ in "ab")
            close_a, close_b = token_alignment.skip_runs(a, b, lane)
            assert (close_a == np.isin(a, b)).all() and (close_b == np.isin(b, a)).all()
    same = np.arange(1, 1000)
    assert all(x.all() for x in token_alignment.skip_runs(same, same, lane))


def test_long_texts_are_encoded_in_runs(pair, monkeypatch):
    """Cut texts, a small cache and small joins give the tokens of the whole text."""
    monkeypatch.setattr(token_alignment, "_JOINED", 50)
    monkeypatch.setattr(token_alignment, "CACHED_RUNS", 5)
    pair._forget()
    texts = ODD_TEXTS + [t for _, t in awkward(6) if t] + [" ".join(ODD_TEXTS)]
    for _ in range(2):
        (a, a_cut), (b, b_cut) = pair.encode(texts)
        for i, t in enumerate(texts):
            assert (a[a_cut[i]:a_cut[i + 1]].tolist(), b[b_cut[i]:b_cut[i + 1]].tolist()) == tuple(tokens(pair, t))
    pair._forget()
