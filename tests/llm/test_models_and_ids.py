"""Naive versions of both networks, ids of other types, samples of hot classes,
url decisions on pages with many links."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from data import awkward, frame
from pyspark.sql import functions as F

from tidemark.llm import language_id, mixing, nn, quality_classifier, simhash, substring_dedup, suffix_dedup, url_filter
from tidemark.llm import text as tx
from tests.helpers import assert_same

TEXTS = ["", "a", "Short text, 12!", "Ünïcode 日本 " * 9, "The quick brown fox. " * 70, "x" * 1500, "\t\n  "]


# ------------------------------------------------------------------ language

def slow_language(net, data):
    """Scores of one text: one filter, place and window after the other."""
    sym, size = language_id.symbols(), language_id.WINDOW
    total, weight = [0.0] * len(net.languages), 0
    for a in range(0, len(data), size):
        part = [int(sym[b]) for b in data[a: a + size]]
        n = len(part)
        part += [0] * (size - n)
        hidden = []
        for w in language_id.WIDTHS:
            table = net.params[f"conv{w}"]
            for f in range(language_id.FILTERS):
                hidden.append(math.tanh(max(sum(float(table[j][part[i + j]][f]) for j in range(w))
                                            for i in range(size - w + 1))))
        out = [float(net.params["bias"][c]) + sum(h * float(net.params["dense"][k][c]) for k, h in enumerate(hidden))
               for c in range(len(net.languages))]
        top = max(out)
        e = [math.exp(x - top) for x in out]
        total = [t + n * x / sum(e) for t, x in zip(total, e, strict=True)]
        weight += n
    return [t / weight for t in total] if weight else total


def test_language_network_like_its_naive_version():
    net = language_id.Network.fresh(["de", "en", "fr"], seed=3)
    column = pa.array(TEXTS)
    names, scores = language_id.predict(net, column, np.array([any(c.isalpha() for c in t) for t in TEXTS]))
    for t, name, s in zip(TEXTS, names, scores, strict=True):
        want = slow_language(net, t.encode())
        if any(c.isalpha() for c in t):
            assert name == net.languages[int(np.argmax(want))] and abs(s - max(want)) < 1e-5
        else:
            assert (name, s) == ("und", 0.0)


def test_language_gradients():
    """One small step of plain descent along ``fit``'s gradients: its loss falls
    as the numeric derivatives say."""
    rng = np.random.default_rng(0)
    net = language_id.Network.fresh(["a", "b"], seed=1)
    net.params = {k: v.astype(np.float64) for k, v in net.params.items()}
    x, y = rng.integers(0, 156, (6, language_id.WINDOW)).astype(np.uint8), np.array([0, 1, 0, 1, 1, 0])

    def loss():
        p = net.probabilities(x)
        return -np.log(p[np.arange(6), y]).mean()
    seen = {}

    class Spy:
        def __init__(self, params, rate):
            self.t = 0

        def step(self, grads):
            self.t += 1
            seen.update(grads)
    with pytest.MonkeyPatch.context() as m:
        m.setattr(language_id, "Adam", Spy)
        net.fit(x, y, 1)
    for name, grad in seen.items():
        flat = net.params[name].reshape(-1)
        for i in rng.choice(np.flatnonzero(np.abs(grad).ravel() > 1e-4), 5):
            keep, h = flat[i], 1e-5
            flat[i] = keep + h
            up = loss()
            flat[i] = keep - h
            down = loss()
            flat[i] = keep
            assert abs((up - down) / (2 * h) - grad.reshape(-1)[i]) < 1e-4


# ------------------------------------------------------------------ quality

def slow_quality(net, data):
    q, p = quality_classifier, net.params
    cls, rows = q.classes(), []
    for a in range(0, max(len(data), 1), q.PASSAGE):
        part = list(data[a: a + q.PASSAGE])
        n, x = max(len(part), 1), [0.0] * q.FEATURES
        pairs = Counter(((b * 31 + c) * 40503 >> 4) % q.PAIRS for b, c in zip(part, part[1:], strict=False))
        for k, v in pairs.items():
            x[k] = math.sqrt(v / n)
        for k, v in Counter(int(cls[b]) for b in part).items():
            x[q.PAIRS + k] = v / n
        x[-1] = len({((b * 961 + c * 31 + d) * 40503 >> 4) % q.TRIPLES
                     for b, c, d in zip(part, part[1:], part[2:], strict=False)}) / n
        rows.append([(v - m) / s for v, m, s in zip(x, net.mean, net.std, strict=True)])
    encoded, weigh = [], []
    for x in rows:
        h = [math.tanh(p["encode_b"][k] + sum(v * p["encode"][i][k] for i, v in enumerate(x))) for k in range(q.HIDDEN)]
        e = 0.0
        for k in range(q.ATTENTION):
            t = math.tanh(sum(h[i] * p["tanh"][i][k] for i in range(q.HIDDEN)))
            g = 1 / (1 + math.exp(-sum(h[i] * p["gate"][i][k] for i in range(q.HIDDEN))))
            e += t * g * p["weigh"][k][0]
        encoded.append(h)
        weigh.append(math.exp(e))
    z = [sum(w * h[k] for w, h in zip(weigh, encoded, strict=True)) / sum(weigh) for k in range(q.HIDDEN)]
    return 1 / (1 + math.exp(-(p["score_b"][0] + sum(z[k] * p["score"][k][0] for k in range(q.HIDDEN)))))


def test_quality_network_like_its_naive_version():
    rng = np.random.default_rng(4)
    net = quality_classifier.Network.fresh(rng.random(quality_classifier.FEATURES) / 20,
                                           0.05 + rng.random(quality_classifier.FEATURES) / 10)
    x, doc = quality_classifier.passages(*tx.strings(pa.array(TEXTS)))
    got = net.forward(x, doc, len(TEXTS))["p"]
    assert np.allclose(got, [slow_quality(net, t.encode()) for t in TEXTS], atol=1e-5)


def test_sample_of_a_hot_class(spark, monkeypatch):
    """Of 20,000 rows of one class, few are ranked; repeats widen the threshold."""
    monkeypatch.setattr(nn, "_HELD_ROWS", 100)
    rows = [("hot", f"text {i % 9000}") for i in range(20_000)] + [("rare", f"r {i}") for i in range(5)] + [
        (None, "none"), ("same", "one"), *[("same", "one")] * 3000, *[("same", f"two {i}") for i in range(30)]]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(16)
    got = nn.bounded_sample(df, 60, F.col("lang")).distinct().collect()
    count = Counter(r.lang for r in got)
    assert len(got) <= 60 and count["rare"] == 5 and count[None] == 1
    assert count["hot"] + count["same"] == 54 and abs(count["hot"] - count["same"]) <= 1
    least = sorted(x[0] for x in df.where("lang = 'hot'").distinct().select(F.xxhash64("lang", "text", F.lit(0))).collect())
    assert sorted(r["__h"] for r in got if r.lang == "hot") == least[:count["hot"]]


# ------------------------------------------------------------------ ids

def test_ids_that_are_texts(spark):
    """Operators give a document with a text for an id what they give the same
    document with a number."""
    rows = [(i, t) for i, t in awkward() if i is None or i < 1000]
    plain = frame(spark, rows)
    named = plain.withColumn("doc_id", F.concat(F.lit("d/"), F.col("doc_id").cast("string")))

    def same(a, b, cols):
        x = [(r.doc_id if r.doc_id is None else f"d/{r.doc_id}", *[r[c] for c in cols]) for r in a.collect()]
        y = [(r.doc_id, *[r[c] for c in cols]) for r in b.collect()]
        assert sorted(x, key=str) == sorted(y, key=str)
    same(simhash.near_duplicates(plain), simhash.near_duplicates(named), ["fingerprint"])
    same(suffix_dedup.remove_repeats(plain), suffix_dedup.remove_repeats(named), ["n_removed", "kept_sha256"])
    # which copy is the first depends on the order of ids, but not how much goes
    total = [substring_dedup.remove_repeats(x).agg(F.sum("n_removed")).first()[0]
             for x in (plain.dropDuplicates(["doc_id"]), named.dropDuplicates(["doc_id"]))]
    assert all(t > 0 for t in total)
    assert simhash.deduplicate(named).count() == simhash.deduplicate(plain).count()
    assert substring_dedup.clean(named).columns == named.columns
    assert mixing.draw(named).count() > 0
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(named).collect()}
    assert all(c is None or c <= d for d, c in got.items() if d)


def test_rows_without_ids_spread_over_the_keys(spark):
    df = spark.createDataFrame([(None, f"text number {i}") for i in range(500)], "doc_id long, text string")
    assert df.select(mixing.key("doc_id", F.lit(1.0))).distinct().count() == 500


def test_quality_weights_of_a_column(spark):
    rows = [(i, "w " * 10, float(i % 2)) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score double").withColumn("source", F.lit("s"))
    taken = {r.doc_id: r.taken for r in mixing.mix(df, total=1.2, quality_column="score").collect()}
    extra = [i for i, t in taken.items() if t > 10]
    assert sum(taken.values()) == 400 * 12 and len(extra) == 80
    assert sum(i % 2 for i in extra) > 60  # a weight of 1 against one of 0.1


# ------------------------------------------------------------------ urls

def linked_pages(rng, n):
    """Pages of a few hosts, with canonical links and refreshes: chains, cycles, hubs, conflicts."""
    hosts = ["example.org", "news.example.org", "shop.com", "fr.shop.com", "other.net", "a.de"]
    paths = ["/en/1", "/en/2", "/es/x", "/fr/y", "/de/z", "/", "/p?q=1", "/deep/a/b"]
    urls = [f"https://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', str(rng.randrange(9))])}" for _ in range(n)]
    out = []
    for i, url in enumerate(urls):
        to = rng.choice(urls[i // 6 * 6: i // 6 * 6 + 6] if rng.random() < 0.97 else urls)  # groups of six, some tied
        head = rng.choice([f'<link rel="canonical" href="{to}">', f"<link href='{to}' rel=canonical>", "",
                           f'<meta http-equiv="refresh" content="0; url={to}">', '<link rel="stylesheet" href="/x.css">'])
        out.append((i, url, f"<html><head>{head}</head><body>text</body></html>"))
    chain = [f"https://quiet{k}.net/" for k in range(4)] + ["http://shop.com/de/only"]  # a block five pages away
    out += [(n + 10 + k, u, f'<link rel="canonical" href="{chain[min(k + 1, 4)]}">') for k, u in enumerate(chain)]
    return out + [(n, None, None), (n + 1, "no url", ""), (n + 2, urls[0], "<html></html>")]


@pytest.mark.parametrize("seed", [2, 5])
def test_url_sql_on_pages_with_links(spark, seed):
    import duckdb
    rows = linked_pages(random.Random(seed), 400)
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    con = duckdb.connect()
    con.register("pages_rows", pages.toPandas())
    con.execute("CREATE VIEW pages AS SELECT page_id::BIGINT AS page_id, url, html FROM pages_rows")
    got = url_filter.filter_urls(pages, url_filter.page_edges(pages)).select("page_id", "host", "path", "rule", "verdict")
    assert_same(got.toPandas(), con.execute(url_filter.ORACLE).df()[["page_id", "host", "path", "rule", "verdict"]])
    assert got.where("rule IS NULL AND verdict = 'block'").count() >= 4  # blocks that came over links
