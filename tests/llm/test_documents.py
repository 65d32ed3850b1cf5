"""Rules, mixing, decontamination, language ID and the classifier."""

import random
from collections import Counter

import numpy as np
import pytest
from data import TERM, WORD, awkward, frame, lower, sha

from tidemark.llm import decontaminate, language_id, mixing, nn, quality_classifier, quality_rules
from tidemark.llm.queries import ORACLE, QUERIES
from tests.conftest import SF_SMALL
from tests.helpers import assert_same, duck


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    assert_same(QUERIES[name](spark, SF_SMALL).toPandas(), duck(SF_SMALL).execute(ORACLE[name]).df())


def judged(text):
    w = WORD.findall(text or "")
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    often = Counter(grams)
    covered = {p for i, g in enumerate(grams) if often[g] > 1 for p in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
            len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w))


def test_quality_rules(spark):
    rows = awkward() + [(300, "a\nb\na\n\n \nb\na"), (301, "x y z x y z x"), (302, "the cat sat on a mat. " * 2 + " ".join(
        f"word{i} of the house{i}" for i in range(30)))]
    got = quality_rules.judge(frame(spark, rows)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    assert sorted(map(tuple, got), key=str) == sorted(((i, *judged(t)) for i, t in rows), key=str)
    kept = {r.doc_id: r.kept for r in quality_rules.judge(frame(spark, rows)).collect()}
    assert kept[302] and not kept[100] and not kept[101]
    assert quality_rules.judge(frame(spark, [])).count() == 0
    plan = quality_rules.judge(frame(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_quality_rules_on_long_texts(spark):
    rng = random.Random(6)
    texts = [" ".join(f"w{rng.randrange(900)}" for _ in range(60_000)), "same words here\n" * 30_000, "x" * 1_000_000]
    got = quality_rules.judge(frame(spark, list(enumerate(texts)))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    assert sorted(map(tuple, got)) == [(i, *judged(t)) for i, t in enumerate(texts)]


def hits(rows, items, window=10):
    grams = {}
    for i, t in items:
        w = TERM.findall(lower(t))
        n = min(window, len(w))
        for j in range(len(w) - n + 1 if n else 0):
            grams.setdefault(tuple(w[j:j + n]), set()).add("" if i is None else str(i))
    out = []
    for i, t in rows:
        w, cover, found = TERM.findall(lower(t)), set(), set()
        for n in {len(g) for g in grams}:
            for j in range(len(w) - n + 1):
                if tuple(w[j:j + n]) in grams:
                    cover.update(range(j, j + n))
                    found |= grams[tuple(w[j:j + n])]
        out.append((i, len(w), len(cover), len(found), sha(",".join(sorted(found)).encode()), bool(cover)))
    return sorted(out, key=str)


def test_the_index_is_looked_up_by_many_blocks(spark):
    """A thousand phrases in blocks of three, slices of few documents, and long texts
    across which positions must not leak."""
    rng = random.Random(12)
    vocab = [f"t{i}" for i in range(40)]
    rows = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([0, 3, 12, 200])))) for i in range(60)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([1, 2, 3, 11])))) for i in range(120)]
    items += [(200 + i, " ".join(rows[i][1].split()[4:18])) for i in range(60)]
    docs, bench = frame(spark, rows).repartition(7), spark.createDataFrame(items, "item_id long, text string")
    assert decontaminate.phrases(bench).count() > 200
    got = decontaminate.decontaminate(docs, bench, block_windows=3)
    assert sorted(map(tuple, got.collect()), key=str) == hits(rows, items)


@pytest.mark.parametrize("block", [50_000, 7])
def test_decontamination(spark, block):
    rows = awkward()
    long = next(t for i, t in rows if i == 103)
    items = [(1, " ".join(long.split()[50:64])), (2, "The OF alpha"), (3, None), (4, "--"), (None, "beta x1"),
             (10, "not there at all anywhere"), (2, "The OF alpha"), (11, "the " * 12), (12, "é 日本")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.decontaminate(frame(spark, rows), bench, block_windows=block)
    assert sorted(map(tuple, got.collect()), key=str) == hits(rows, items)
    kept = decontaminate.clean(frame(spark, rows), bench, block_windows=block)
    assert sorted((r.doc_id, r.text) for r in kept.where("doc_id is not null").collect() if r.text is not None) == sorted(
        (i, t) for (i, t), h in zip(rows, [hits([r], items)[0] for r in rows], strict=True)
        if i is not None and t is not None and not h[-1])
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.decontaminate(frame(spark, rows), none).where("contaminated").count() == 0
    assert decontaminate.decontaminate(frame(spark, []), bench).count() == 0


def test_proximity(spark):
    bench = spark.createDataFrame([(1, "red green blue black")], "item_id long, text string")
    rows = [(1, "red green blue black"), (2, "red very green blue black"), (3, "red a b c d e f green blue black"),
            (4, "black red green blue")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.items, r.near_items) for r in decontaminate.matches(docs, bench, slop=1).collect()}
    assert got == {1: (["1"], ["1"]), 2: ([], ["1"]), 3: ([], []), 4: ([], [])}


@pytest.mark.parametrize("slop", [1, 3])
def test_proximity_in_many_documents(spark, slop):
    rng = random.Random(slop)
    vocab = ["red", "green", "blue", "black", "white", "pink"]
    items = [(1, "red green blue black"), (2, "white red white"), (3, "pink"), (4, "green green black pink red blue")]
    rows = [(0, "clean words"), (1, "green red blue black"), (2, "clean words"), (3, "red green black blue")]
    rows += [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([0, 1, 3, 4, 6, 9])))) for i in range(4, 300)]

    def near(text):
        w, out = text.split(), []
        for i, item in items:
            t = item.split()
            off = [[min((abs(k - s - j) for k, x in enumerate(w) if x == y), default=99) for j, y in enumerate(t)]
                   for s in range(-len(t), len(w) + 1)]
            out += [str(i)] if any(min(x) == 0 and max(x) <= slop for x in off) else []
        return out

    want = {i: near(t) for i, t in rows}
    assert want[1][0] == "1" and want[0] == want[2] == []
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for parts in (1, 40):  # what shares a slice doesn't matter
        got = decontaminate.matches(docs.repartition(parts), bench, slop=slop).collect()
        assert {r.doc_id: sorted(r.near_items) for r in got} == want and len(got) == len(rows)
        assert all({*r["items"]} <= {*r.near_items} for r in got)


def shares(size, weights=(3, 1, 2)):
    """Targets by handing out the excess again and again."""
    names = sorted(size, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = {}, set(names), 1.5 * sum(size.values())
    while free:
        level = left / sum(w[s] for s in free)
        capped = {s for s in free if w[s] * level > 2 * size[s]}
        if not capped:
            return target | {s: w[s] * level for s in free}
        for s in capped:
            target[s] = 2.0 * size[s]
            left -= target[s]
        free -= capped
    return target


@pytest.mark.parametrize("bucket", [1024, 2])
def test_mixing(spark, bucket):
    rows = awkward(150)
    docs = frame(spark, rows)
    got = mixing.mix(docs, bucket_rows=bucket).collect()
    assert len(got) == len(rows)
    size, taken, most = Counter(), Counter(), Counter()
    for r in got:
        size[r.source] += r.size
        taken[r.source] += r.taken
        most[r.source] = max(most[r.source], r.size)
        assert r.taken in (0, r.size, 2 * r.size)
    for s, t in shares(size).items():
        assert all(abs(r.target - t) < 1e-6 and r.source_size == size[s] for r in got if r.source == s)
        assert abs(taken[s] - t) <= most[s] / 2 + 1e-6
    again = mixing.mix(docs.repartition(7), bucket_rows=64).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, got), key=str)
    drawn = mixing.draw(docs, bucket_rows=bucket)
    assert sum(r.mix_words for r in drawn.collect()) == sum(taken.values())
    assert mixing.mix(frame(spark, [])).count() == 0


def test_language(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    net = language_id.train(docs.where(language_id.learnable()), documents=120, steps=60)
    got = language_id.identify(docs, net).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert len(got) > 40 and (got.lang == got.lang_pred).mean() > 0.95
    rows = awkward()
    odd = {r.doc_id: r for r in language_id.identify(frame(spark, rows), net).collect()}
    assert {odd[i].lang_pred for i in (100, 101, 102, 107, None) if i is not None} == {"und"}
    assert odd[100].score == 0 and odd[103].lang_pred in net.languages
    assert language_id.accept(frame(spark, rows), net).columns == frame(spark, rows).columns
    assert language_id.train(docs.where("false")) is None
    assert {r.lang_pred for r in language_id.identify(docs, None).collect()} == {"und"}
    assert language_id.identify(frame(spark, []), net).count() == 0


def test_rare_classes_are_learned(spark):
    rows = [(i, f"plain words number {i} of a text", "en", int(i != 17)) for i in range(600)]
    rows[17] = (17, "q" * 900_000, "xx", 0)
    docs = spark.createDataFrame(rows + rows[:40], "doc_id long, text string, lang string, quality int")
    net = language_id.train(docs, documents=24, steps=2)
    assert net.languages == ["en", "xx"]
    assert not isinstance(quality_classifier.train(docs, 24, 2), float)
    got = nn.excerpts(nn.bounded_sample(docs.select("doc_id", "text", "lang"), 24, docs.lang), 100, 3)
    assert len(got) == len({r.doc_id for r in got}) == 24 and max(len(r.text) for r in got) == 300
    assert got == nn.excerpts(nn.bounded_sample(docs.repartition(7).select("doc_id", "text", "lang"), 24, docs.lang), 100, 3)


def test_without_a_language_network(spark):
    rows = [(1, "some words"), (2, None), (3, "12 - 3"), (4, ""), (5, "é")]
    assert sorted(r.doc_id for r in language_id.accept(frame(spark, rows), None).collect()) == [1, 5]


def test_network_gradients():
    net = quality_classifier.Network.fresh(np.zeros(quality_classifier.FEATURES), np.ones(quality_classifier.FEATURES))
    rng = np.random.default_rng(0)
    x, doc, y, w = rng.normal(size=(7, quality_classifier.FEATURES)), np.array([0, 0, 0, 1, 2, 2, 2]), \
        np.array([1.0, 0, 1]), np.array([1.0, 2, 0.5])

    def loss():
        p = net.forward(x, doc, 3)["p"]
        plain = -(w * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / w.sum()
        return plain + 0.5e-4 * sum((v ** 2).sum() for v in net.params.values())

    grads = net.gradients(net.forward(x, doc, 3), doc, y, w)
    for k, v in net.params.items():
        at = tuple(0 for _ in v.shape)
        v[at] += 1e-6
        up = loss()
        v[at] -= 2e-6
        down = loss()
        v[at] += 1e-6
        assert abs((up - down) / 2e-6 - grads[k][at]) < 1e-6, k


def test_classifier(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op4_quality_classifier"](spark, sf).toPandas()
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas().merge(got, on="doc_id")
    held = labels[labels.held_out]
    for q in (0, 1):
        assert (held[held.quality == q].predicted == q).mean() >= 0.9
    assert got.score.between(0, 1).all() and len(got) == 1000
    few = quality_classifier.train(spark.createDataFrame([], "doc_id long, text string, quality int"))
    odd = quality_classifier.score(frame(spark, awkward()), few).collect()
    assert len(odd) == len(awkward()) and {r.score for r in odd} == {0.5}
    net = quality_classifier.train(spark.read.parquet(f"{sf}/documents.parquet").join(
        spark.read.parquet(f"{sf}/labels.parquet"), "doc_id"), 60, 10)
    odd = quality_classifier.score(frame(spark, awkward()), net).collect()
    assert len(odd) == len(awkward()) and all(0 <= r.score <= 1 for r in odd)
    assert quality_classifier.score(frame(spark, []), net).count() == 0
