"""The corpus pipeline against brute force, stage by stage."""

import random

import corpus_pipeline
import pytest
from data import WORD, awkward, components_of, fingerprint, frame, lower, repeats
from data import TERM

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tidemark.llm import stages

STAGES = dict(corpus_pipeline.STAGES)


def test_entry_has_all_queries():
    names = entry.queries()
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14))
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5


def test_language_stage_keeps_texts_with_a_language(spark):
    docs = frame(spark, awkward() + [(500, "plain words of the house " * 8)])
    kept = STAGES["language_id"](spark, docs, SF_SMALL)
    assert kept.columns == docs.columns
    want = sorted((i, t) for i, t in awkward() if i is not None and t and any(c.isalpha() for c in t))
    assert sorted((r.doc_id, r.text) for r in kept.collect() if r.doc_id not in (None, 500)) == want


@pytest.fixture(scope="module")
def steps(spark):
    """(stage, rows before, rows after) over the small tables."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out, before = [], docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, spark.createDataFrame(before, docs.schema), SF_SMALL)
        rows = after.collect()
        out.append((name, before, rows))
        assert name == "mixing" or after.columns == docs.columns
        before = rows
    return {n: (a, b) for n, a, b in out}


def test_near_duplicates(steps):
    before, after = steps["simhash_dedup"]
    label = components_of([fingerprint(r.text) for r in before])
    least = {}
    for r, c in zip(before, label, strict=True):
        least[c] = min(r.doc_id, least.get(c, r.doc_id))
    assert sorted(r.doc_id for r in after) == sorted(least.values())


def test_substrings(steps):
    before, after = steps["substring_dedup"]
    rows = [(r.doc_id, r.text) for r in before]
    gone = repeats(lambda t: WORD.findall(t or ""), rows, 20, every=False)
    got = {r.doc_id: r for r in after}
    assert len(got) == len(rows)
    for i, t in rows:
        w = WORD.findall(t)
        want = " ".join(x for p, x in enumerate(w) if p not in gone[i, t]) if gone[i, t] else t
        assert got[i].text == want and got[i].n_chars == len(want)


def test_benchmark(spark, steps):
    before, after = steps["decontamination"]
    grams = set()
    for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect():
        w = TERM.findall(lower(r.text))
        grams |= {tuple(w[j:j + min(10, len(w))]) for j in range(max(1, len(w) - 9))} - {()}
    sizes = {len(g) for g in grams}

    def hit(text):
        w = TERM.findall(lower(text))
        return any(tuple(w[j:j + n]) in grams for n in sizes for j in range(len(w) - n + 1))
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before if not hit(r.text))


def test_mix(steps):
    before, after = steps["mixing"]
    size = {r.doc_id: len(WORD.findall(r.text)) for r in before}
    total = sum(size.values())
    assert all(r.mix_copies in (1, 2) and r.mix_words == r.mix_copies * size[r.doc_id] for r in after)
    assert abs(sum(r.mix_words for r in after) - 1.5 * total) < 0.05 * total


def test_stages_take_awkward_and_empty_tables(spark):
    rows = awkward(25)
    random.Random(3).shuffle(rows)
    for _, stage in corpus_pipeline.STAGES:
        docs = frame(spark, rows)
        out = stage(spark, docs, SF_SMALL)
        assert set(docs.columns) <= set(out.columns)
        assert out.count() <= len(rows)
        assert stage(spark, frame(spark, []), SF_SMALL).count() == 0
    assert stages.STAGES == corpus_pipeline.STAGES
