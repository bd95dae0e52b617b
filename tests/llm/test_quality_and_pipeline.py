import re
from collections import Counter

import numpy as np
import pytest
from helpers import LOWER, SMALL, documents, nothing, sample_texts
from test_dedup import brute_force_groups
from test_text import brute_force_hits, brute_force_targets

import corpus_pipeline
from millrace.llm import quality
from millrace.llm.common import fold, stage
from millrace.llm.queries import QUERIES

MEDIUM = "/root/testdata/sf0.01"


def test_fold_lowers_ascii_only(spark):
    texts = ["ABC xyz", "ÉLAN Élan", "ΣΑΣ", "İ K ǅ Ⅷ Ⓐ", "", "ß ẞ"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(fold(df.t)).collect()] == [t.translate(LOWER) for t in texts]


def test_measures_and_votes():
    assert quality.style_votes(quality.style("")) == [quality.NONE] * 6
    assert quality.YES not in quality.style_votes(quality.style("This."))
    assert quality.style("Und Und Und Und")[2] == 0.75
    assert quality.style("a | b || c d.")[3] == 2 / 6
    assert quality.style("x" * 30 + " ONE$$$ two### three")[4] == 1.0
    assert quality.style_votes(quality.style("SHOUTING ALL OF THE TIME AND ALWAYS"))[1] == quality.YES


def test_expectation_maximisation_finds_accuracies():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.2
    rates = [(0.7, 0.02), (0.6, 0.01), (0.5, 0.05)]  # votes for the fault, given it and not
    votes = np.column_stack([rng.random(len(truth)) < np.where(truth, a, b) for a, b in rates]).astype(int)
    patterns, at, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    p = quality.posteriors(patterns, counts.astype(float))[at.reshape(-1)]
    exact = np.ones(len(truth)) * 0.25
    for j, (a, b) in enumerate(rates):
        exact *= np.where(votes[:, j] == 1, a / b, (1 - a) / (1 - b))
    assert np.abs(p - exact / (1 + exact)).mean() < 0.03


def test_scorer_learns_words_and_forgets_noise():
    rng = np.random.default_rng(0)
    rows, target = [], []
    for i in range(600):
        bad = i % 3 == 0
        words = [f"n{x}" for x in rng.integers(0, 3000, 40)] + (["awful", "rotten"] if bad else [])
        rows.append(quality.features(" ".join(words), 16))
        target.append(0.95 if bad else 0.05)
    index, value = (np.concatenate([r[k] for r in rows]) for k in (0, 1))
    row = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    weights = quality.train(index, value, row, np.array(target), 16)
    scorer = quality.Scorer([weights, weights], 16)
    assert scorer("some awful and rotten text")[0] > 0.5 > scorer("some other text that is fine")[0]
    assert (weights[0] == 0).mean() > 0.9
    small = quality.Scorer([weights, weights], 16, remembered=1)
    assert small("some awful and rotten text") == small("some awful and rotten text") == scorer("some awful and rotten text")


def test_held_out_accuracy(spark):
    """Lists are learned on half of the labels; the other half says how well the scores do."""
    docs, labels = (spark.read.parquet(f"{MEDIUM}/{n}.parquet") for n in ("documents", "labels"))
    found = quality.classify(docs, labels.where("doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    junk = np.mean([(r.junk_score >= 0.5) == (r.quality == 0) for r in found])
    clean = [r for r in found if r.quality == 1 and r.toxic == 0]
    english = {r.doc_id for r in docs.where("lang = 'en'").collect()}
    toxic = [r.toxic_score >= 0.5 for r in found if r.toxic == 1 and r.quality == 1 and r.doc_id in english]
    assert junk > 0.97 and np.mean([r.rejected for r in clean]) < 0.03 and np.mean(toxic) > 0.9
    # at the score from which documents are rejected
    shipped = [r.junk_score >= quality.THRESHOLD for r in found if r.quality == 0]
    insults = [r.toxic_score >= quality.THRESHOLD for r in found if r.toxic == 1 and r.quality == 1 and r.doc_id in english]
    assert np.mean(shipped) > 0.97 and np.mean(insults) > 0.9


def test_quality_of_odd_rows(spark):
    docs = documents(spark)
    found = quality.classify(docs).collect()
    assert Counter(r.doc_id for r in found) == Counter(i for i, _ in sample_texts())
    assert all(0 <= r.junk_score <= 1 and 0 <= r.toxic_score <= 1 for r in found)
    out = quality.drop_rejected(docs)
    assert out.columns == docs.columns
    assert quality.classify(nothing(spark)).collect() == [] and quality.drop_rejected(nothing(spark)).collect() == []


def test_reruns_agree(spark):
    one, two = (sorted(map(tuple, QUERIES["op7_quality"](spark, SMALL).collect())) for _ in range(2))
    assert one == two


# The pipeline, each stage against brute force on its own input


def test_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "exact_dedup", "simhash_near_dedup", "benchmark_decontamination", "source_mixing"]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    for name, apply in corpus_pipeline.STAGES:
        given = [(r.doc_id, r.text) for r in docs.collect()]
        columns, sources = docs.columns, {r.doc_id: r.source for r in docs.collect()}
        docs = stage(apply(spark, docs, SMALL), name)
        kept = [r.doc_id for r in docs.collect()]
        if name == "quality_classifier":
            gone = {i for i, _ in given} - set(kept)
            assert all(labels[i].quality == 0 or labels[i].toxic for i in gone if i in labels)
            assert not any(labels[i].quality == 0 for i in kept if i in labels)
        elif name == "exact_dedup":
            last = {(t or "").translate(LOWER): i for i, t in sorted(given)}
            assert sorted(kept) == sorted(last.values())
        elif name == "simhash_near_dedup":
            assert sorted(kept, key=repr) == brute_force_groups(given, only_least=True)
        elif name == "benchmark_decontamination":
            assert sorted(kept) == sorted(r[1] for r in brute_force_hits(given, items) if not r[0])
        else:
            sizes = Counter()
            n = {i: len([w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w]) for i, t in given}
            for i in n:
                sizes[sources[i]] += n[i]
            taken = Counter()
            for i in kept:
                taken[sources[i]] += n[i]
            expected = brute_force_targets(dict(sizes))
            assert all(abs(taken[s] - expected[s]) <= max(n.values()) for s in sizes) and max(Counter(kept).values()) <= 2
            assert docs.columns == [*columns, "copy"]
            continue
        assert docs.columns == columns
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_on_odd_rows(spark):
    docs = documents(spark)
    for name, apply in corpus_pipeline.STAGES:
        docs = stage(apply(spark, docs, SMALL), name)
    assert docs.count() > 10


@pytest.mark.parametrize("stage_", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_stages_on_nothing(spark, stage_):
    assert stage_[1](spark, nothing(spark), SMALL).collect() == []
