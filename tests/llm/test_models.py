"""Quality and toxicity models on made-up labels, and without usable ones."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from epiloom.llm import quality, toxicity
from epiloom.llm.labelled import fold, sample


def texts(n, seed=1):
    rng = random.Random(seed)
    plain = ["river", "stone", "you", "house", "and", "walks", "über", "früh", "tree", "by"]
    bad = ["idiot", "vequno", "vequla", "1d10t"]
    rows = []
    for i in range(n):
        w = [rng.choice(plain) for _ in range(rng.randrange(20, 60))]
        toxic, good = i % 4 == 0, i % 5 != 0
        if toxic:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(bad[:3]))
        rows.append((i, " ".join(w) + "." if good else " ".join(x.upper() + "!!" for x in w), int(good), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def tables(spark):
    rows = texts(600)
    docs = spark.createDataFrame([(i, t, "x") for i, t, _, _ in rows] + [(None, None, "x"), (9999, "", "y")], "doc_id bigint, text string, features string").cache()
    labels = spark.createDataFrame([(i, q, x) for i, _, q, x in rows], "doc_id bigint, quality int, toxic int").cache()
    return docs, labels


def accuracy(scored, labels, label, score, limit, folds, held):
    m = scored.join(labels, "doc_id").where(fold(F.col("doc_id"), folds) == held).select(label, score).collect()
    return sum((r[1] >= limit) == (r[0] == 1) for r in m) / len(m)


def test_toxicity(tables):
    docs, labels = tables
    model = toxicity.fit(docs, labels, fold(F.col("doc_id"), 3) != 1)
    scored = model.score(docs)
    assert scored.columns == [*docs.columns, "toxicity_score"] and scored.count() == docs.count()
    assert accuracy(scored, labels, "toxic", "toxicity_score", 0.7, 3, 1) > 0.95
    assert scored.where("toxicity_score IS NULL OR toxicity_score < 0 OR toxicity_score > 1").count() == 0
    assert set(toxicity.stems_of("vequno")) & model.lexicon.keys() or "vequno" in model.lexicon


def test_toxicity_features():
    f = dict(zip(toxicity.NAMES, toxicity.features("You are an 1D10T, i.d.i.o.t!!", {"idiot": 5.0}), strict=True))
    assert f["obfuscated_lexicon"] == 2.0 and f["nearest"] > 0 and f["near_share"] > 0
    assert all(np.isfinite(toxicity.features(t, {"idiot": 5.0})).all() for t in ("", " ", "\n", "a" * 10**6, "idiot"))
    for text in ("idiot " * 50 + "you", "you " * 9 + "x " * 20 + "idiot you"):
        words = text.split()
        hits, people = ([i for i, w in enumerate(words) if w == x] for x in ("idiot", "you"))
        want = [min(abs(i - j) for j in people) for i in hits]
        f = dict(zip(toxicity.NAMES, toxicity.features(text, {"idiot": 5.0}), strict=True))
        assert f["nearest"] == 1 / (1 + min(want)) and f["near_share"] == sum(d <= 5 for d in want) / len(hits)


def test_quality(tables):
    docs, labels = tables
    machine = quality.fit(docs, labels, fold(F.col("doc_id"), 5) != 0)
    scored = quality.score(docs, machine)
    assert scored.count() == docs.count() and scored.where("score IS NULL OR isnan(score)").count() == 0
    assert accuracy(scored, labels, "quality", "score", 0.3, 5, 0) > 0.95


def test_sum_of_squares_identity():
    rng = np.random.Generator(np.random.PCG64(1))
    linear, factors = rng.normal(size=quality.SIZE), rng.normal(size=(quality.SIZE, 3)) / 9
    machine = quality.Machine(0.5, 0.1, linear, factors)
    vectors = [quality.vector_of(t) for t in ("", "a b c", "Some LOUD text!! text | 123")]
    for (places, values), got in zip(vectors, machine.scores(vectors), strict=True):
        raw = 0.1 + sum(linear[p] * v for p, v in zip(places, values, strict=True))
        for i in range(len(places)):
            for j in range(i):
                raw += factors[places[i]] @ factors[places[j]] * values[i] * values[j]
        assert got == pytest.approx(1 / (1 + np.exp(-raw)), abs=1e-9)
    assert all(0 <= v <= 1 for t in ("", " ", "!" * 10**5, "x\n" * 10**4) for v in quality.statistics(t))


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)], [(1, 1, 0), (2, 1, 0), (3, None, None), (None, 0, 1)]])
def test_without_two_kinds_of_labels(spark, labels):
    docs = spark.createDataFrame([(1, "a"), (2, None), (2, "b")], "doc_id bigint, text string")
    frame = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    share = 1.0 if labels else 0.0
    assert {r.score for r in quality.score(docs, quality.fit(docs, frame, F.lit(True))).collect()} == {share}
    assert {r.toxicity_score for r in toxicity.fit(docs, frame, F.lit(True)).score(docs).collect()} == {0.0}


def test_sample_is_bounded(tables):
    docs, labels = tables
    found = sample(docs, labels.union(labels), "toxic", F.lit(True), rows=100)
    assert 50 < found.count() < 150 and found.select("text").distinct().count() == found.count()
