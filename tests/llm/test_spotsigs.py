"""Spot signatures: neighbours and edits against a plain loop, and likeness against sets."""

import hashlib
import random

import numpy as np
import pytest

from epiloom.llm import spotsigs as S


def brute(docs):
    rows = [(i, t or "") for i, t in docs]
    out = []
    for k, (i, t) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        n = len(t) // 3
        e = t[: len(t) - n] + following[:n]
        sets = [set(S.signatures(x).tolist()) for x in (t, e, following)]
        near = [len(sets[0] & s) / len(sets[0] | s) for s in sets[1:]]
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), *near))
    return out


@pytest.mark.parametrize("partitions", ["1", "4", "11"])
def test_against_a_loop(spark, partitions):
    rng = random.Random(5)
    words = ["the", "of", "was", "house", "tree", "über", "river", "stone", "🙂"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(60)))) for i in rng.sample(range(10**12), 40)]
    docs += [(-5, None), (-6, ""), (-7, "x" * 10_000)]
    df = spark.createDataFrame([(*d, "clash") for d in docs], "doc_id bigint, text string, fingerprint string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        found = S.compare_with_edits(df.repartition(6)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    got = sorted((tuple(r[c] for c in ("doc_id", "n_chars", "edited_sha256", "near_edited", "near_next")) for r in found), reverse=True)
    assert got == brute(sorted(docs, reverse=True))


def test_repeats_nulls_and_single_rows(spark):
    df = spark.createDataFrame([(1, "a b")] * 5 + [(None, "c")] * 3 + [(None, None)], "doc_id bigint, text string")
    assert S.compare_with_edits(df).count() == 9
    assert S.compare_with_edits(df.where("doc_id IS NULL")).count() == 4
    (one,) = S.compare_with_edits(df.limit(1)).collect()
    assert one.near_next == 1.0
    assert S.compare_with_edits(df.limit(0)).count() == 0


def test_signatures():
    a = "The quick brown fox of the north was in a deep green wood by the old river bank"
    assert S.signatures(a).tolist() == S.signatures(a).tolist() and len(S.signatures("")) == 1
    assert S.fingerprint(S.signatures("")) != S.fingerprint(S.signatures("..."))
    assert 0 < S.jaccard(S.signatures(a), S.signatures(a + " where nothing else is seen")) < 1


def test_pruned_jaccard():
    rng = np.random.Generator(np.random.PCG64(1))
    for _ in range(300):
        a = np.unique(rng.integers(0, 700, rng.integers(1, 900)).astype("<u4"))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.9], rng.integers(0, 900, rng.integers(1, 200)).astype("<u4")]))
        j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        for least in (0.0, 0.3, 0.8, 0.95):
            assert S.jaccard(a, b, least) == (j if j >= least else 0.0)


def test_near_duplicates_against_all_pairs(spark):
    rng = random.Random(8)
    vocabulary = ["the", "of", "was", "in", *(f"w{i}" for i in range(200))]
    docs = []
    for n in (8, 30, 80, 200):
        base = [rng.choice(vocabulary) for _ in range(n)]
        for _ in range(15):
            w = list(base)
            for _ in range(rng.randrange(1 + n // 15)):
                w[rng.randrange(n)] = rng.choice(vocabulary)
            docs.append(" ".join(w))
    docs += ["", None, "...", "the the the", "the the the"]
    rows = list(enumerate(docs))
    sets = [S._chains(t or "") for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id bigint, text string, hashes string")
    got = sorted((r.doc_id, r.n_signatures, r.component_id, r.kept) for r in S.near_duplicates(df).collect())
    assert got == [(i, len(sets[i]), find(i), find(i) == i) for i in range(len(rows))]
    assert S.near_duplicates(df.limit(0)).count() == 0
