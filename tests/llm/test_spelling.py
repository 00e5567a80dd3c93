"""Spelling variants against a loop that tries every edit."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from epiloom.llm import spelling as S

LAYOUT = "doc_id bigint, text string, word string, n int, length string"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(spark, rows):
    """Rows of (doc_id, text), with columns that clash with those of the operator."""
    return spark.createDataFrame([(i, t, "w", 1, "l") for i, t in rows], LAYOUT)


def counted(rows):
    words = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            words[run] += 1
    return {w: n for w, n in words.items() if len(w) >= 5 and n >= 3}


def by_loop(rows, words=None):
    words = counted(rows) if words is None else words
    holes = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            holes[w[:i] + "*" + w[i + 1 :]].add(w)
    near = defaultdict(set)
    for same in holes.values():
        for w in same:
            near[w] |= same - {w}
    for w in words:
        for i in range(len(w)):
            if (v := w[:i] + w[i + 1 :]) in words:
                near[w].add(v)
                near[v].add(w)
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def found(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


def some_rows(seed, n, letters="abé"):
    rng = random.Random(seed)
    stems = ["".join(rng.choice(letters) for _ in range(rng.randrange(4, 9))) for _ in range(60)]
    out = []
    for i in range(n):
        text = " ".join(w if rng.random() < 0.8 else w[: (k := rng.randrange(len(w)))] + rng.choice(letters + "zÀ×") + w[k + rng.randrange(2) :] for w in rng.choices(stems, weights=range(1, 61), k=80))
        out.append((i, text.title() if rng.random() < 0.3 else text))
    return out


@pytest.mark.parametrize(("cell", "sample"), [(10**6, 1000), (50, 10**6), (7, 40), (20, 25)])
def test_against_a_loop(spark, cell, sample):
    rows = some_rows(cell, 150) + [(3, "Straße STRASSE"), (None, "Façade façade facade " * 4), (5, None), (6, ""), (7, "12 -- 3_4")]
    rows += [(8, "twice twice twice twicee twicee twicee")] * 2
    assert found(S.spelling_forms(documents(spark, rows).repartition(4), cell=cell, sample=sample)) == by_loop(rows)


def test_long_chains_and_ties(spark):
    counts = {"aaaaa": 3, "aaaab": 6, "aaabb": 12, "aabbb": 24, "abbbb": 48, "bbbbb": 96, "bbbbbb": 192, "bbbbbbb": 384, "bbbbbbc": 384, "zzzzz": 3, "zzzzy": 6, "zzzzx": 6}
    text = " ".join(w for w, n in counts.items() for _ in range(n))
    rows = [(next(i for i in range(10**6) if all(zlib.crc32(f"{i}:{w}".encode()) % 97 for w in counts)), text)]
    assert counted(rows) == counts
    assert found(S.spelling_forms(documents(spark, rows))) == by_loop(rows)


def test_equal_letters_are_dealt_out(spark):
    """Anagrams can't be cut by letter counts: a cell of them becomes a grid."""
    rng = random.Random(4)
    base = list("aaaabbbbcc")
    words = {"".join(rng.sample(base, len(base))): rng.randrange(3, 9) for _ in range(500)}
    words |= {w[:-1]: 5 for w in list(words)[:100]}
    words |= {w[:3] + "z" + w[4:]: 20 for w in list(words)[:100]}
    frame = spark.createDataFrame([(w, n, len(w)) for w, n in words.items()], "word string, n bigint, length bigint")
    trees = S.upper_trees(frame, 20)
    assert any(c.grid > 1 for t in trees.values() for c in leaves(t))
    got = {r["word"]: (r["n_near"], r["near"], r["near_n"]) for r in S.near_words(frame, 20).collect()}
    want = {}
    for w, n in words.items():
        near = [v for v in words if near_by_letters(w, v)]
        if near:
            best = min(near, key=lambda v: (-words[v], v))
            want[w] = (len(near), best, words[best])
    assert got == want


def leaves(tree):
    return [tree] if isinstance(tree, S.Cell) else leaves(tree.left) + leaves(tree.right)


def near_by_letters(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def test_one_inserted():
    a = S._codes(["abcd", "abcd", "abcd", "abcd", "aaaa", "abcd"], 4)
    b = S._codes(["xabcd", "abxcd", "abcdx", "abdcx", "aaaaa", "axbxd"], 5)
    assert S._one_inserted(a, b).tolist() == [True, True, True, False, True, False]


def test_very_long_words(spark):
    long = "ab" * 200_000
    words = {long: 9, long + "c": 3, long[:-1] + "c": 4, "x" * 1_000_000: 3}
    text = " ".join(w for w, n in words.items() for _ in range(n))
    rows = [(next(i for i in range(10**6) if all(zlib.crc32(f"{i}:{w}".encode()) % 97 for w in words)), text)]
    got = found(S.spelling_forms(documents(spark, rows)))
    want = [(long, None, long, 9, 2, None), (long + "c", long, long, 3, 2, 9), (long[:-1] + "c", long, long, 4, 2, 9), ("x" * 1_000_000,) * 1 + (None, "x" * 1_000_000, 3, 0, None)]
    assert got == sorted(want, key=repr)


def test_empty_table(spark):
    assert S.spelling_forms(documents(spark, [])).collect() == []


def test_clipped_counts_only_come_nearer():
    codes = S._codes(["a" * 150 + "b" * 150, "a" * 151 + "b" * 149], 300)
    assert np.abs(np.diff(S._counts(codes, np.array([97, 98], np.uint8)).astype(int), axis=0)).sum() <= 2
