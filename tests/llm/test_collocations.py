"""Collocations against a loop that explodes every phrase."""

import random
import re
from collections import Counter

import pytest

from epiloom.llm import collocations as C

LAYOUT = "doc_id bigint, text string, lang string, n bigint, phrase string, rank int"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(spark, rows):
    """Rows of (text, lang), with columns that clash with those of the operator."""
    return spark.createDataFrame([(i, t, g, 5, "p", 1) for i, (t, g) in enumerate(rows)], LAYOUT)


def by_loop(rows, least, top, dominance=100):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(UPPER)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i : i + m]) for m in range(1, 6) for i in range(len(w) - m + 1))
    held = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    inner = Counter()
    for p, a in held.items():
        for m in range(2, len(p) - 1):
            for i in range(1, len(p) - m + 1):
                inner[(p[0], *p[i : i + m])] = max(inner[(p[0], *p[i : i + m])], a)
    out = {}
    for (lang, *w), a in held.items():
        if 100 * inner[(lang, *w)] >= dominance * a:
            continue
        cuts = []
        for k in range(1, len(w)):
            left, right = f[(lang, *w[:k])], f[(lang, *w[k:])]
            cuts.append((1000 * a * n[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    return sorted(
        (lang, i, p.decode(), -a, left, right, n[lang], -score)
        for lang, found in out.items()
        for i, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1)
    )


def found(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in df.collect())


def some_texts(seed, n):
    rng = random.Random(seed)
    words = ["The", "the", "of", "New", "York", "é", "Éa", "x y", "a-b", "퟿", "\U0001f600"] + [f"r{i}" for i in range(40)]
    marks = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", " ; ", "!?", "\x0b", "\x0c"]
    chain = ["once", "upon", "a", "time", "there", "was"]
    out = []
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randrange(60)))
        text += " ".join(chain[: rng.randrange(7)]) * rng.randrange(2)
        out.append((text, rng.choice(["en", "fr", None, "und"])))
    return out


@pytest.mark.parametrize(("least", "bits", "dominance"), [(5, 24, 100), (5, 16, 100), (3, 16, 60), (300, 17, 100)])
def test_against_a_loop(spark, least, bits, dominance):
    rows = some_texts(least + bits, 400) + [(None, "en"), ("", None), (" \t ", "fr"), (".", "xx"), ("alone", "yy")]
    df = documents(spark, rows).repartition(5)
    assert found(C.collocations(df, least, 50, dominance, bits)) == by_loop(rows, least, 50, dominance)


def test_steps_and_parts_cut_no_window(spark, monkeypatch):
    """Steps of a few words and parts of a few bytes, in this process."""
    import pyarrow as pa

    rows = some_texts(1, 50) + [("a b c d e " * 500, "en")]
    batch = pa.RecordBatch.from_pydict({"text": [t.encode() for t, _ in rows], "lang": [g or "und" for _, g in rows]})

    def windows():
        out = Counter()
        for s in C._steps(iter([batch])):
            for i in range(s.starts):
                if s.ids[i]:
                    w = []
                    while len(w) < C.LONGEST and i + len(w) < len(s.ids) and s.ids[i + len(w)]:
                        w.append(s.words[s.ids[i + len(w)]])
                    out[s.langs[s.lang[i]], *w] += 1
        return out

    whole = windows()
    monkeypatch.setattr(C, "STEP", 13)
    monkeypatch.setattr(C, "PART", 7)
    assert windows() == whole


def test_held_windows_are_given_out_early(spark, monkeypatch):
    monkeypatch.setattr(C, "STEP", 200)
    monkeypatch.setattr(C, "HELD", 20)
    rows = some_texts(7, 100)
    assert found(C.collocations(documents(spark, rows).coalesce(1), 3, 50, bits=16)) == by_loop(rows, 3, 50)


def test_often_met_windows_stay_held(spark, monkeypatch):
    """Two steps and more; what is given out early are the rare windows."""
    monkeypatch.setattr(C, "HELD", 1000)
    rows = [("the cat. " * 200_000 + ". ".join(f"r{i}x{j}" for j in range(150_000)), "en") for i in range(3)]
    texts = documents(spark, rows).coalesce(1).selectExpr("CAST(text AS binary) AS text", "lang")
    given = C._windows(texts, 1, 16)
    assert [tuple(r) for r in given.where("phrase IN ('the cat', 'cat')").orderBy("phrase").collect()] == [("en", "cat", 600_000), ("en", "the cat", 600_000)]
    assert given.selectExpr("sum(n)").first()[0] == 3 * 550_000


def test_rows_do_not_multiply_with_the_splits(spark, monkeypatch):
    given, windows = [], C._windows

    def kept(*args):
        given.append(windows(*args))
        return given[0]

    monkeypatch.setattr(C, "_windows", kept)
    cores = spark.sparkContext.defaultParallelism
    rows = [("once upon a time", "en")] * (8 * cores)
    df = documents(spark, rows).repartition(8 * cores)
    assert found(C.collocations(df, 3, 50, bits=16)) == by_loop(rows, 3, 50)
    assert given[0].count() <= 4 * cores


def test_tasks_stay_bounded(spark):
    cores = spark.sparkContext.defaultParallelism

    def tasks(splits):
        return C._in_few_tasks(spark.range(0, 10, 1, splits)).rdd.getNumPartitions()

    assert [tasks(1), tasks(cores), tasks(C.JOINED * cores)] == [1, cores, cores]
    assert tasks(C.JOINED * cores + 1) == cores + 1


def test_a_long_text_and_a_long_word(spark):
    rows = [("New York. " * 200_000, "en"), ("x" * 3_000_000 + " y", "en"), ("no spaces," * 100_000, "fr")]
    got = found(C.collocations(documents(spark, rows)))
    assert got == [
        ("en", 1, "new york", 200_000, 200_000, 200_000, 400_002, 1000 * 400_002 // 200_000),
        ("fr", 1, "no spaces", 100_000, 100_000, 100_000, 200_000, 2000),
    ]


def test_ties_by_bytes(spark):
    rows = [(f"{a} {b}.", "en") for a, b in (("é", "z"), ("z", "é"), ("\U0001f600", "a"), ("￮", "a")) for _ in range(3)]
    got = found(C.collocations(documents(spark, rows), least=3, top=3))
    assert got == by_loop(rows, 3, 3)


def test_products_beyond_64_bits(spark):
    phrases = spark.createDataFrame([(10**12,)], "a bigint")
    big = phrases.selectExpr("CAST(1000 AS DECIMAL(38, 0)) * CAST(a AS DECIMAL(19, 0)) * CAST(a AS DECIMAL(19, 0)) DIV (CAST(a AS DECIMAL(19, 0)) * CAST(7 AS DECIMAL(19, 0))) AS x")
    assert big.first()["x"] == 1000 * 10**12 // 7


def test_empty_table(spark):
    assert C.collocations(documents(spark, [])).collect() == []
