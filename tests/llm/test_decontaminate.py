"""Benchmark windows against a search for every window in every document."""

import random
import re

import pytest

from epiloom.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for item, t in items:
            v = words(t)
            size = min(10, len(v))
            windows = {tuple(v[i : i + size]) for i in range(len(v) - size + 1)} if v and item is not None else set()
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in windows:
                    hit.update(range(i, i + size))
                    found.add(item)
        out.append((doc_id, len(w), len(hit), tuple(sorted(found))))
    return sorted(out, key=repr)


def data(seed):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "a", "b", "É", "x1"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.randrange(25))) for i in range(12)] + [(12, ""), (13, None), (None, text(12)), (14, "Rare Word"), (15, "rare, word")]
    docs = [(i, text(rng.randrange(40)) + " " + rng.choice(items)[1].__str__() + "-" + text(5)) for i in range(30)]
    return docs + [(30, None), (31, ""), (32, "RARE\x00word"), (5, "the rare word"), (None, "rare word"), (33, text(3000))], items


@pytest.mark.parametrize("block", [10**6, 20])
def test_against_brute_force(spark, block):
    docs, items = data(block)
    d = spark.createDataFrame([(*r, "x") for r in docs], "doc_id bigint, text string, ranges string")
    b = spark.createDataFrame([(*r, "x") for r in items], "item_id bigint, text string, words string")
    found = D.find_windows(d, b, block_windows=block).collect()
    got = sorted(((r.doc_id, r.n_words, sum(x.end - x.begin for x in r.ranges), tuple(r["items"])) for r in found), key=repr)
    assert got == brute(docs, items)
    clean = D.without_windows(d, b, block_windows=block)
    assert clean.columns == d.columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted(i for i, _, hit, _ in brute(docs, items) if not hit)


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert [(r.n_words, r["items"]) for r in D.find_windows(d, none).collect()] == [(2, [])]
    assert D.find_windows(d.limit(0), none).count() == 0


def test_rarest_word_leads():
    index = D.index_of([(1, b"the rare of the")], {b"the": 9, b"of": 5, b"rare": 1})
    assert list(index) == [b"rare"] and list(index[b"rare"]) == [(1, 4)]


def test_a_window_of_very_many_items(spark):
    header = "answer the next question in one word and say why"  # ten words that all items share
    items = [(i, f"{header} item {i}") for i in range(300)]
    docs = [(1, f"x {header} y"), (2, f"{header} item 7 z"), (3, "say why"), (4, None), (1, f"x {header} y")]
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    found = D.find_windows(d, b, block_windows=100).collect()
    got = sorted(((r.doc_id, r.n_words, sum(x.end - x.begin for x in r.ranges), tuple(r["items"])) for r in found), key=repr)
    assert got == brute(docs, items)
    assert sorted(r.doc_id for r in D.without_windows(d, b, block_windows=100).collect()) == [3, 4]
    blocks = [sum(len(i) for places in x.value.values() for windows in places.values() for i in windows.values()) for x in D.indexes(d, b, 10, 100)]
    assert sum(blocks) == 900 and max(blocks) < 200
