"""Mixing: targets, permutations and whole mixes against loops."""

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from epiloom.llm import mixing as M

LAYOUT = "doc_id bigint, text string, source string, size string, target int, rank int"


def documents(spark, rows):
    """Rows of (doc_id, text, source), with columns that clash with those of the operator."""
    return spark.createDataFrame([(i, t, s, "x", 7, 3) for i, t, s in rows], LAYOUT)


def poured(sizes, weights, percent, most):
    """Targets by pouring again what overflows, one round at a time."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = dict.fromkeys(names, 0.0), set(names), sum(sizes.values()) * percent / 100
    while left > 1e-9 and open_:
        whole = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / whole for s in open_}
        left = 0.0
        for s, x in share.items():
            target[s] += x
            if target[s] >= most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = float(most * sizes[s])
                open_.discard(s)
    return target


def number(text, digits=15):
    return int(hashlib.md5(text.encode()).hexdigest()[:digits], 16)


def walk(x, n, base):
    for r in range(1, M.ROUNDS + 1):
        key = (base * (2 * r + 1) * 1_000_003 + r * 7919) % M.PRIME
        other = (key - x) % n
        pair = (max(x, other) + key) % M.PRIME
        x = other if pair * pair % M.PRIME % 2 else x
    return x


def by_loop(rows, weights, percent, most, block):
    """Counter of (doc_id, source, size, taken) by pouring words one by one."""
    named = [(i, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), hashlib.md5((t or "").encode()).hexdigest()) for i, t, s in rows]
    sizes = Counter()
    for _, s, n, _ in named:
        sizes[s] += n
    target = poured(dict(sizes), weights, percent, most)
    out = Counter()
    for rank, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or ""))):
        mine = sorted((r for r in named if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, r[3]))
        words = [at for at, r in enumerate(mine) for _ in range(r[2])]
        cut = [words[i : i + block] for i in range(0, len(words), block)]
        slots = min(most * len(cut), int(target[s] * len(cut) / sizes[s] + 0.5)) if words else 0
        taken = Counter()
        for k in range(slots):
            round_ = k // len(cut)
            taken.update(cut[walk(k % len(cut), len(cut), number(f"mix-order:{rank}:{round_}", 7))])
        out.update((r[0], s, r[2], taken[at]) for at, r in enumerate(mine))
    return out


@pytest.mark.parametrize("n", [1, 2, 3, 17, 100, 1024])
def test_permutation(spark, n):
    found = M.permuted(spark.range(n).select("id", F.col("id").alias("to"), F.lit(n).alias("n"), F.lit(123456789).cast("bigint").alias("base")), "to", "n", "base")
    to = {r["id"]: r["to"] for r in found.collect()}
    assert to == {i: walk(i, n, 123456789) for i in range(n)}
    assert sorted(to.values()) == list(range(n))
    if n >= 100:
        assert sum(abs(to[i + 1] - to[i]) == 1 for i in range(n - 1)) < n / 4


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 5, None: 3}, {"a": 0, "b": 0}, {"x": 7}, {f"s{i:02}": 2**i for i in range(20)}])
def test_targets(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    found = {r["source"]: r["target"] for r in M.targets(frame, (3, 1, 2), 150, 2).collect()}
    assert found == pytest.approx(poured(sizes, (3, 1, 2), 150, 2))


def test_against_a_loop(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(i * 7 % 40)), f"s{i % 4}" if i % 9 else None) for i in range(120)]
    rows += [(5, "the same id", "s1"), (5, "other text", "s1"), (None, "no id", "s2"), (7, None, "s3"), (8, " \t\n", "s3"), (9, "a", "one")]
    rows += [(11, "twice as it is", "s0")] * 2 + [(12, "word " * 30_000, "long")]
    found = M.mix(documents(spark, rows), block=8, shard_blocks=16)
    assert Counter((r["doc_id"], r["source"], r["size"], r["taken"]) for r in found.collect()) == by_loop(rows, (3, 1, 2), 150, 2, 8)
    # The stream of a source need not be cut by buckets.
    assert all(r["taken"] <= 2 * r["size"] for r in found.collect())


def test_reruns_agree_whatever_the_partitions(spark):
    rows = [(i, f"a b c {i} " * (i % 13), f"s{i % 3}") for i in range(90)]
    one, two = (M.mix(documents(spark, rows).repartition(n), block=4) for n in (1, 7))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))


def test_buckets_are_one_stream(spark, monkeypatch):
    monkeypatch.setattr(M, "BUCKET_ROWS", 7)
    rows = [(i, "w " * (i % 11), "s" if i % 3 else None) for i in range(100)]
    _, placed = M.streams(documents(spark, rows), (1,), 150, 2, 8)
    for source in ("s", None):
        spans = sorted((r["start"], r["size"]) for r in placed.collect() if r["source"] == source and r["size"])
        assert [s for s, _ in spans] == [sum(n for _, n in spans[:i]) for i in range(len(spans))]


def test_blocks_hold_the_words(spark):
    rows = [(i, f"d{i}_0 d{i}_1\td{i}_2", f"s{i % 2}") for i in range(40)]
    docs = documents(spark, rows)
    blocks = M.mixed_blocks(docs, block=8, shard_blocks=4).collect()
    taken = {r["doc_id"]: r["taken"] for r in M.mix(docs, block=8, shard_blocks=4).collect()}
    words = Counter(int(w[1:].split("_")[0]) for b in blocks for w in b["text"].split(" "))
    assert {i: words[i] for i in taken} == taken
    assert all(len(b["text"].split(" ")) <= 8 and len({b["shard"], b["place"]}) == 2 for b in blocks)


def test_draws_follow_the_targets(spark):
    sources = spark.createDataFrame([(0, 4000, 8000), (1, 1000, 1000), (2, 10, 1000)], "rank bigint, blocks bigint, slots bigint")
    counts = M.shard_counts(sources, 100).collect()
    assert sum(r["count"] for r in counts) == 10_000 and len({r["shard"] for r in counts}) == 100
    # Chi-squared of 100 shards at 99 degrees of freedom, beyond 200 about once in 10^8 draws.
    assert sum((r["count"] - 80) ** 2 / 80 for r in counts if r["rank"] == 0) < 200


def test_empty_and_wordless(spark):
    assert M.mix(documents(spark, [])).collect() == []
    found = M.mix(documents(spark, [(1, None, None), (2, "", "a")])).collect()
    assert sorted((r["doc_id"], r["taken"], r["target"], r["source_size"]) for r in found) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]


def test_no_python_in_the_plan(spark):
    plan = M.mix(documents(spark, [(1, "a b", "s")]))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))
