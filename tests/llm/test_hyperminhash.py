"""Near-duplicates against components of all pairs."""

import random

import pytest

from epiloom.llm import components as C
from epiloom.llm import hyperminhash as H
from epiloom.llm.components import components


def shingled(text, size):
    w = (text or "").encode().lower().split()
    return frozenset(zip(*(w[i:] for i in range(size)), strict=False)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def brute(docs, size, percent):
    sets = [shingled(t, size) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            if x and sets[j] and 100 * len(x & sets[j]) >= percent * len(x | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        least[find(i)] = min(d, least.get(find(i), d))
    return sorted((d, len(sets[i]), least[find(i)], d == least[find(i)]) for i, (d, _) in enumerate(docs))


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    docs = []
    for n in (3, 6, 9, 12, 20, 40, 40, 150, 700):
        base = [rng.choice(vocabulary) for _ in range(n)]
        for _ in range(14):
            w = list(base)
            for _ in range(rng.randrange(1 + n // 12)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            docs.append(" ".join(w) if rng.random() < 0.5 else "\t" + " \n".join(w).upper())
    chain = [rng.choice(vocabulary) for _ in range(60)]
    for _ in range(40):  # each alike to the one before, the ends not alike
        chain[rng.randrange(60)] = rng.choice(vocabulary)
        docs.append(" ".join(chain))
    passage = " ".join(rng.choice(vocabulary) for _ in range(15))
    docs += [passage + " " + " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(5, 30))) for _ in range(60)]
    docs += ["a b", "A  b", "a", "", None, "  ", " ", "b a"]
    ids = rng.sample(range(10_000), len(docs))
    return list(zip(ids, docs, strict=True))


@pytest.mark.parametrize(("seed", "size", "percent"), [(1, 3, 85), (2, 5, 80)])
def test_against_all_pairs(spark, seed, size, percent):
    docs = corpus(seed)
    df = spark.createDataFrame([(*d, "clash") for d in docs], "doc_id bigint, text string, n string")
    got = sorted(tuple(r) for r in H.near_duplicates(df.repartition(3), size, percent).collect())
    assert got == brute(docs, size, percent)


@pytest.mark.parametrize("direct", [0, 3])
def test_wide_buckets_against_all_pairs(spark, monkeypatch, direct):
    """Open buckets searched by rarest shingles: chains, passages and pages of one template, some of them alike."""
    monkeypatch.setattr(H, "DIRECT", direct)
    rng = random.Random(8)
    common = [f"c{i}" for i in range(90)]
    docs = corpus(6)
    for i in range(20_000, 20_070):
        page = common + [f"p{i}x{j}" for j in range(rng.randrange(2, 40))]
        docs += [(i, " ".join(page)), (i + 1000, " ".join(page[:-1] + ["other"]))]
    got = sorted(tuple(r) for r in H.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string"), 3, 85).collect())
    assert got == brute(docs, 3, 85)


def test_rarest_shingles_meet(spark):
    """Every pair of sets at the limit or above shares a key; template shingles are no keys of long sets."""
    rng = random.Random(9)
    common = list(range(1, 31))
    sets = [set(common) | {rng.randrange(100, 10**6) for _ in range(rng.randrange(1, 25))} for _ in range(60)]
    sets += [set(list(s)[: len(s) - rng.randrange(1, 4)]) for s in sets]
    spread = lambda x: (x * 0x9E3779B97F4A7C15) % (1 << 64)
    rows = [(i, H.np.array(sorted(map(spread, s)), H.np.uint64).tobytes()) for i, s in enumerate(sets)]
    keys = {}
    for r in H._rarest(spark.createDataFrame(rows, "node long, hashes binary"), 80).collect():
        keys.setdefault(r.node, set()).add(r.key)
    for i, x in enumerate(sets):
        assert len(keys[i]) == len(x) + 1 - -(-len(x) * 80 // 100)
        assert all(keys[i] & keys[j] for j in range(i) if 100 * len(x & sets[j]) >= 80 * len(x | sets[j]))


def test_nulls_repeats_and_empty(spark):
    df = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (2, "a b c d"), (None, "a b c d"), (1, "x y z")], "doc_id bigint, text string")
    got = sorted((r.doc_id is None, r.doc_id, r.n_shingles, r.component_id, r.kept) for r in H.near_duplicates(df, 3, 85).collect())
    assert got == [(False, 1, 1, 1, True), (False, 1, 2, 1, True), (False, 1, 2, 1, True), (False, 2, 2, 1, False), (True, None, 2, None, True)]
    assert H.near_duplicates(df.limit(0), 3, 85).count() == 0


def test_ids_on_several_texts(spark):
    """A component is found by text: an id that stands on a near-copy and on another text is told apart, however many texts it has."""
    rng = random.Random(3)
    a, b, c, d, e, f, g = (" ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randrange(99)) for _ in range(80)) for _ in range(7))
    rows = [(3, a), (5, a + " tail"), (5, b), (13, c), (15, c), (15, d), (25, e), (25, e + " tail"), (25, f), (25, f), (27, f + " tail"), (27, g)]
    blank = [(4, None), (4, ""), (4, ""), (None, a), (None, a)]
    many = [(1000, " ".join(f"v{rng.randrange(9000)}" for _ in range(30))) for _ in range(3000)]
    copies = [(1000, t + " tail") for _, t in many[:50]] + [(1001, t + " other tail") for _, t in many[:50]]
    df = spark.createDataFrame([(*r, "clash", "c") for r in rows + blank + many + copies], "doc_id bigint, text string, component string, text_hash string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in H.near_duplicates(df).where("doc_id < 100").collect())
    assert got == brute(rows + [r for r in blank if r[0]], 5, 80)
    left = [(r.doc_id, r.text) for r in H.without_copies(df).collect()]
    small = {r for r in left if r[0] is not None and r[0] < 100 and r[1]}
    assert {(3, a), (5, b), (13, c), (15, d), (25, f), (27, g)} == small - {(25, e), (25, e + " tail")} and len(small) == 7
    assert sorted(map(str, (r for r in left if r in blank))) == sorted(map(str, [*blank[:2], *blank[3:]]))
    assert sum(r[0] == 1000 for r in left) == 3000 and not any(r[0] == 1001 for r in left)


def test_banding():
    assert H.banding(0.85) == (36, 7) and H.banding(0.8) == (42, 6)
    for limit in (0.5, 0.8, 0.95):
        bands, rows = H.banding(limit)
        assert (1 - limit**rows) ** bands <= H.MOST_MISSED and bands * rows <= H.BUCKETS


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)] + [(500, i) for i in range(501, 700)]
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    want = sorted((i, find(i)) for i in {x for a, b in edges if a != b for x in (a, b)})
    assert sorted(tuple(r) for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()) == want


def test_a_group_of_near_copies_takes_few_pairs(spark, monkeypatch):
    rng = random.Random(5)
    base = [f"b{rng.randrange(4000)}" for _ in range(400)]
    docs = []
    for i in range(150):
        words = list(base)
        for at in rng.sample(range(400), 9):  # about 0.87 from the base, and 0.77 from each other
            words[at] = f"x{i}-{at}"
        docs.append((i + 1 if i else 1000, " ".join(words if i % 3 else words[:200] + base[200:])))
    made = []
    store = H.stored
    monkeypatch.setattr(H, "stored", lambda df, name, *a: (lambda out: (made.append(out.count()) if name == "open-pairs" else None, out)[1])(store(df, name, *a)))
    found = H.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string"), 3, 85).collect()
    assert sorted(map(tuple, found)) == brute(docs, 3, 85)
    assert sum(made) < 2000, made


def test_stars_take_no_rounds_and_few_edges_few_files(spark, monkeypatch):
    made = []
    store = C.stored
    monkeypatch.setattr(C, "stored", lambda df, name, *a: (lambda out: (made.append((name, len(out.inputFiles()))), out)[1])(store(df, name, *a)))
    stars = [(i % 3, i) for i in range(3, 300)]
    found = components(spark.createDataFrame(stars, "a bigint, b bigint")).collect()
    assert sorted(map(tuple, found)) == sorted([(i % 3, i % 3) for i in range(3)] + [(i, i % 3) for i in range(3, 300)])
    assert [n for n, _ in made] == ["edges"]
    made.clear()
    found = components(spark.createDataFrame([(i, i + 1) for i in range(200)], "a bigint, b bigint")).collect()
    assert {r.component for r in found} == {0} and len(found) == 201
    assert all(files == 1 for _, files in made[1:])


def test_shingles_of_one_set_are_not_shown(spark):
    """Two sets of ten with one shingle in common, and a third one by itself."""
    sets = [set(range(10)), {9, *range(100, 109)}, set(range(200, 210))]
    spread = lambda x: ((x + 1) * 0x9E3779B97F4A7C15) % (1 << 64)
    rows = [(i, 7 + i, H.np.array(sorted(map(spread, s)), H.np.uint64).tobytes()) for i, s in enumerate(sets)]
    shown = H._rarest(spark.createDataFrame(rows, "node long, component long, hashes binary"), 5, shared=True).collect()
    assert {(r.node, r.component, H.np.int64(r.key).view(H.np.uint64)) for r in shown} == {(0, 7, spread(9)), (1, 8, spread(9))}
    assert all(r.before == [] for r in shown)
