"""Near-duplicates by HyperMinHash: banded registers, estimates, and exact checks on full sets.

A document is the set of its word shingles, hashed to 64 bits. The high bits of a hash choose
a bucket; of the smallest rest in each bucket the sketch keeps the number of
leading zeros and the bits behind them (HyperMinHash: Yu and Weber, 2017). Empty
buckets copy from a full one by a fixed order (Shrivastava, 2017), so that small sets
fill all registers too.

1. Documents with equal sets are one class. Classes have numbers of their own, as an id may stand on several texts.
2. Bands of registers of all classes are hashed; classes with an equal band are a bucket.
   Bands are as long as they can be for two sets just at the limit to share none
   with a probability of at most one in 100,000 (`banding`).
3. Each class is compared with the smallest class of the bucket it shares most bands
   with. Links that hold give first components.
   Then, in turns, classes outside the largest component of their buckets are compared with another member
   of it, as long as many of these links hold: a group of near-copies becomes one component
   by a few pairs of each class.
4. Where a bucket still has several components, and at most `DIRECT` members outside its largest one,
   these are compared with all members of other components. Members of other open buckets, such as many
   pages of one template, meet by their rarest shingles instead: of two sets at the limit each has one of
   the other's among its n - ceil(limit * n) + 1 rarest, in any order that is the same for both
   (prefix filter: Chaudhuri, Ganti and Kaushik, 2006). So no pair of a bucket is left
   out, except pairs already connected. The comparison is part of the join: by sizes, and
   by a lower bound of how many shingles differ, from parities of 1024 hash cells
   (odd sketches: Mitzenmacher, Pagh and Pham, 2014), which never rejects a link.
5. Of the pairs left, those whose estimated Jaccard, corrected for registers that
   agree by chance, is more than 4.5 standard errors below the limit go; the
   rest are checked on the full sets.

Nothing in this is per group of copies: a group of any size costs a pair for each
class and the pairs of step 4. What is rare is told by counters by hash, of fixed size; where they mislead,
pairs are compared in vain, and none is lost.

Nulls and odd rows: a null text, or one without words, has an empty set and is linked
with nothing; a text with fewer words than a shingle has its whole sequence as
one; rows that repeat an id and a text are one class, and all are kept or none; rows that
repeat an id with other texts are classes of their own: what is linked with one text says nothing
about the others. A component is named by the smallest id on any of its texts, so two
components may have one name. Rows with a null id are kept, with a null component.
`without_copies` leaves one row of each component, and equal rows without words once.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator
from functools import cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epiloom.llm.common import in_batches, rows_of, stored, utf8
from epiloom.llm.components import components

BUCKETS = 256
MANTISSA = 10
MOST_MISSED = 1e-5
PARITY_WORDS = 16
ERRORS = 4.5
#: A bucket with more members outside its largest component is searched by rarest shingles.
DIRECT = 64
#: At most so many turns of comparing with the largest component, each as long as one in `HOLDING` pairs is a link,
#: and as more than one in `LEFT` is none: what is left is few pairs otherwise.
TURNS = 5
HOLDING = 2
LEFT = 5
#: Counters of shingles by hash, and how many travel as one row.
CELLS = 1 << 20
#: What a counter of one shingle shows, on its scale.
ONCE = 6
BEFORE = 8
CHUNK = 1 << 16
_BOUNDS = np.arange(BUCKETS, dtype=np.uint64) << np.uint64(56)
_LOW = np.uint64((1 << 56) - 1)


def shingles(text: bytes, size: int) -> np.ndarray:
    """The set of hashed shingles, sorted. Words are what white space of ASCII separates, with A-Z in lower case."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words))], np.uint64)
    runs = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, runs), np.uint64, len(words) - size + 1))


@cache
def _probes() -> np.ndarray:
    """For each bucket the order in which an empty one looks for a full one."""
    rng = np.random.Generator(np.random.PCG64(7))
    return np.stack([rng.permutation(BUCKETS) for _ in range(BUCKETS)]).astype(np.int64)


def registers(hashes: np.ndarray) -> np.ndarray:
    """A register of 16 bits for each bucket, of a sorted set that is not empty."""
    at = np.searchsorted(hashes, _BOUNDS)
    found = hashes[np.minimum(at, len(hashes) - 1)]
    full = (at < len(hashes)) & ((found & ~_LOW) == _BOUNDS)
    rest = ((found & _LOW) >> np.uint64(3)).astype(np.int64)  # 53 bits
    zeros = 53 - np.frexp(rest.astype(np.float64))[1]
    zeros = np.where(rest == 0, 53, zeros)
    mantissa = ((rest << (zeros + 1)) & ((1 << 53) - 1)) >> (53 - MANTISSA)
    out = ((zeros << MANTISSA) | mantissa).astype(np.uint16)
    if not full.all():
        empty = np.flatnonzero(~full)
        order = _probes()[empty]
        near = full[order[:, :16]]
        source = order[np.arange(len(empty)), near.argmax(axis=1)]
        lost = ~near.any(axis=1)
        if lost.any():
            source[lost] = order[lost, full[order[lost]].argmax(axis=1)]
        out[empty] = out[source]
    return out


def parities(hashes: np.ndarray) -> np.ndarray:
    """Of 1024 cells, whether an odd number of hashes falls into each, as 16 words."""
    odd = np.bincount((hashes & np.uint64(64 * PARITY_WORDS - 1)).astype(np.int64), minlength=64 * PARITY_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8")


def banding(limit: float) -> tuple[int, int]:
    """How many bands, and registers in each: 36 of 7 for 0.85, 42 of 6 for 0.8."""
    rows = max((r for r in range(1, BUCKETS + 1) if (1 - limit**r) ** (BUCKETS // r) <= MOST_MISSED), default=1)
    return BUCKETS // rows, rows


def chance(n: int, m: int) -> float:
    """How likely registers of two disjoint sets of sizes n and m agree: the same zeros and mantissa by chance."""
    a, b = max(1.0, n / BUCKETS), max(1.0, m / BUCKETS)
    total = 0.0
    for zeros in range(40):
        high, low = 2.0**-zeros, 2.0 ** -(zeros + 1)
        total += low / (1 << MANTISSA) * a * b / (a + b) * (math.exp(-(a + b) * low) - math.exp(-(a + b) * high))
    return min(0.5, total)


def estimate(x: np.ndarray, y: np.ndarray, n: int, m: int) -> float:
    """Jaccard of two sets from their registers, corrected for agreement by chance."""
    agree, c = float((x == y).mean()), chance(n, m)
    return max(0.0, (agree - c) / (1 - c))


def least_estimate(limit: float, n: int, m: int) -> float:
    """The estimate below which a pair of at least `limit` is as good as impossible. Small sets fill few registers."""
    return limit - ERRORS * math.sqrt(limit * (1 - limit) / min(BUCKETS, n, m))


_SKETCH = pa.schema(
    [("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("registers", pa.binary())]
    + [("parity", pa.list_(pa.int64()))]
)
_SKETCH_DDL = "doc_id long, text_hash long, n long, digest binary, registers binary, parity array<long>"


def digest_of(found: np.ndarray) -> bytes:
    """What equal sets have in common."""
    return blake2b(found.tobytes(), digest_size=16).digest()


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, hash of the text, n, digest of the set, registers and parities of each document; the last two null for empty sets."""

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for doc_id, text_hash, text in rows_of(batches, "doc_id", "text_hash", "body"):
                found = shingles(text, size)
                if len(found):
                    yield doc_id, text_hash, len(found), digest_of(found), registers(found).tobytes(), parities(found).tolist()
                else:
                    yield doc_id, text_hash, 0, b"", None, None

        return in_batches(rows(), _SKETCH, 1000)

    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), utf8(F.col("text")).alias("body")).mapInArrow(compute, _SKETCH_DDL)


def numbered_classes(documents: DataFrame, columns: list[str]) -> DataFrame:
    """digest, node (a number of its own), first_id and the given columns, as on that id, of each distinct set of (doc_id, digest, columns).

    The numbers hold once they are stored, which this does.
    """
    classes = documents.groupBy("digest").agg(F.min("doc_id").alias("first_id"), *(F.min_by(c, "doc_id").alias(c) for c in columns))
    return stored(classes.withColumn("node", F.monotonically_increasing_id()), "classes")


def named_components(classes: DataFrame, linked: DataFrame) -> DataFrame:
    """digest, component (a node) and component_id (its smallest id) of every class, from (node, component) of those that are linked."""
    of_node = stored(classes.select("digest", "node", "first_id").join(linked, "node", "left"), "class-components")
    least = stored(of_node.where("component IS NOT NULL").groupBy("component").agg(F.min("first_id").alias("least_id")), "component-names")
    named = of_node.join(least, "component", "left")
    return named.select("digest", F.coalesce("component", "node").alias("component"), F.coalesce("least_id", "first_id").alias("component_id"))


def _bands(classes: DataFrame, limit: float) -> DataFrame:
    """key and node: one row for each band of each class."""
    bands, rows = banding(limit)
    part = "transform(sequence(0, {}), i -> xxhash64(i, substring(registers, i * {} + 1, {})))"
    return classes.select(F.explode(F.expr(part.format(bands - 1, 2 * rows, 2 * rows))).alias("key"), "node")


def _full_sets(docs: DataFrame, classes: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """node and its hashed shingles, once for each of the given nodes.

    Read is the text that the class has on its smallest id.
    """

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for node, digest, text in rows_of(batches, "node", "digest", "body"):
                found = shingles(text, size)
                if digest_of(found) == digest:  # else another text with the same hash
                    yield node, found.tobytes()

        return in_batches(rows(), pa.schema([("node", pa.int64()), ("hashes", pa.binary())]), 500)

    wanted = classes.join(nodes, "node", "left_semi").select(F.col("first_id").alias("doc_id"), "text_hash", "node", "digest")
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), utf8(F.col("text")).alias("body"))
    chosen = texts.join(wanted, ["doc_id", "text_hash"])
    sets = stored(chosen.mapInArrow(compute, "node long, hashes binary"), "sets")
    if sets.groupBy("node").count().where("count > 1").isEmpty():
        return sets
    return stored(sets.dropDuplicates(["node"]), "sets")  # rows that repeat id and set


def _may_link(percent: int, n: Column, m: Column) -> Column:
    """By their sizes, two sets can have a Jaccard of percent / 100."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def _differ_at_least(words: list[tuple[Column, Column]]) -> Column:
    total = F.bit_count(words[0][0].bitwiseXOR(words[0][1]))
    for a, b in words[1:]:
        total = total + F.bit_count(a.bitwiseXOR(b))
    return total


def _links(pairs: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b), those whose sets have a Jaccard of at least percent / 100: by estimate, then on the full sets."""
    limit = percent / 100
    sketch = classes.select("node", "n", "registers")

    def near(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for a, b, n, m, x, y in rows_of(batches, "a", "b", "n", "m", "x", "y"):
                if estimate(np.frombuffer(x, np.uint16), np.frombuffer(y, np.uint16), n, m) >= least_estimate(limit, n, m):
                    yield a, b

        return in_batches(rows(), pa.schema([("a", pa.int64()), ("b", pa.int64())]), 5000)

    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for a, b, x, y in rows_of(batches, "a", "b", "x", "y"):
                p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                if 100 * both >= percent * (len(p) + len(q) - both):
                    yield a, b

        return in_batches(rows(), pa.schema([("a", pa.int64()), ("b", pa.int64())]), 5000)

    left = sketch.toDF("a", "n", "x")
    right = sketch.toDF("b", "m", "y")
    likely = pairs.join(left, "a").join(right, "b").where(_may_link(percent, F.col("n"), F.col("m")))
    likely = stored(likely.mapInArrow(near, "a long, b long"), "likely-pairs")
    full = likely.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
    return full.mapInArrow(check, "a long, b long").distinct()


def in_buckets(keys: DataFrame) -> DataFrame:
    """key, node and pivot (the smallest node of the key), of (key, node), where a key has several nodes."""
    shared = keys.groupBy("key").agg(F.min("node").alias("pivot"), F.max("node").alias("last")).where("pivot < last")
    return stored(keys.join(stored(shared.select("key", "pivot"), "buckets"), "key"), "members")


def link_classes(docs: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """node and component of the classes that are linked with any other."""
    members = in_buckets(_bands(classes, percent / 100))
    sets = _full_sets(docs, classes, members.select("node").distinct(), size)
    return link_members(members, classes, sets, percent)


def link_members(members: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """node and component of classes linked within buckets (`in_buckets`), whose full `sets` (node, hashes) decide.

    `classes` has node, n, registers and parity. All three are read several times: give them as stored tables.
    """
    # The pivot that a class shares most bands with.
    common = members.where("node <> pivot").groupBy("node", "pivot").count()
    best = common.groupBy("node").agg(F.max_by("pivot", F.struct("count", -F.col("pivot"))).alias("pivot"))
    first = stored(_links(best.toDF("a", "b"), classes, sets, percent), "links")
    words = [f"w{i}" for i in range(PARITY_WORDS)]
    parity = classes.select("node", "n", *(F.col("parity")[i].alias(w) for i, w in enumerate(words)))

    # Buckets that still have several components.
    first, own = _by_turns(members.drop("pivot"), first, classes, sets, parity, percent)
    sizes = own.groupBy("key", "component").count()
    outside = F.sum("count") - F.max("count")
    most = sizes.groupBy("key").agg(F.max_by("component", F.struct("count", "component")).alias("largest"), outside.alias("outside"))
    most = stored(most.where("outside > 0").select("key", "largest", (F.col("outside") > DIRECT).alias("wide")), "open-buckets")
    narrow = stored(own.join(most.where("NOT wide"), "key").join(parity, "node"), "open-members")
    pairs = _alike(narrow.where("component <> largest"), narrow, words, percent)

    wide = stored(own.join(most.where("wide"), "key").select("node", "component").distinct(), "wide-members")
    if not wide.isEmpty():
        shown = stored(_rarest(sets.join(wide, "node"), percent, shared=True), "rarest-shingles")
        several = shown.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
        met = stored(shown.join(several.select("key"), "key").join(parity, "node"), "shown-members")
        # A pair that surely met at an earlier shingle is not made again.
        met_before = F.arrays_overlap("a.before", "b.before")
        pairs = pairs.union(_alike(met, met, words, percent, (F.col("a.component") < F.col("b.component")) & ~met_before)).distinct()
    more = stored(_links(stored(pairs, "open-pairs"), classes, sets, percent), "links")
    return components(first.union(more))


def _by_turns(members: DataFrame, links: DataFrame, classes: DataFrame, sets: DataFrame, parity: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """The first components with more links within the buckets of `members` (key, node and others), as edges (a, b), and the members with their component."""

    def labelled() -> tuple[DataFrame, DataFrame]:
        labels = components(links)
        own = members.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
        return labels.where("node <> component").toDF("a", "b"), stored(own, "labelled-members")

    links, own = labelled()
    for turn in range(TURNS):
        pairs = stored(_with_largest(own, parity, percent, turn), "turn-pairs")
        found = stored(_links(pairs, classes, sets, percent), "links")
        many = found.count()
        if not many:
            break
        links = links.union(found)
        links, own = labelled()
        asked = pairs.count()
        if many * HOLDING < asked or (asked - many) * LEFT < asked:
            break
    return links, own


def _with_largest(own: DataFrame, parity: DataFrame, percent: int, turn: int) -> DataFrame:
    """A pair (a, b) for each node outside the largest component of a bucket: with a member of that component, another
    one in each turn; of several buckets that member whose parities differ least from its own, if they may be linked.
    """
    some = F.min_by("node", F.xxhash64("node", F.lit(turn))).alias("some")
    parts = own.groupBy("key", "component").agg(F.count("*").alias("count"), some)
    largest = F.max_by(F.struct("component", "some"), F.struct("count", "component")).alias("largest")
    several = parts.groupBy("key").agg(largest, F.count("*").alias("parts")).where("parts > 1")
    asking = own.join(several.select("key", F.col("largest.component").alias("other"), "largest.some"), "key").where("component <> other")
    words = [c for c in parity.columns if c not in ("node", "n")]
    there = parity.select(F.col("node").alias("some"), F.col("n").alias("m"), *(F.col(w).alias(f"o{w}") for w in words))
    pairs = asking.select("node", "some").distinct().join(parity, "node").join(there, "some")
    pairs = pairs.withColumn("differ", _differ_at_least([(F.col(w), F.col(f"o{w}")) for w in words]))
    likely = pairs.where(_may_link(percent, F.col("n"), F.col("m")) & (F.col("differ") * (100 + percent) <= (F.col("n") + F.col("m")) * (100 - percent)))
    best = likely.groupBy("node").agg(F.min_by("some", F.struct("differ", "some")).alias("some"))
    return best.select(F.greatest("node", "some").alias("a"), F.least("node", "some").alias("b")).distinct()


def _alike(some: DataFrame, all_: DataFrame, words: list[str], percent: int, further: Column | None = None) -> DataFrame:
    """Pairs (a, b) of nodes of one key and of different components that may be linked, by sizes and parities."""
    a, b = some.alias("a"), all_.alias("b")
    differ = _differ_at_least([(F.col(f"a.{w}"), F.col(f"b.{w}")) for w in words])
    pairs = a.join(
        b,
        (F.col("a.key") == F.col("b.key")) & (F.col("a.component") != F.col("b.component"))
        & _may_link(percent, F.col("a.n"), F.col("b.n"))
        # 1 - J is at least twice the difference over (sizes + difference).
        & (differ * (100 + percent) <= (F.col("a.n") + F.col("b.n")) * (100 - percent))
        & (F.lit(True) if further is None else further),
    )
    return pairs.select(F.greatest("a.node", "b.node").alias("a"), F.least("a.node", "b.node").alias("b")).distinct()


def _cells(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - (CELLS - 1).bit_length())).astype(np.int64)


def _counters(sets: DataFrame) -> np.ndarray:
    """For each cell of hashes how many of the sets' shingles fall into it, on a scale of 6 log2(1 + n), as a byte."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, np.int64)
        for (hashes,) in rows_of(batches, "hashes"):
            np.add.at(total, _cells(np.frombuffer(hashes, np.uint64)), 1)
        if total.any():
            yield from packed((i, zlib.compress(total[i * CHUNK : (i + 1) * CHUNK].tobytes(), 1)) for i in range(CELLS // CHUNK))

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for chunk, counters in rows_of(batches, "chunk", "counters"):
            sums[chunk] = sums.get(chunk, 0) + np.frombuffer(zlib.decompress(counters), np.int64)
        yield from packed((i, np.minimum(255, 6 * np.log2(1 + n)).astype(np.uint8).tobytes()) for i, n in sums.items())

    def packed(rows: Iterable[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        return in_batches(iter(rows), pa.schema([("chunk", pa.int32()), ("counters", pa.binary())]), 4)

    layout = "chunk int, counters binary"
    out = np.zeros(CELLS, np.uint8)
    for row in sets.mapInArrow(count, layout).repartition("chunk").mapInArrow(add, layout).collect():  # CELLS bytes
        out[row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK] = np.frombuffer(row["counters"], np.uint8)
    return out


def _rarest(sets: DataFrame, percent: int, shared: bool = False) -> DataFrame:
    """key, node and component, if given: of each set (node, hashes, component) the rarest shingles, so many that two sets at the limit have one in common.

    If `shared`, those that no other set has, by their counter, are left out: nothing is met there.
    `before` are the last `BEFORE` rarer ones. Where two sets meet at a key and have one of these in common too,
    they meet at that one as well; at the rarest that they have in common they have none before.
    """
    held = stored(sets, "wide-sets")
    sent = held.sparkSession.sparkContext.broadcast(_counters(held))
    names = ["node", *(c for c in held.columns if c == "component")]
    layout = pa.schema([("key", pa.int64()), *((c, pa.int64()) for c in names), ("before", pa.list_(pa.int64()))])

    def show(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = sent.value

        def rows() -> Iterator[tuple]:
            for hashes, *own in rows_of(batches, "hashes", *names):
                found = np.frombuffer(hashes, np.uint64)
                shown = len(found) + 1 - -(-len(found) * percent // 100)
                first = np.lexsort((found, counters[_cells(found)]))[:shown]
                if shared:
                    first = first[counters[_cells(found[first])] > ONCE]
                keys = found[first].view(np.int64).tolist()
                for i, key in enumerate(keys):
                    yield key, *own, keys[max(0, i - BEFORE) : i]

        return in_batches(rows(), layout, 10_000)

    return held.mapInArrow(show, ", ".join(["key long", *(f"{c} long" for c in names), "before array<long>"]))


def with_components(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, text_hash, n, component (a number; null without words or id) and component_id of each document (doc_id, text)."""
    all_docs = stored(sketches(docs, size), "sketches")
    classes = numbered_classes(all_docs.where("n > 0 AND doc_id IS NOT NULL"), ["text_hash", "n", "registers", "parity"])
    found = stored(link_classes(docs, classes, size, percent), "node-components")
    of_digest = stored(named_components(classes, found), "digest-components")
    known = F.col("doc_id").isNotNull()
    return all_docs.join(of_digest, "digest", "left").select(
        "doc_id", "text_hash", "n", F.when(known, F.col("component")).alias("component"), F.when(known, F.coalesce("component_id", "doc_id")).alias("component_id")
    )


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id that links lead to) and kept, of each document (doc_id, text)."""
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return with_components(docs, size, percent).select("doc_id", F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"))


def without_copies(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs`, one of each component: that with the smallest id, and of its texts that with the smallest hash.

    Rows without words stay, equal ones once; rows without an id stay all.
    """
    found = stored(with_components(docs, size, percent).where("doc_id IS NOT NULL"), "components-of-rows")
    own = found.where("doc_id = component_id")
    single = own.groupBy("doc_id", "component", F.when(F.col("n") == 0, F.col("text_hash")).alias("blank"))
    chosen = single.agg(F.min("text_hash").alias("text_hash")).select("doc_id", "text_hash")
    hashed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.struct("*").alias("row"))
    kept = hashed.join(stored(chosen, "chosen-rows"), ["doc_id", "text_hash"], "left_semi")
    if not found.groupBy("doc_id", "text_hash").count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates(["doc_id", "text_hash"])
    return kept.select("row.*").union(docs.where("doc_id IS NULL"))
