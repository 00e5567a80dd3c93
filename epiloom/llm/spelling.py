"""Spelling variants: words one edit apart, found by k-d trees over letter counts.

One inserted or deleted letter changes one letter count by one; a replaced letter takes one count down and another up. So a
word's variants of its own length, and those one letter longer, lie in a small box around its vector of letter counts, and
shorter ones are found from the other side. For each length there is one k-d tree: its upper part, made from a sample of
`SAMPLE` words (which says where it is cut, not what is found), cuts the words into cells of about `CELL`; a word goes to the
cells that its boxes meet. In a cell the tree is continued down to leaves; what shares a leaf with
a word's box is compared letter by letter. A leaf of the upper part that can't be cut as its words have the same letters is
dealt out as a grid, so that a task holds about `CELL` words of it.

Defined results: null and empty texts have no words; a null id counts as empty in the edits
of `edited_runs`; repeated rows count as often as they occur; empty tables give no rows. Only
`doc_id` and `text` are read, whatever other columns there are. Runs of letters of any length are words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epiloom.llm.common import in_batches, rows_of, stored, utf8

CELL, SAMPLE, LEAF = 16_384, 200_000, 96
HELD = 400_000
EDITED = 97
_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_COUNTS = pa.schema([("word", pa.string()), ("n", pa.int64())])
_ROUTES = pa.schema([("length", pa.int64()), ("cell", pa.int64()), ("row", pa.int64()), ("col", pa.int64()), ("role", pa.int8()), ("word", pa.string()), ("n", pa.int64())])
_FOUND = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("near", pa.string()), ("near_n", pa.int64())])
TARGET, SAME, SHORTER = 0, 1, 2


def edited_runs(docs: DataFrame, least_length: int) -> DataFrame:
    """word, n: the runs of letters of all texts, A-Z in lower case, some of them with a letter less; counted by task.

    Of a run whose crc32, with its document's id before it, is divisible by `EDITED`, the letter at that number modulo its length is deleted.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def words() -> Iterator[tuple[str, int]]:
            held: Counter[str] = Counter()
            for doc_id, text in rows_of(batches, "doc_id", "text"):
                begin = zlib.crc32(b"%s:" % doc_id.encode())
                for run, n in Counter(_RUN.findall(text.translate(_LOWER).decode())).items():
                    h = zlib.crc32(run.encode(), begin)
                    if h % EDITED == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1 :]
                    if len(run) >= least_length:
                        held[run] += n
                if len(held) > HELD:
                    yield from held.items()
                    held.clear()
            yield from held.items()

        yield from in_batches(words(), _COUNTS, 10_000)

    ids = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id")
    return docs.select(ids, utf8(F.col("text")).alias("text")).mapInArrow(count, "word string, n bigint")


def vocabulary(docs: DataFrame, least_length: int = 5, least: int = 3) -> DataFrame:
    """word, n, length of all words with `least_length` letters and `least` occurrences."""
    counts = edited_runs(docs, least_length).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return counts.withColumn("length", F.char_length("word").cast("bigint"))


def _codes(words: list[str], length: int) -> np.ndarray:
    """A row of letters for each word; all of these letters have numbers below 256."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), length)


def _counts(codes: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """How often each letter is in each word, 100 at most (which brings vectors nearer, never further apart)."""
    out = np.zeros((len(codes), len(letters)), np.int8)
    for i, x in enumerate(letters):
        out[:, i] = np.minimum((codes == x).sum(1), 100)
    return out


class Cut(NamedTuple):
    """Words with at most `most` of a letter go left."""

    letter: int
    most: int
    left: Tree
    right: Tree


class Cell(NamedTuple):
    """A leaf of the upper tree; its words and those that ask for them are dealt to `grid` groups each."""

    number: int
    grid: int


Tree = Cut | Cell


def _best_cut(counts: np.ndarray) -> tuple[int, int] | None:
    """The column and count that cut most evenly; None if all rows are equal."""
    best, at = 0, None
    for most in range(int(counts.min(initial=0)), int(counts.max(initial=0))):
        left = (counts <= most).sum(0)
        even = np.minimum(left, len(counts) - left)
        if even.max() > best:
            best, at = int(even.max()), (int(even.argmax()), most)
    return at


def plant(words: list[str], length: int, n: int, cell: int) -> Tree:
    """The upper tree of one length from a sample that stands for `n` words."""
    codes = _codes(words, length)
    letters = np.unique(codes)
    counts = _counts(codes, letters)
    share = n / max(1, len(words))
    number = iter(range(len(words) + 1))

    def grow(rows: np.ndarray) -> Tree:
        size = len(rows) * share
        cut = _best_cut(counts[rows]) if size > cell and len(rows) > 1 else None
        if cut is None:
            return Cell(next(number), max(1, round(size / cell)) if size > 2 * cell else 1)
        goes_left = counts[rows, cut[0]] <= cut[1]
        return Cut(int(letters[cut[0]]), cut[1], grow(rows[goes_left]), grow(rows[~goes_left]))

    return grow(np.arange(len(words)))


def _cells(tree: Tree, codes: np.ndarray, down: int) -> Iterator[tuple[Cell, np.ndarray]]:
    """Cells, and which words reach them with at most one letter more and `down` less."""
    letters = np.array(sorted(_letters(tree)), np.uint8)
    column = {int(x): i for i, x in enumerate(letters)}
    counts = _counts(codes, letters).astype(np.int64)

    def walk(node: Tree, rows: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> Iterator[tuple[Cell, np.ndarray]]:
        q = counts[rows]
        rows = rows[(np.maximum(lo - q, 0).sum(1) <= 1) & (np.maximum(q - hi, 0).sum(1) <= down)]
        if not len(rows):
            return
        if isinstance(node, Cell):
            yield node, rows
            return
        i = column[node.letter]
        below, above = hi.copy(), lo.copy()
        below[i], above[i] = min(hi[i], node.most), max(lo[i], node.most + 1)
        yield from walk(node.left, rows, lo, below)
        yield from walk(node.right, rows, above, hi)

    yield from walk(tree, np.arange(len(codes)), np.zeros(len(letters), np.int64), np.full(len(letters), 1 << 30))


def _home(tree: Tree, codes: np.ndarray) -> Iterator[tuple[Cell, np.ndarray]]:
    """Cells, and the words that are in them."""

    def walk(node: Tree, rows: np.ndarray) -> Iterator[tuple[Cell, np.ndarray]]:
        if isinstance(node, Cell):
            yield node, rows
            return
        left = (codes[rows] == node.letter).sum(1) <= node.most
        yield from walk(node.left, rows[left])
        yield from walk(node.right, rows[~left])

    yield from walk(tree, np.arange(len(codes)))


def _letters(tree: Tree) -> set[int]:
    return {tree.letter} | _letters(tree.left) | _letters(tree.right) if isinstance(tree, Cut) else set()


def upper_trees(words: DataFrame, cell: int = CELL, sample: int = SAMPLE) -> dict[int, Tree]:
    """A tree for each length that has more than `cell` words, from about `sample` words by hash; others are one cell."""
    many = {r["length"]: r["count"] for r in words.groupBy("length").count().where(F.col("count") > cell).collect()}
    total = sum(many.values())
    if not total:
        return {}
    chosen = words.where(F.col("length").isin(list(many)))
    if total > sample:
        chosen = chosen.where(F.pmod(F.xxhash64("word"), F.lit(1_000_000)) < int(1_000_000 * sample / total) + 1)
    by_length: dict[int, list[str]] = {x: [] for x in many}
    for row in chosen.select("word", "length").collect():
        by_length[row["length"]].append(row["word"])
    return {x: plant(found, x, many[x], cell) for x, found in by_length.items()}


def _routed(words: DataFrame, trees: dict[int, Tree]) -> DataFrame:
    """A row for each cell that a word is in, or may have a variant in."""
    alone = Cell(0, 1)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                by_length: dict[int, list[tuple[str, int]]] = {}
                for word, n, length in zip(*(batch.column(c).to_pylist() for c in ("word", "n", "length")), strict=True):
                    by_length.setdefault(length, []).append((word, n))
                for length, found in by_length.items():
                    codes = _codes([w for w, _ in found], length)
                    own, longer = trees.get(length, alone), trees.get(length + 1, alone)
                    ways = ((TARGET, length, _home(own, codes)), (SAME, length, _cells(own, codes, 1)), (SHORTER, length + 1, _cells(longer, codes, 0)))
                    for role, of, reached in ways:
                        for cell, which in reached:
                            for word, n in (found[i] for i in which.tolist()):
                                mine = zlib.crc32(word.encode()) % cell.grid
                                for other in range(cell.grid):
                                    yield (of, cell.number, *((mine, other) if role == TARGET else (other, mine)), role, word, n)

        yield from in_batches(rows(), _ROUTES, 10_000)

    return words.select("word", "n", "length").mapInArrow(route, "length bigint, cell bigint, row bigint, col bigint, role byte, word string, n bigint")


def _leaves(targets: np.ndarray, asking: np.ndarray, down: int, leaf: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of targets and of those that ask which meet in a leaf of a k-d tree over the targets."""

    def walk(rows: np.ndarray, ask: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        lo, hi = targets[rows].min(0), targets[rows].max(0)
        q = asking[ask]
        ask = ask[(np.maximum(lo - q, 0).sum(1) <= 1) & (np.maximum(q - hi, 0).sum(1) <= down)]
        if not len(ask):
            return
        cut = _best_cut(targets[rows]) if len(rows) > leaf else None
        if cut is None:
            # Rows of equal letters can be many: leaves are compared in parts.
            for i in range(0, len(ask), 4096):
                for j in range(0, len(rows), 256):
                    yield rows[j : j + 256], ask[i : i + 4096]
            return
        left = targets[rows, cut[0]] <= cut[1]
        yield from walk(rows[left], ask)
        yield from walk(rows[~left], ask)

    if len(targets) and len(asking):
        yield from walk(np.arange(len(targets)), np.arange(len(asking)))


def _one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(1) == 1


def _one_inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of b are those of a with one letter more: what they share from the front and from behind covers a."""
    front = np.logical_and.accumulate(a == b[:, :-1], axis=1).sum(1)
    behind = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(1)
    return front + behind >= a.shape[1]


def _bits(counts: np.ndarray) -> np.ndarray:
    """64 bits of which letters there are."""
    return np.bitwise_or.reduce(np.where(counts > 0, np.uint64(1) << (np.arange(counts.shape[1], dtype=np.uint64) % np.uint64(64)), np.uint64(0)), axis=1)


def _search(table: pa.Table) -> pa.Table:
    """How many variants each word of a cell's group has there, and the most frequent of them."""
    length = table.column("length")[0].as_py()
    role = table.column("role").to_numpy()
    words, ns = table.column("word").to_pylist(), table.column("n").to_numpy()

    class Side:
        def __init__(self, kind: int, size: int) -> None:
            at = np.flatnonzero(role == kind)
            self.words, self.n = [words[i] for i in at], ns[at]
            self.codes = _codes(self.words, size)
            # By frequency, then by letters: the first of a word's variants is its best.
            order = sorted(range(len(at)), key=lambda i: (-int(self.n[i]), self.words[i]))
            self.order = np.array(order, np.int64)
            self.rank = np.empty(len(at), np.int64)
            self.rank[self.order] = np.arange(len(at))

        def vectors(self, letters: np.ndarray) -> None:
            self.counts = _counts(self.codes, letters)
            self.bits = _bits(self.counts)

    target, same, shorter = Side(TARGET, length), Side(SAME, length), Side(SHORTER, length - 1)
    letters = np.unique(np.concatenate([np.unique(x.codes) for x in (target, same, shorter)]))
    for x in (target, same, shorter):
        x.vectors(letters)
    out: list[tuple[str, int, str, int]] = []

    class Best:
        """Number and best rank of the variants of one side among another."""

        def __init__(self, of: Side, among: Side) -> None:
            self.of, self.among = of, among
            self.n, self.rank = np.zeros(len(of.words), np.int64), np.full(len(of.words), len(among.words), np.int64)

        def add(self, mine: np.ndarray, theirs: np.ndarray) -> None:
            np.add.at(self.n, mine, 1)
            np.minimum.at(self.rank, mine, self.among.rank[theirs])

        def put(self) -> None:
            for i in np.flatnonzero(self.n).tolist():
                j = int(self.among.order[self.rank[i]])
                out.append((self.of.words[i], int(self.n[i]), self.among.words[j], int(self.among.n[j])))

    for asking, down, near in ((same, 1, _one_replaced), (shorter, 0, _one_inserted)):
        forth, back = Best(asking, target), Best(target, asking)
        for rows, ask in _leaves(target.counts, asking.counts, down, LEAF):
            close = np.bitwise_count(asking.bits[ask][:, None] ^ target.bits[rows][None, :]) <= 2
            i, j = np.nonzero(close)
            i, j = ask[i], rows[j]
            hit = near(asking.codes[i], target.codes[j])
            i, j = i[hit], j[hit]
            forth.add(i, j)
            if asking is shorter:
                back.add(j, i)
        forth.put()
        back.put()
    columns = zip(*out, strict=True) if out else ((), (), (), ())
    return pa.table([pa.array(list(c), t) for c, t in zip(columns, _FOUND.types, strict=True)], schema=_FOUND)


def near_words(words: DataFrame, cell: int = CELL, sample: int = SAMPLE) -> DataFrame:
    """word, n_near, near and near_n (the most frequent near word, the first by code points of equal ones) of words that have any."""
    routed = _routed(words, upper_trees(words, cell, sample))
    found = routed.groupBy("length", "cell", "row", "col").applyInArrow(_search, "word string, n_near bigint, near string, near_n bigint")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    both = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return both.select("word", "n_near", "best.near", (-F.col("best.less")).alias("near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root from (word, form): where forms lead to. A form has more occurrences than its word, so there are no rings.

    Ways double in length with each round; a way is as long as occurrences can be doubled.
    """
    ways = stored(forms.select("word", F.col("form").alias("root")), "ways")
    while True:
        on = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = stored(ways.join(on, "root", "left").select("word", "root", "next"), "ways")
        if further.where("next IS NOT NULL").isEmpty():
            return ways
        ways = further.select("word", F.coalesce("next", "root").alias("root"))


def spelling_forms(docs: DataFrame, least_length: int = 5, least: int = 3, ratio: int = 2, cell: int = CELL, sample: int = SAMPLE) -> DataFrame:
    """word, form, root, n, n_near, form_n of all words: a word's form is its most frequent near word if that has `ratio` times its occurrences."""
    words = stored(vocabulary(docs, least_length, least), "vocabulary")
    near = near_words(words, cell, sample).withColumnRenamed("word", "w")
    both = words.join(near, F.col("word") == F.col("w"), "left")
    has = F.col("near_n") >= ratio * F.col("n")
    formed = both.select(
        "word", F.when(has, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(has, F.col("near_n")).alias("form_n"),
    )
    formed = stored(formed, "forms")
    ends = roots(formed.where("form IS NOT NULL")).withColumnRenamed("word", "w")
    return formed.join(ends, F.col("word") == F.col("w"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
