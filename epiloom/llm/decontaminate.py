"""Benchmark decontamination: where texts hold ten successive words of a benchmark item.

A window is ten successive words of an item, or a shorter item as a whole. The
join of windows with documents is prefix-filtered: words are ordered by the number
of documents they occur in, counted over all documents, and a window can only occur
where its rarest word does, so that word alone is the prefix to join on. The
word's place in the window then fixes where the window would begin; a start
before the text, or an end behind it, rules it out, and what is left is compared
word by word.

Windows are kept in an index by rarest word. The index is built in blocks of
about `block_windows` rows of an item and a window, dealt by both, so that a window
which many items share is spread over the blocks; each block is
sent to the tasks and the documents are read twice for each, once to count. A benchmark of usual size is one block, a larger one costs
more passes and never more memory. Documents are never shuffled.

Nulls and odd rows: a null text has no words, is hit nowhere and is clean; an item
without words, or with a null id, has no windows; equal windows of several items
count for each. A document id that repeats gives a row each time.
"""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epiloom.llm.common import in_batches, rows_of, stored, utf8

WINDOW = 10
BLOCK_WINDOWS = 200_000
#: A-Z in lower case; digits, letters and bytes of other characters stay; all else separates words.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)

Words = tuple[bytes, ...]
#: By rarest word: by its place in the window and the window's length, the windows with their items.
Index = dict[bytes, dict[tuple[int, int], dict[Words, list[int]]]]


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORD_BYTES).split()


def windows_of(words: list[bytes], size: int = WINDOW) -> Iterator[Words]:
    if words:
        for i in range(max(1, len(words) - size + 1)):
            yield tuple(words[i : i + size])


def benchmark_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """item_id and words (the window, joined by spaces): all distinct windows."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (
            (item, b" ".join(w)) for item, t in rows_of(batches, "item_id", "body") for w in set(windows_of(words_of(t), size))
        )
        return in_batches(found, pa.schema([("item_id", pa.int64()), ("words", pa.binary())]))

    items = benchmark.where("item_id IS NOT NULL").select("item_id", utf8(F.col("text")).alias("body"))
    return items.mapInArrow(cut, "item_id long, words binary").distinct()


def document_counts(docs: DataFrame, vocabulary: frozenset[bytes]) -> dict[bytes, int]:
    """In how many of all documents each word of a bounded vocabulary occurs."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        for (text,) in rows_of(batches, "body"):
            seen.update(vocabulary.intersection(words_of(text)))
        return in_batches(iter(seen.items()), pa.schema([("word", pa.binary()), ("n", pa.int64())]), 10_000)

    partial = docs.select(utf8(F.col("text")).alias("body")).mapInArrow(count, "word binary, n long")
    return {bytes(r.word): r.n for r in partial.groupBy("word").agg(F.sum("n").alias("n")).collect()}


def index_of(windows: Iterable[tuple[int, bytes]], counts: dict[bytes, int]) -> Index:
    """Each window below its rarest word; equal counts are ordered by the word."""
    index: Index = defaultdict(lambda: defaultdict(lambda: defaultdict(list)))
    for item, joined in windows:
        words = tuple(joined.split(b" "))
        place = min(range(len(words)), key=lambda i: (counts.get(words[i], 0), words[i], i))
        index[words[place]][place, len(words)][words].append(item)
    return {w: {k: dict(v) for k, v in places.items()} for w, places in index.items()}


def hits_of(words: list[bytes], index: Index) -> tuple[list[tuple[int, int]], set[int]]:
    """Ranges of words that windows cover, merged and in order, and the items of these windows."""
    present = index.keys() & set(words)
    items: set[int] = set()
    ranges: list[tuple[int, int]] = []
    if present:
        for at, word in enumerate(words):
            if word not in present:
                continue
            for (place, length), windows in index[word].items():
                begin = at - place
                if begin < 0 or begin + length > len(words):
                    continue
                if (found := windows.get(tuple(words[begin : begin + length]))) is not None:
                    ranges.append((begin, begin + length))
                    items.update(found)
    return merged_ranges(ranges), items


def merged_ranges(ranges: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for begin, end in sorted(set(ranges)):
        if merged and begin <= merged[-1][1]:
            merged[-1] = merged[-1][0], max(end, merged[-1][1])
        else:
            merged.append((begin, end))
    return merged


_SPAN = pa.struct([("begin", pa.int64()), ("end", pa.int64())])
_FOUND = pa.schema(
    [("doc_id", pa.int64()), ("digest", pa.int64()), ("n_words", pa.int64()), ("ranges", pa.list_(_SPAN)), ("items", pa.list_(pa.int64()))]
)
_FOUND_DDL = "doc_id long, digest long, n_words long, ranges array<struct<begin:long,end:long>>, items array<long>"


def _digest(text: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little", signed=True)


def indexes(docs: DataFrame, benchmark: DataFrame, size: int, block_windows: int) -> Iterator[Broadcast]:
    """The index of each block of windows, sent to the tasks; words are counted over all of `docs`."""
    windows = stored(benchmark_windows(benchmark, size), "windows")
    blocks = max(1, -(-windows.count() // block_windows))
    block = F.pmod(F.xxhash64("words", "item_id"), F.lit(blocks))  # rows are distinct, so blocks are about even
    for k in range(blocks):
        rows = [(r.item_id, bytes(r.words)) for r in windows.where(block == k).collect()]
        vocabulary = frozenset(w for _, joined in rows for w in joined.split(b" "))
        counts = document_counts(docs, vocabulary) if rows else {}
        yield docs.sparkSession.sparkContext.broadcast(index_of(rows, counts))


def find_windows(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """doc_id, n_words, ranges (array of begin and end) and items (sorted array) of each document."""
    body = docs.select("doc_id", utf8(F.col("text")).alias("body"))
    parts: list[DataFrame] = []
    for sent in indexes(docs, benchmark, size, block_windows):

        def scan(batches: Iterable[pa.RecordBatch], sent: Broadcast = sent) -> Iterator[pa.RecordBatch]:
            def found() -> Iterator[tuple]:
                for doc_id, text in rows_of(batches, "doc_id", "body"):
                    words = words_of(text)
                    ranges, items = hits_of(words, sent.value)
                    yield doc_id, _digest(text), len(words), [{"begin": b, "end": e} for b, e in ranges], sorted(items)

            return in_batches(found(), _FOUND)

        parts.append(body.mapInArrow(scan, _FOUND_DDL))
    return (parts[0] if len(parts) == 1 else _of_all_blocks(parts)).drop("digest")


def without_windows(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """The documents, with all their columns, in which no window occurs."""
    for number, index in enumerate(indexes(docs, benchmark, size, block_windows)):
        docs = stored(docs, "clean-documents") if number else docs  # one block in a task at a time
        docs = docs.where(~_hit(index)(utf8(F.col("text"))))
    return docs


def _hit(index: Broadcast) -> Callable[[Column], Column]:
    @F.pandas_udf("boolean")
    def hit(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: bool(hits_of(words_of(t), index.value)[0]))

    return hit


def _of_all_blocks(parts: list[DataFrame]) -> DataFrame:
    """All rows of the first block, with what the other blocks found for the same id and text."""
    more = parts[1]
    for part in parts[2:]:
        more = more.union(part)
    more = more.where(F.size("ranges") > 0).distinct()  # rows that repeat id and text find the same
    more = more.groupBy(F.col("doc_id").alias("d"), F.col("digest").alias("g")).agg(
        F.flatten(F.collect_list("ranges")).alias("r"), F.flatten(F.collect_list("items")).alias("i")
    )
    same = parts[0]["doc_id"].eqNullSafe(more["d"]) & (parts[0]["digest"] == more["g"])
    none = F.array().cast("array<struct<begin:long,end:long>>")
    joined = parts[0].join(more, same, "left").select(
        "doc_id", "digest", "n_words",
        F.concat("ranges", F.coalesce("r", none)).alias("ranges"),
        F.array_sort(F.array_distinct(F.concat("items", F.coalesce("i", F.array().cast("array<long>"))))).alias("items"),
    )

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = rows_of(batches, *_FOUND.names)
        done = ((d, g, n, [{"begin": b, "end": e} for b, e in merged_ranges((x["begin"], x["end"]) for x in r)], i) for d, g, n, r, i in rows)
        return in_batches(done, _FOUND)

    return joined.mapInArrow(merge, _FOUND_DDL)
