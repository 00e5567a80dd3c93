"""Collocations: phrases of two to five words that hold together, by language, from one count of the longest windows.

Every word of every piece of text gives one window: the word and what follows it in its piece, at most
five words, with empty columns behind the end of the piece. Only these windows are
counted; the counts of all shorter phrases are sums over the last columns, which
Spark's ROLLUP gives. So each word is a row once, not once for each length of phrase.

A phrase with `least` occurrences is made of words, pairs and triples that occur `least` times. Windows
therefore end before a pair or triple that doesn't: a first pass counts words, pairs and triples in tables of 2^`bits` counters
by hash, one for each task, which are added up; where a counter stays below `least`, all that
share it are rare. Those that share a counter with others may pass without being frequent: that costs time,
but nothing is lost, and the counts of phrases are exact either way. The tables' size is fixed, whatever the input: a bit for
each counter goes to the tasks, 6 MB in all.

What a task gives out is its tables and each window that it meets, so both passes run in few long tasks, one for each core: with one
for each split of the input, tasks and frequent windows would both grow with the input, and the rows with their product. A task
gets about `JOINED` splits at most, so that none grows without end. It holds about `HELD` windows; when there are more, it gives out the
rarer half and goes on counting the others. Beyond some 2^`bits` x `least` words most counters are full and little is cut off.

Defined results: null and empty texts have no words, a null language is `und`, repeated rows and
null ids count like others, empty tables give no rows. Only `text` and `lang` are read, whatever
other columns there are. Texts are taken in parts of about `PART` bytes that end at white space, and counted in steps of about `STEP` words; the last
words of a step begin the next one, so that no window is cut by either.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epiloom.llm.common import rows_of, stored, utf8

LONGEST = 5
#: Up to so many words have counters.
COUNTED = 3
BITS = 24
STEP = 500_000
#: Distinct windows that a task holds.
HELD = 400_000
#: Splits of the input that one task reads at most.
JOINED = 16
PART = 1 << 20
#: Counters that travel as one row.
CHUNK = 1 << 16
_BREAK = b"\xff"  # no byte of UTF-8
#: A-Z in lower case, tabs as spaces, and what ends a piece as a byte of its own.
_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\n\v\f\r", b"abcdefghijklmnopqrstuvwxyz " + _BREAK * 10)
_COUNTERS = pa.schema([("kind", pa.int32()), ("chunk", pa.int32()), ("counters", pa.binary())])
_WINDOWS = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())])


class _Step(NamedTuple):
    """Words that are counted together: `ids` are places in `words`, 0 between pieces; the first `starts` of them start a window."""

    words: list[bytes]
    ids: np.ndarray
    langs: list[str]
    lang: np.ndarray
    starts: int


def _parts(text: bytes) -> Iterator[bytes]:
    """A text in parts that end before a space; a word that is longer stays whole."""
    at = 0
    while at < len(text):
        end = text.find(b" ", at + PART)
        end = len(text) if end < 0 else end
        yield text[at:end]
        at = end


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[_Step]:
    names: dict[str, int] = {}
    tokens: list[bytes] = []
    runs: list[tuple[int, int]] = []

    def step(starts: int) -> _Step:
        number = {w: i for i, w in enumerate(dict.fromkeys([_BREAK, *tokens]))}
        ids = np.fromiter(map(number.__getitem__, tokens), np.int64, len(tokens))
        lang = np.repeat(*(np.array(x, np.int64) for x in zip(*runs, strict=True)))
        return _Step(list(number), ids, list(names), lang, starts)

    for text, name in rows_of(batches, "text", "lang"):
        lang = names.setdefault(name, len(names))
        for part in _parts(text.translate(_TABLE)):
            found = part.replace(_BREAK, b" \xff ").split()
            tokens += found
            runs.append((lang, len(found)))
            if len(tokens) > STEP:
                done = step(len(tokens) - LONGEST)
                yield done
                tokens = tokens[-LONGEST:]
                runs = [(int(x), 1) for x in done.lang[-LONGEST:]]
        tokens.append(_BREAK)
        runs.append((lang, 1))
    if tokens:
        yield step(len(tokens))


def _mixed(x: np.ndarray, bits: int) -> np.ndarray:
    """`bits` bits of a hash of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(64 - bits)).astype(np.int64)


def _places(step: _Step, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For one, two and three words from each place on: their counter, and whether they are in one piece."""
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, step.words), np.uint64, len(step.words))[step.ids]
    tongue = np.fromiter((xxhash.xxh64_intdigest(x) for x in step.langs), np.uint64, len(step.langs))[step.lang]
    whole, sums = step.ids > 0, hashes
    out = [(_mixed(sums ^ tongue, bits), whole)]
    for j in range(1, COUNTED):
        sums = sums * np.uint64(3) + np.append(hashes[j:], np.zeros(min(j, len(hashes)), np.uint64))
        whole = whole & np.append(step.ids[j:] > 0, np.zeros(min(j, len(hashes)), bool))
        out.append((_mixed(sums ^ tongue, bits), whole))
    return out


def _marks(texts: DataFrame, least: int, bits: int) -> list[bytes]:
    """A bit for each counter that reaches `least`: of words, of pairs, of triples."""
    kind = np.uint16 if least <= 5000 else np.uint32

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros((COUNTED, 1 << bits), kind)
        for step in _steps(batches):
            for table, (at, whole) in zip(counters, _places(step, bits), strict=True):
                at = at[: step.starts][whole[: step.starts]]
                # Counters stop at `least`; so few are added at a time that none overflows.
                for i in range(0, len(at), 60_000):
                    some = at[i : i + 60_000]
                    np.add.at(table, some, kind(1))
                    table[some] = np.minimum(table[some], least)
        for k in range(COUNTED):
            for i in range(0, 1 << bits, CHUNK):
                some = counters[k, i : i + CHUNK]
                if some.any():
                    yield _row(k, i // CHUNK, zlib.compress(some.tobytes(), 1))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for k, i, packed in rows_of(batches, "kind", "chunk", "counters"):
            some = np.frombuffer(zlib.decompress(packed), kind).astype(np.uint32)
            sums[k, i] = np.minimum(sums[k, i] + some, least) if (k, i) in sums else some
        for (k, i), total in sums.items():
            yield _row(k, i, np.packbits(total >= least, bitorder="little").tobytes())

    layout = "kind int, chunk int, counters binary"
    added = texts.mapInArrow(count, layout).repartition("kind", "chunk").mapInArrow(add, layout)
    tables = np.zeros((COUNTED, max(1, (1 << bits) // CHUNK), min(CHUNK, 1 << bits) // 8), np.uint8)
    for row in added.collect():  # at most 2^bits / 8 bytes of each kind
        tables[row["kind"], row["chunk"]] = np.frombuffer(row["counters"], np.uint8)
    return [x.tobytes() for x in tables]


def _row(kind: int, chunk: int, packed: bytes) -> pa.RecordBatch:
    return pa.record_batch([pa.array([kind], pa.int32()), pa.array([chunk], pa.int32()), pa.array([packed], pa.binary())], schema=_COUNTERS)


def _windows(texts: DataFrame, least: int, bits: int) -> DataFrame:
    """lang, phrase (a window without its empty columns; empty if its first word is rare) and n, counted by task."""
    sent = texts.sparkSession.sparkContext.broadcast(_marks(texts, least, bits))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [np.frombuffer(x, np.uint8) for x in sent.value]
        held: dict[str, dict[bytes, int]] = {}

        def out(most: float) -> Iterator[pa.RecordBatch]:
            """Windows met up to `most` times; the others stay."""
            for lang, own in held.items():
                done = [x for x in own.items() if x[1] <= most]
                held[lang] = {k: n for k, n in own.items() if n > most}
                phrases = pa.array([k for k, _ in done], pa.binary()).cast(pa.string())
                yield pa.record_batch([pa.array([lang] * len(done), pa.string()), phrases, pa.array([n for _, n in done], pa.int64())], schema=_WINDOWS)

        for step in _steps(batches):
            often = [whole & (table[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool) for table, (at, whole) in zip(tables, _places(step, bits), strict=True)]
            at = np.flatnonzero(step.ids[: step.starts])
            if not len(at):
                continue
            inside = often[0][at]
            length = np.zeros(len(at), np.int64)
            many = len(step.words)
            key, first = step.lang[at], None
            for j in range(LONGEST):
                to = np.minimum(at + j, len(step.ids) - 1)
                for m in range(1, min(j + 1, COUNTED)):
                    inside = inside & often[m][to - m]
                length += inside
                column = np.where(inside, step.ids[to], 0)
                _, first, key, n = np.unique(key * many + column, return_index=True, return_inverse=True, return_counts=True)
            starts = zip(at[first].tolist(), length[first].tolist(), step.lang[at[first]].tolist(), n.tolist(), strict=True)
            for i, m, lang, times in starts:
                phrase = b" ".join([step.words[x] for x in step.ids[i : i + m].tolist()])
                own = held.setdefault(step.langs[lang], {})
                own[phrase] = own.get(phrase, 0) + times
            if sum(map(len, held.values())) > HELD:
                yield from out(np.median([n for own in held.values() for n in own.values()]))
        yield from out(np.inf)

    return texts.mapInArrow(count, "lang string, phrase string, n bigint")


def _in_few_tasks(texts: DataFrame) -> DataFrame:
    """Splits joined to one task for each core; more tasks where one would get above `JOINED` splits."""
    splits = texts.rdd.getNumPartitions()
    return texts.coalesce(max(texts.sparkSession.sparkContext.defaultParallelism, -(-splits // JOINED)))


def phrase_counts(docs: DataFrame, least: int = 100, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """lang, words, length, f of all phrases of up to five words with f of `least` or more; lang and n, its number of words."""
    texts = _in_few_tasks(docs.select(utf8(F.col("text")).alias("text"), F.coalesce(F.col("lang"), F.lit("und")).alias("lang")))
    windows = stored(_windows(texts, least, bits).groupBy("lang", "phrase").agg(F.sum("n").alias("n")), "windows")
    parts = F.split("phrase", " ", -1)
    columns = [f"w{i}" for i in range(1, LONGEST + 1)]
    padded = windows.select("lang", "n", *[F.coalesce(F.get(parts, F.lit(i)), F.lit("")).alias(c) for i, c in enumerate(columns)])
    rolled = padded.rollup("lang", *columns).agg(F.sum("n").alias("f"), F.grouping_id().alias("left_out"))
    # The last bits of the grouping id say which columns were summed over; the highest is that of lang.
    length = sum((F.when(F.col("left_out") < 1 << i, 1).otherwise(0) for i in range(LONGEST)), F.lit(0))
    sums = rolled.where(F.col("left_out") < 1 << LONGEST).withColumn("length", length)
    last = F.get(F.array(*columns), F.col("length") - 1)
    kept = sums.where((F.col("length") == 0) | (last != "") & (F.col("f") >= least))
    kept = stored(kept.select("lang", "length", F.slice(F.array(*columns), F.lit(1), F.col("length")).alias("words"), "f"), "phrases")
    return kept.where("length > 0"), kept.where("length = 0").select("lang", F.col("f").alias("n"))


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, dominance: int = 100, bits: int = BITS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the `top` phrases of each language.

    A phrase with a occurrences, cut into parts with l and r, scores floor(1000 a n / (l r)); its lowest cut counts, the first
    one of equal ones. Phrases inside a longer one that has `dominance` percent of their occurrences or more are left out.
    """
    phrases, totals = phrase_counts(docs, least, bits)
    known = phrases.select("lang", F.array_join("words", " ").alias("phrase"), "f")
    found = phrases.where("length > 1").select("lang", "words", "length", F.array_join("words", " ").alias("phrase"), F.col("f").alias("a"))

    def part(first: str, count: str) -> Column:
        return F.expr(f"array_join(slice(words, {first}, {count}), ' ')")

    cuts = found.withColumn("k", F.explode(F.expr("sequence(1, length - 1)")))
    cuts = cuts.select("lang", "phrase", "a", "k", part("1", "k").alias("head"), part("k + 1", "length - k").alias("rest"))
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    cuts = cuts.join(totals, "lang")
    a, n, l, r = (f"CAST({c} AS DECIMAL(19, 0))" for c in ("a", "n", "l", "r"))
    score = F.expr(f"CAST(1000 AS DECIMAL(38, 0)) * {a} * {n} DIV ({l} * {r})")
    least_cut = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    scored = cuts.groupBy("lang", "phrase", "a", "n").agg(least_cut)

    inner = F.expr(
        "flatten(transform(sequence(2, length - 1), m -> transform(sequence(1, length - m + 1), i -> array_join(slice(words, i, m), ' '))))"
    )
    outer = found.where("length > 2").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("f"))
    outer = outer.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    free = scored.join(outer, ["lang", "phrase"], "left").where(f"longer IS NULL OR 100 * longer < {dominance} * a")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase"))
    best = free.withColumn("rank", rank.cast("bigint")).where(F.col("rank") <= top)
    return best.select("lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", F.col("cut.score").cast("bigint").alias("score"))
