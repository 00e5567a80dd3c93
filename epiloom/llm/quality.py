"""Quality: a factorisation machine over hashed words, structure of the text and its length.

A text becomes a sparse vector: words hashed into `DIMENSIONS` places, and for each
statistic its value and the one of eight ranges it falls in. The model adds a
weight for each place and, for each pair of places, the product of their two
short vectors. The sum over all pairs is half of (square of the sum - sum of
the squares) in each of the vectors' dimensions, so scoring takes time in
proportion to the text.

The labelled sample is bounded by FIT_ROWS; the driver fits the weights to its sparse
vectors. Whole texts are read. Only the text and its length are inputs.

Nulls and odd rows: a null text is empty and scored like one; without labels of
both kinds every score is the share of good labels (0 without labels); a document
id that repeats is scored each time.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epiloom.llm.common import in_batches, rows_of
from epiloom.llm.labelled import sample

DIMENSIONS = 1 << 12
RANGES = 8
FIT_ROWS = 8000
_JUNK = re.compile(r"([^\w\s])\1{1,}")
_WORD = re.compile(r"[^\W\d_]+")
STATISTICS = (
    "length", "words", "word_length", "capitals", "capital_words", "digits", "signs", "runs_of_signs", "exclamations", "bars",
    "distinct_words", "repeats_in_a_row", "commonest_word", "lines", "short_lines", "repeated_lines", "ends_of_sentences",
)
SIZE = DIMENSIONS + len(STATISTICS) * (RANGES + 1)


def statistics(text: str) -> list[float]:
    """The values of STATISTICS, each between 0 and 1."""
    n = max(1, len(text))
    tokens = text.split()
    m = max(1, len(tokens))
    lines = [x for x in text.split("\n") if x.strip()]
    counts = Counter(tokens)
    letters = sum(map(str.isalpha, text))
    values = [
        math.log1p(len(text)) / 14, math.log1p(len(tokens)) / 12, (n - m) / m / 15, sum(map(str.isupper, text)) / max(1, letters),
        sum(len(t) > 1 and t.isupper() for t in tokens) / m, sum(map(str.isdigit, text)) / n,
        sum(not c.isalnum() and not c.isspace() for c in text) / n, len(_JUNK.findall(text)) / m, text.count("!") / m, tokens.count("|") / m,
        len(counts) / m, sum(a == b for a, b in zip(tokens, tokens[1:], strict=False)) / m, max(counts.values(), default=0) / m,
        len(lines) / m, sum(len(x) < 20 for x in lines) / max(1, len(lines)), 1 - len(set(lines)) / max(1, len(lines)),
        sum(t[-1] in ".?!" for t in tokens) / m,
    ]
    return [min(1.0, max(0.0, v)) for v in values]


def vector_of(text: str) -> tuple[list[int], list[float]]:
    """Places in order and their values."""
    words = Counter(_WORD.findall(text.lower()))
    at: dict[int, float] = {}
    for word, n in words.items():
        place = zlib.crc32(word.encode()) % DIMENSIONS
        at[place] = at.get(place, 0.0) + 1 + math.log(n)
    norm = math.sqrt(sum(v * v for v in at.values())) or 1.0
    at = {k: v / norm for k, v in at.items()}
    for i, v in enumerate(statistics(text)):
        base = DIMENSIONS + i * (RANGES + 1)
        at[base] = v
        at[base + 1 + min(RANGES - 1, int(v * RANGES))] = 1.0
    places = sorted(at)
    return places, [at[k] for k in places]


class Machine:
    """Intercept, linear weights and vectors of a fitted machine; without weights all scores are `constant`."""

    def __init__(self, constant: float, intercept: float = 0.0, linear: np.ndarray | None = None, factors: np.ndarray | None = None) -> None:
        self.constant, self.intercept, self.linear, self.factors = constant, intercept, linear, factors

    def raw(self, x: Sparse) -> tuple[np.ndarray, np.ndarray]:
        """Log odds, and the sums of the places' vectors, of each sparse vector (none of them empty)."""
        weighted = self.factors[x.places] * x.values[:, None]
        begins = x.begins[:-1]
        sums = np.add.reduceat(weighted, begins)
        pairs = (sums**2 - np.add.reduceat(weighted**2, begins)).sum(axis=1) / 2
        return self.intercept + np.add.reduceat(self.linear[x.places] * x.values, begins) + pairs, sums

    def scores(self, vectors: list[tuple[list[int], list[float]]]) -> np.ndarray:
        """Probability of label 1 of each vector."""
        if self.linear is None or not vectors:
            return np.full(len(vectors), self.constant)
        places = np.concatenate([np.array(p, np.int64) for p, _ in vectors])
        values = np.concatenate([np.array(v, float) for _, v in vectors])
        raw, _ = self.raw(Sparse(places, values, np.cumsum([0, *(len(p) for p, _ in vectors)])))
        return 1 / (1 + np.exp(-np.clip(raw, -500, 500)))


class Sparse(NamedTuple):
    """Vectors one behind the other."""

    places: np.ndarray
    values: np.ndarray
    begins: np.ndarray  # one more than there are vectors

    def take(self, rows: np.ndarray) -> Sparse:
        sizes = self.begins[rows + 1] - self.begins[rows]
        begins = np.concatenate([[0], np.cumsum(sizes)])
        at = np.arange(begins[-1]) + np.repeat(self.begins[rows] - begins[:-1], sizes)
        return Sparse(self.places[at], self.values[at], begins)


def train(x: Sparse, y: np.ndarray, factors: int, rounds: int, step: float, batch: int = 256) -> Machine:
    """Logistic loss, by Adam over batches in a fixed random order."""
    rng = np.random.Generator(np.random.PCG64(1))
    weights = np.concatenate([np.zeros((SIZE + 1, 1)), rng.normal(0, 0.05, (SIZE + 1, factors))], axis=1)  # last row: the intercept
    mean, square, t = np.zeros_like(weights), np.zeros_like(weights), 0
    share = min(0.999, max(0.001, float(y.mean())))
    weights[-1, 0] = math.log(share / (1 - share))
    for _ in range(rounds):
        order = rng.permutation(len(y))
        for k in range(0, len(y), batch):
            rows = np.sort(order[k : k + batch])
            part = x.take(rows)
            machine = Machine(share, weights[-1, 0], weights[:-1, 0], weights[:-1, 1:])
            raw, sums = machine.raw(part)
            error = np.repeat((1 / (1 + np.exp(-np.clip(raw, -500, 500))) - y[rows]) / len(rows), np.diff(part.begins))
            gradient = np.zeros_like(weights)
            pull = error * part.values
            gradient[:-1, 0] = np.bincount(part.places, pull, SIZE)
            gradient[-1, 0] = (error / np.repeat(np.diff(part.begins), np.diff(part.begins))).sum()
            per_place = np.repeat(sums, np.diff(part.begins), axis=0) - weights[part.places, 1:] * part.values[:, None]
            for f in range(factors):
                gradient[:-1, 1 + f] = np.bincount(part.places, pull * per_place[:, f], SIZE)
            t += 1
            mean += 0.1 * (gradient - mean)
            square += 0.001 * (gradient * gradient - square)
            weights -= step * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.999**t)) + 1e-8)
    return Machine(share, weights[-1, 0], weights[:-1, 0].copy(), weights[:-1, 1:].copy())


def fit(
    docs: DataFrame, labels: DataFrame, learn: Column, label: str = "quality", rows: int = FIT_ROWS,
    factors: int = 4, rounds: int = 12, step: float = 0.02,
) -> Machine:
    """Learn from the labels that `learn` (on labels) holds for, from about `rows` of them at most.

    Tasks make the vectors; the driver gets those of the sample, whose size `rows` bounds.
    """

    def vectors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("y", pa.float64()), ("places", pa.list_(pa.int32())), ("values", pa.list_(pa.float32()))])
        return in_batches(((y, *vector_of(text)) for text, y in rows_of(batches, "text", "y")), schema)

    texts = sample(docs, labels, label, learn, rows)
    found = texts.select("text", "y").mapInArrow(vectors, "y double, places array<int>, values array<float>").toArrow()
    y = np.array(found.column("y"), float)
    if len(set(y.tolist())) < 2:
        return Machine(float(y.mean()) if len(y) else 0.0)
    places = found.column("places").combine_chunks()
    x = Sparse(
        places.flatten().to_numpy().astype(np.int64), found.column("values").combine_chunks().flatten().to_numpy().astype(float),
        np.concatenate([[0], np.cumsum(places.value_lengths().to_numpy())]),
    )
    # By the vectors themselves, so that the result doesn't depend on how the sample lay in partitions.
    key = np.add.reduceat(x.values * (x.places + 1.0), x.begins[:-1])
    order = np.lexsort((y, key))
    return train(x.take(order), y[order], factors, rounds, step)


def score(texts: DataFrame, machine: Machine) -> DataFrame:
    """doc_id and score of (doc_id, text)."""
    sent = texts.sparkSession.sparkContext.broadcast(machine)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = sent.value.scores([vector_of(t or "") for t in batch.column("text").to_pylist()])
            yield pa.record_batch([batch.column("doc_id").cast(pa.int64()), pa.array(found, pa.float64())], schema=schema)

    return texts.select("doc_id", "text").mapInArrow(scored, "doc_id long, score double")
