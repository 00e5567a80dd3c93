"""Toxicity: gradient-boosted trees over a few dense features, calibrated by isotonic regression.

The labelled sample is split by hash of the text. One half teaches the lexicon:
words, and stems of words, that are far more common in toxic texts than in others, next
to a short list of insults. Most of the other half teaches the trees, the
rest their calibration, so that no text teaches features and trees at once.

Features are densities of lexicon words and stems, how near they are to words of
the second person, capitals, punctuation and obfuscated spellings; digits and signs
that stand for letters are read as these letters first. Whole texts are read.

Nulls and odd rows: a null text is empty; empty texts get a score like any other;
without labels of both kinds every score is the share of toxic labels (0 without
labels); a document id that repeats is scored each time.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epiloom.llm.common import in_batches, rows_of, stored
from epiloom.llm.labelled import ROWS, sample

LEXICON_SIZE = 4000
LEAST_DOCUMENTS, LEAST_Z = 3, 3.0
NEAR = 5
#: Insults that count whatever the labels say, and words of the second person.
SEED = frozenset(
    "idiot idiots stupid moron morons loser losers scum trash worthless pathetic disgusting clown imbecile fool dumb jerk "
    "dumm idiotisch trottel depp abschaum stupide imbécile crétin débile salaud idiota estúpido imbécil tonto escoria basura".split()
)
SECOND_PERSON = frozenset(
    "you your yours yourself ya u ur du dich dir dein deine deiner ihr euch euer tu te toi ton ta tes vous votre vos "
    "tú ti contigo usted ustedes vosotros".split()
)
_LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": "", "|": "l"})
_TOKEN = re.compile(r"[\w@$*|]+(?:[!@$*|]+\w+)*")
_SEPARATED = re.compile(r"\b(?:[^\W\d_][ .\-_*]){3,}[^\W\d_]\b")
_RUN = re.compile(r"(.)\1{3,}", re.S)
_PUNCTUATION = re.compile(r"[^\w\s]")
STEMS = (4, 5, 6, 7)
NAMES = (
    "log_words", "lexicon_share", "lexicon_log", "lexicon_max", "lexicon_sum", "stem_share", "stem_log", "stem_max", "stem_sum", "person_share",
    "near_share", "nearest", "capitals", "capital_words", "exclamations", "punctuation", "obfuscated", "obfuscated_lexicon", "runs",
)


def words_of(text: str) -> tuple[list[str], list[bool]]:
    """Words in lower case, and whether each was spelt with digits or signs among letters."""
    words, odd = [], []
    for token in _TOKEN.findall(text.lower()):
        if token.isalpha():
            words.append(token)
            odd.append(False)
        elif any(c.isalpha() for c in token):
            words.append(token.translate(_LEET))
            odd.append(True)
    for m in _SEPARATED.findall(text.lower()) if "." in text or " " in text else ():
        words.append("".join(c for c in m if c.isalpha()))
        odd.append(True)
    return words, odd


def stems_of(word: str) -> list[str]:
    """Beginnings of a word, marked by a hyphen."""
    return [word[:k] + "-" for k in STEMS if len(word) > k]


def features(text: str, lexicon: dict[str, float]) -> list[float]:
    """The values of NAMES. `lexicon` holds weights of words, and of stems (which end in a hyphen)."""
    words, odd = words_of(text)
    n, size = max(1, len(words)), max(1, len(text))
    distinct = set(words)
    known = {w: lexicon[w] for w in distinct if w in lexicon}
    stems = {}
    for w in distinct:
        if len(w) > STEMS[0] and w not in known and (weight := max((lexicon.get(s, 0.0) for s in stems_of(w)), default=0.0)) > 0:
            stems[w] = weight
    people = [i for i, w in enumerate(words) if w in SECOND_PERSON] if distinct & SECOND_PERSON else []
    hits = [i for i, w in enumerate(words) if w in known] if known else []
    stem_hits = sum(w in stems for w in words) if stems else 0
    nearest, near, j = math.inf, 0, 0
    for i in hits:
        while j + 1 < len(people) and abs(people[j + 1] - i) <= abs(people[j] - i):
            j += 1
        d = abs(people[j] - i) if people else math.inf
        near += d <= NEAR
        nearest = min(nearest, d)
    letters = sum(map(str.isalpha, text))
    return [
        math.log1p(len(words)), len(hits) / n, math.log1p(len(hits)), max(known.values(), default=0.0),
        sum(known.values()) / math.sqrt(n), stem_hits / n, math.log1p(stem_hits),
        max(stems.values(), default=0.0), sum(stems.values()) / math.sqrt(n), len(people) / n,
        near / max(1, len(hits)), 1 / (1 + nearest), sum(map(str.isupper, text)) / max(1, letters),
        sum(len(w) > 1 and w.isupper() for w in text.split()) / n, text.count("!") / size, len(_PUNCTUATION.findall(text)) / size,
        sum(odd) / n, float(sum(o and w in known for w, o in zip(words, odd, strict=True))) if known else 0.0,
        len(_RUN.findall(text)) / n,
    ]


def learn_lexicon(texts: DataFrame, size: int = LEXICON_SIZE) -> dict[str, float]:
    """Words and stems of (text, y) that occur in many more toxic texts than others, with their log odds; at most `size`."""

    def terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts within the task, of its part of the bounded sample."""
        found: tuple[Counter[str], Counter[str]] = Counter(), Counter()
        for text, y in rows_of(batches, "text", "y"):
            distinct = set(words_of(text)[0])
            found[y > 0].update(distinct | {s for w in distinct for s in stems_of(w)})
        rows = ((term, float(found[1][term]), float(found[0][term])) for term in found[0].keys() | found[1].keys())
        return in_batches(rows, pa.schema([("term", pa.string()), ("a", pa.float64()), ("b", pa.float64())]), 20_000)

    totals = texts.agg(F.sum("y").alias("toxic"), F.count("*").alias("n")).first()
    toxic = totals.toxic or 0.0
    clean = totals.n - toxic
    counts = texts.mapInArrow(terms, "term string, a double, b double").groupBy("term").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    odds = F.log((F.col("a") + 0.5) / (toxic - F.col("a") + 0.5)) - F.log((F.col("b") + 0.5) / (clean - F.col("b") + 0.5))
    z = odds / F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5))
    best = counts.where(F.col("a") >= LEAST_DOCUMENTS).select("term", odds.alias("w"), z.alias("z")).where(F.col("z") >= LEAST_Z)
    learned = {r.term: r.w for r in best.orderBy(F.desc("z"), "term").limit(size).collect()}
    return {w: 5.0 for w in SEED} | learned


def with_features(docs: DataFrame, lexicon: dict[str, float], column: str = "features") -> DataFrame:
    """`docs` with the array of its texts' features in a further column."""
    sent = docs.sparkSession.sparkContext.broadcast(lexicon)  # at most LEXICON_SIZE words and the list above

    @F.pandas_udf("array<double>")
    def compute(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: features(t, sent.value))

    return docs.withColumn(column, compute(F.coalesce("text", F.lit(""))))


class Scorer:
    """Lexicon, trees and calibration; without trees all scores are `constant`."""

    def __init__(self, lexicon: dict[str, float], trees=None, calibration=None, constant: float = 0.0) -> None:  # noqa: ANN001
        self.lexicon, self.trees, self.calibration, self.constant = lexicon, trees, calibration, constant

    def score(self, docs: DataFrame) -> DataFrame:
        """All columns of `docs` (with text) and the score as `toxicity_score`."""
        if self.trees is None:
            return docs.withColumn("toxicity_score", F.lit(self.constant))
        raw = _raw(self.trees, with_features(docs, self.lexicon, "toxicity_features"), "toxicity_features")
        if self.calibration is None:
            return raw.select(*docs.columns, F.col("toxicity_raw").alias("toxicity_score"))
        return self.calibration.transform(raw).select(*docs.columns, "toxicity_score")


def _raw(trees, rows: DataFrame, column: str) -> DataFrame:  # noqa: ANN001
    scored = trees.transform(rows.withColumn("toxicity_vector", array_to_vector(column)))
    return scored.withColumn("toxicity_raw", vector_to_array("toxicity_probability")[1])


def _kinds(rows: DataFrame) -> int:
    return rows.select("y").distinct().count()


def fit(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "toxic", rows: int = ROWS, trees: int = 20, depth: int = 3) -> Scorer:
    """Learn from the labels that `learn` (on labels) holds for, from about `rows` of them at most."""
    texts = sample(docs, labels, label, learn, rows)
    share = texts.agg(F.avg("y")).first()[0] or 0.0
    lexicon = learn_lexicon(texts.where("part < 50"))
    taught = with_features(texts.where("part >= 50"), lexicon).select("part", "y", "features")
    taught = stored(taught.coalesce(8), "toxicity-features")
    for_trees, for_calibration = taught.where("part < 85"), taught.where("part >= 85")
    if _kinds(for_trees) < 2:
        return Scorer(lexicon, constant=share)
    learner = GBTClassifier(
        featuresCol="toxicity_vector", labelCol="y", predictionCol="toxicity_label", maxIter=trees, maxDepth=depth, maxBins=64, stepSize=0.3, seed=1
    )
    learner = learner.setProbabilityCol("toxicity_probability").setRawPredictionCol("toxicity_margins")
    boosted = learner.fit(for_trees.coalesce(4).withColumn("toxicity_vector", array_to_vector("features")))
    calibration = None
    if _kinds(for_calibration) == 2:
        calibration = IsotonicRegression(featuresCol="toxicity_raw", labelCol="y", predictionCol="toxicity_score")
        calibration = calibration.fit(_raw(boosted, for_calibration, "features"))
    return Scorer(lexicon, boosted, calibration, share)
