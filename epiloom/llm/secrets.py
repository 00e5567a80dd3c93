"""Secret scan: fixed patterns, and formats inferred from what they find.

Values that the patterns find are labelled credentials. A bounded sample of each
kind is turned into a probabilistic automaton (`automata`), samples of other tokens
into one for each mix of digits, letters by case and other characters. Every token
that can be a credential, outside what the patterns found, is then scored by how much
likelier the best credential automaton makes it than the best ordinary one.
What scores at least as high as nearly all held-out credentials do, and higher than
nearly all ordinary tokens, is a secret of the kind `format`.

The samples are the `sample` distinct values of each kind with the lowest hash,
over all documents; ordinary ones are taken from each mix in turn, those of several
documents first. The limit is set from the scores of all distinct tokens of
all documents, a token of n documents counting n - 1 times, so that a secret that
stands in one document doesn't pass as ordinary text. The scan reads all documents whole.

Nulls and odd rows: a null text is empty and holds nothing; rows that repeat give a
row each, and count as a document each; without any credential in the table only
the patterns count.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from epiloom.llm.automata import Automaton, symbols_of
from epiloom.llm.common import in_batches, rows_of, stored

SAMPLE = 1500
KINDS = ("assign", "access", "hex", "format")
#: The patterns and the least length of what they must find.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST = {"assign": 6, "access": 20, "hex": 24}
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: As short as the shortest credential of the patterns and of the same characters, but for dots at its ends.
_TOKEN = re.compile(r"[A-Za-z0-9+/_=-][A-Za-z0-9+/_.=-]{4,}[A-Za-z0-9+/_=-]")
_LONGEST_EXAMPLE = 200
_BUCKETS = 64
#: Of the ordinary tokens, counted by documents, at most one in so many reaches the limit.
_REJECTED = 100_000
_STEPS = 1000  # steps of the distribution of scores to 1
_HELD_TOKENS, _HELD_TEXT = 200_000, 1 << 26  # what a task counts before it hands on

Span = tuple[int, int, int]  # start, index of the kind, end


def base_matches(text: str) -> list[tuple[Span, str]]:
    """Spans that the patterns find and the credential in each, by start, then kind."""
    out: list[tuple[Span, str]] = []
    low = text.lower()
    if any(n in low for n in _NAMES):
        out += [((m.start(), 0, m.end()), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [((m.start(), 1, m.end()), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    out += [((m.start(), 2, m.end()), m[0]) for m in HEX.finditer(text)]
    return sorted(out)


def spans_text(spans: Iterable[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def candidates(text: str, base: list[Span]) -> Iterator[re.Match]:
    """Tokens outside the base spans."""
    for m in _TOKEN.finditer(text):
        if not any(s < m.end() and m.start() < e for s, _, e in base):
            yield m


def mix_of(symbols: str) -> int:
    """Which of digits, small letters, capitals and other characters a token holds, as bits."""
    held = set(symbols)
    return ("d" in held) + 2 * bool(held & {"f", "z"}) + 4 * bool(held & {"U", "Z"}) + 8 * bool(held - set("dfzUZ"))


class Model(NamedTuple):
    credentials: list[Automaton]
    ordinary: dict[int, Automaton]  # by mix
    least: float
    known: dict[str, bool]  # symbols that were judged already

    def score(self, token: str) -> float:
        return self.score_symbols(symbols_of(token))

    def score_symbols(self, symbols: str, least: float = math.inf) -> float:
        """The score, or any bound of it below `least`: most tokens need the ordinary automaton of their mix alone."""
        best = max(a.of_symbols(symbols) for a in self.credentials)
        own = self.ordinary.get(mix_of(symbols))
        if own and least < math.inf and (bound := best - own.of_symbols(symbols)) < least:
            return bound
        return best - max(a.of_symbols(symbols) for a in self.ordinary.values())

    def accepts(self, symbols: str) -> bool:
        found = self.known.get(symbols)
        if found is None:
            if len(self.known) >= _HELD_TOKENS:
                self.known.clear()
            found = self.known[symbols] = self.score_symbols(symbols, self.least) >= self.least
        return found

    def format_spans(self, text: str, base: list[Span]) -> list[Span]:
        """Tokens outside the base spans that look like credentials."""
        if not self.credentials:
            return []
        different = set(symbols_of("\n".join(set(_TOKEN.findall(text)))).split("\n")) - {""}
        if not any([self.accepts(x) for x in different]):
            return []
        return [(m.start(), 3, m.end()) for m in candidates(text, base) if self.accepts(symbols_of(m[0]))]


def token_counts(docs: DataFrame) -> DataFrame:
    """value, n_0 to n_3: all distinct credentials of each kind and tokens outside the patterns, and in how many documents they are."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            seen: list[Counter[str]] = [Counter() for _ in KINDS]
            read = 0
            for (text,) in rows_of(batches, "text"):
                base = base_matches(text)
                for kind, value in {(kind, value) for (_, kind, _), value in base}:
                    seen[kind][value] += 1
                spans = [s for s, _ in base]
                seen[3].update({m[0] for m in candidates(text, spans)} if base else set(_TOKEN.findall(text)))
                read += len(text)
                if read > _HELD_TEXT or len(seen[3]) > _HELD_TOKENS:
                    yield from ((v, k, n) for k, values in enumerate(seen) for v, n in values.items())
                    seen, read = [Counter() for _ in KINDS], 0
            yield from ((v, k, n) for k, values in enumerate(seen) for v, n in values.items())

        return in_batches(rows(), pa.schema([("value", pa.string()), ("kind", pa.int32()), ("n", pa.int64())]), 10_000)

    found = docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(count, "value string, kind int, n long")
    of_kind = [F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), F.lit(0)).alias(f"n_{k}") for k in range(len(KINDS))]
    return found.groupBy("value").agg(*of_kind)


def _lowest(kept: dict[str, tuple], limit: int) -> None:
    if len(kept) > 2 * limit:
        best = sorted(kept.items(), key=lambda x: (x[1], x[0]))[:limit]
        kept.clear()
        kept.update(best)


def examples(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """kind, value: of each kind the `sample` distinct values with the lowest hash; kind 3 are ordinary tokens."""
    return _examples(stored(token_counts(docs), "secret-tokens"), sample)


def _examples(counts: DataFrame, sample: int) -> DataFrame:
    def lowest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: defaultdict[tuple[int, int], dict[str, tuple]] = defaultdict(dict)
        for value, *n in rows_of(batches, "value", *(f"n_{k}" for k in range(len(KINDS)))):
            if len(value) > _LONGEST_EXAMPLE:
                continue
            crc = zlib.crc32(value.encode())
            for group in [(k, 0) for k in range(3) if n[k]] or [(3, mix_of(symbols_of(value)))]:
                kept[group][value] = (group[0] == 3 and n[3] < 2, crc)
                _lowest(kept[group], sample)
        rows = ((*g, v, *o) for g, values in sorted(kept.items()) for v, o in sorted(values.items(), key=lambda x: (x[1], x[0]))[:sample])
        names = [("kind", pa.int32()), ("mix", pa.int32()), ("value", pa.string()), ("once", pa.bool_()), ("hash", pa.int64())]
        return in_batches(rows, pa.schema(names))

    found = counts.mapInArrow(lowest, "kind int, mix int, value string, once boolean, hash long")
    # Two steps, so that no task gets what all tasks have kept.
    for by in (["kind", "mix", F.pmod(F.col("hash"), F.lit(_BUCKETS))], ["kind", "mix"]):
        order = Window.partitionBy(*by).orderBy("once", "hash", "value")
        found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= sample)
    in_turn = Window.partitionBy("kind").orderBy("rank", "hash", "value")  # at most 15 mixes of `sample` rows
    return found.withColumn("turn", F.row_number().over(in_turn)).where(F.col("turn") <= sample).select("kind", "value")


def fit(rows: Iterable[tuple[int, str]]) -> Model:
    """Automata from examples; of the credentials of a kind, two thirds teach and one third sets the limit."""
    by_kind: dict[int, tuple[list[str], list[str]]] = {k: ([], []) for k in range(3)}
    by_mix: defaultdict[int, list[str]] = defaultdict(list)
    for kind, value in sorted(rows):
        if kind == 3:
            by_mix[mix_of(symbols_of(value))].append(value)
        else:
            by_kind[kind][zlib.crc32(value.encode()) % 3 == 0].append(value)
    ordinary = {mix: Automaton(values) for mix, values in by_mix.items()} or {2: Automaton(["a"])}
    credentials = [Automaton(taught) for taught, _ in by_kind.values() if len(taught) >= 20]
    model = Model(credentials, ordinary, 0.0, {})
    if not credentials:
        return model
    held = sorted(model.score(v) for _, values in by_kind.values() for v in values)
    return model._replace(least=max(held[len(held) // 20] if held else 0.0, 0.0))


def score_counts(counts: DataFrame, model: Model) -> DataFrame:
    """step, n: the distribution of the scores of all tokens that are no labelled credentials, by documents beyond the first."""
    sent = counts.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps: Counter[int] = Counter()
        known: dict[str, int] = {}
        for value, n in rows_of(batches, "value", "n_3"):
            symbols = symbols_of(value)
            if symbols not in known:
                if len(known) >= _HELD_TOKENS:
                    known.clear()
                known[symbols] = math.floor(sent.value.score_symbols(symbols) * _STEPS)
            steps[known[symbols]] += n - 1
        return in_batches(iter(steps.items()), pa.schema([("step", pa.int64()), ("n", pa.int64())]))

    several = counts.where("n_3 > 1 AND n_0 + n_1 + n_2 = 0").select("value", "n_3")
    return several.mapInArrow(score, "step long, n long").groupBy("step").agg(F.sum("n").alias("n"))


def above(steps: Iterable[tuple[int, int]]) -> float:
    """The least score that at most one in `_REJECTED` of a distribution reaches."""
    ordered = sorted(steps, reverse=True)
    allowed = sum(n for _, n in ordered) // _REJECTED
    for step, n in ordered:
        allowed -= n
        if allowed < 0:
            return (step + 1) / _STEPS
    return 0.0


def fit_on(docs: DataFrame, sample: int = SAMPLE) -> Model:
    counts = stored(token_counts(docs), "secret-tokens")
    model = fit((r.kind, r.value) for r in _examples(counts, sample).collect())  # at most four times `sample` short strings
    if not model.credentials:
        return model
    high = above((r.step, r.n) for r in score_counts(counts, model).collect())  # a few thousand steps
    return model._replace(least=max(model.least, high))


_SPANS = pa.schema([("doc_id", pa.int64()), *((n, pa.int64()) for n in ("n_assign", "n_access", "n_hex")), ("base_sha256", pa.string()), ("spans", pa.string())])
_SPANS_DDL = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, counts by kind, digest of the base spans and all spans of each document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for doc_id, text in rows_of(batches, "doc_id", "text"):
                base = [s for s, _ in base_matches(text)]
                n = [sum(k == i for _, k, _ in base) for i in range(3)]
                everything = base + sent.value.format_spans(text, base)
                yield doc_id, *n, hashlib.sha256(spans_text(base).encode()).hexdigest(), spans_text(everything)

        return in_batches(rows(), _SPANS)

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(find, _SPANS_DDL)


def redacted(text: str, model: Model, mask: str) -> str:
    """The text with every secret replaced; of an assignment the whole match goes."""
    base = [s for s, _ in base_matches(text)]
    spans = sorted((s, e) for s, _, e in base + model.format_spans(text, base))
    out, at = [], 0
    for start, end in spans:
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, model: Model, mask: str = "[secret]") -> DataFrame:
    """The documents with all their columns and secrets masked in `text`; null texts stay null."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def masked(texts):  # noqa: ANN001, ANN202
        return texts.map(lambda t: t if t is None else redacted(t, sent.value, mask))

    return docs.withColumn("text", masked("text"))
