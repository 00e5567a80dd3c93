"""Counting and finding events in a range of days around an anchor, without pairs.

An anchor (an index event, a cohort entry) asks how many events of the same
person start in [lower, upper]. Joining the two sides would emit every pair a
person has. Instead events are first counted per person and day, anchors are
reduced to distinct ones, both are put on one time line, and the answer is a
difference of two running sums. A window group then holds at most one row per
day and distinct anchor, however many rows the person has.

Events that meet a range of days are those begun by its last day less those
over before its first: two running sums again. For that an event must not end before
it starts; those that do have no day in any range. Only a range of end days that is
independent of the start days needs more: its count is a sum over the four corners of
a rectangle of start and end days, each answered by one sweep over a person's distinct
days (`dominance`). A range of end days alone is answered by running sums.

A comparison with a missing date holds for nothing: events without the dates a
question is about are left out, and an anchor without the date of a bound counts 0.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epiloom.operators.dominance import count_dominated

_EPOCH_SHIFT = 719_162  # makes day numbers of years 1 to 9999 non-negative
# Above every day number: 9999-12-31 is 3,652,058.
_PAST_ALL = 1 << 22
# Ranges whose probes one step makes: Java compiles no generated method above 8,000 bytes, and interprets it many times slower.
_TOGETHER = 4


@dataclass(frozen=True)
class DayRange:
    """One question: events with start day in [lower, upper], per anchor.

    Bounds are date columns of the anchor side; None leaves a side open. With
    `end_lower` or `end_upper` the event's end day must lie in that range too.
    `overlap` asks for events whose [start, end] meets [lower, upper] instead;
    `lower` may be up to one day after `upper` then (an event that spans both).
    `cell` names two date columns that must be equal on both sides, such as the
    edges of an observation period; without it events of all cells count.
    `tag` names a column and the value it must have: questions about different
    parts of one frame then share a single pass over it.
    `only` says which anchors ask at all; the others count 0 and add nothing to the time line.
    """

    name: str
    events: DataFrame
    lower: Column | None
    upper: Column | None
    end_lower: Column | None = None
    end_upper: Column | None = None
    overlap: bool = False
    cell: tuple[str, str] | None = None
    tag: tuple[str, int] | None = None
    only: Column | None = None
    start: str = "start_date"
    end: str = "end_date"

    @property
    def by_end(self) -> bool:
        return self.end_lower is not None or self.end_upper is not None


def _given(*dates: Column | str | None) -> Column:
    """None of these dates is missing; those that are no part of a question count as given."""
    known = F.lit(True)
    for d in dates:
        if d is not None:
            known = known & (F.col(d) if isinstance(d, str) else d).isNotNull()
    return known


def _day(value: Column | None, missing: int) -> Column:
    return F.lit(missing) if value is None else F.unix_date(value) + _EPOCH_SHIFT


def _row(question: int, r: DayRange, day: Column, end: Column | None, celled: bool, **more: Column) -> Column:
    """A row of the time line without its keys; `node` and `other` are the cell, where any question has one."""
    cell = [] if not celled else [F.lit(0), F.lit(0)] if r.cell is None else [F.unix_date(c) for c in r.cell]
    cell = [c.cast("int").alias(name) for c, name in zip(cell, ("node", "other"))]
    end = F.lit(None) if end is None else end
    more_ = [c.alias(name) for name, c in more.items()]
    return F.struct(F.lit(question).alias("question"), *cell, day.cast("int").alias("day"), end.cast("int").alias("_end"), *more_)


def _corners(r: DayRange, asks: Column) -> list[tuple[Column, Column, Column]]:
    """The corners (start day, end day, sign) whose signed counts are the events with both days in their ranges; an empty range has none."""
    for first, last in ((r.lower, r.upper), (r.end_lower, r.end_upper)):
        if first is not None and last is not None:
            asks = asks & (first <= last)
    sides = [
        [(_day(last, _PAST_ALL), 1)] + ([] if first is None else [(_day(first, 0) - 1, -1)])
        for first, last in ((r.lower, r.upper), (r.end_lower, r.end_upper))
    ]
    return [
        (F.when(asks, start).otherwise(0), F.when(asks, end).otherwise(0), F.when(asks, one * other).otherwise(0))
        for start, one in sides[0]
        for end, other in sides[1]
    ]


def count_in_ranges(index: DataFrame, keys: list[str], anchor: list[str], ranges: list[DayRange]) -> DataFrame:
    """`index` plus one count column per range.

    `keys` link the two sides; bounds may use `keys` and `anchor` columns only.
    All ranges share one pass over the time line. Anchors may be null. The
    plan reads `index` twice; store it first if it is costly.
    """
    if not ranges:
        return index
    answered = counts_of_anchors(index.select(*keys, *anchor).distinct(), keys, anchor, ranges)
    return _with_answers(index, answered, keys, anchor, [r.name for r in ranges], all(r.only is None for r in ranges))


def _with_answers(index: DataFrame, answered: DataFrame, keys: list[str], anchor: list[str], names: list[str], all_ask: bool) -> DataFrame:
    """Each index row with the answers of its anchor; missing dates are equal to each other here, and anchors that ask nothing count 0."""
    renamed = answered.select(*[F.col(c).alias(f"_at_{c}") for c in (*keys, *anchor)], *names)
    same = [F.col(k) == F.col(f"_at_{k}") for k in keys] + [F.col(c).eqNullSafe(F.col(f"_at_{c}")) for c in anchor]
    if all_ask:
        return index.join(renamed, same).select(*index.columns, *names)
    return index.join(renamed, same, "left").select(*index.columns, *[F.coalesce(n, F.lit(0)).alias(n) for n in names])


def counts_of_anchors(anchors: DataFrame, keys: list[str], anchor: list[str], ranges: list[DayRange]) -> DataFrame:
    """The counts for distinct anchors: (keys, anchor, one column per range).

    What events add to the time line depends on their frame, part, cell and dates only, not
    on the bounds: ranges that agree in these ask the same question, whose rows are there once.
    """
    celled = any(r.cell is not None for r in ranges)
    asked: list[list[Column]] = []
    questions: dict[tuple, int] = {}
    parts: dict[int, list[Column]] = {}  # by frame: what a row of it adds to the time line
    frames: dict[int, DataFrame] = {}
    swept = False

    def question(r: DayRange, known: Column, condition: tuple, day: str, end: str | None = None) -> int:
        key = id(r.events), r.tag, r.cell, condition, day, end
        if key not in questions:
            questions[key] = len(questions)
            frames[id(r.events)] = r.events
            row = _row(questions[key], r, _day(F.col(day), 0), None if end is None else _day(F.col(end), 0), celled)
            parts.setdefault(id(r.events), []).append(F.when(known, row))
        return questions[key]

    for i, r in enumerate(ranges):
        dated = (r.start, r.end) if r.by_end or r.overlap else (r.start,)
        known = _given(*dated)
        if r.overlap:
            known = known & (F.col(r.end) >= F.col(r.start))
        if r.tag is not None:
            known = known & (F.col(r.tag[0]) == r.tag[1])
        condition = (*dated, r.overlap)
        # An open range of start days leaves the end days, which take the same way.
        by_end_only = r.by_end and r.lower is None and r.upper is None
        day = r.end if by_end_only else r.start
        first, last = (r.end_lower, r.end_upper) if by_end_only else (r.lower, r.upper)
        both = r.by_end and not by_end_only
        mine = question(r, known, condition, day, r.end if both else None)
        asks = _given(r.lower, r.upper, r.end_lower, r.end_upper)
        if both:
            probes = [(mine, *corner) for corner in _corners(r, asks)]
            swept = True
        else:
            probes = [(mine, _day(last, _PAST_ALL), None, F.when(asks, 1).otherwise(0))]
            if first is not None:
                # of an overlap: started by `upper`, less those over before `lower`
                under = question(r, known, condition, r.end) if r.overlap else mine
                probes.append((under, _day(first, 0) - 1, None, F.when(asks, -1).otherwise(0)))
        ends = [_row(q, r, at, end, celled, sign=sign, answer=F.lit(i)) for q, at, end, sign in probes]
        asked.append(ends if r.only is None else [F.when(r.only, row) for row in ends])
    where = ["question", *(["node", "other"] if celled else [])]
    at = [F.col(f"m.{c}") for c in (*where, "day", "_end")]
    counted = [
        _exploded(frames[k], keys, adds, "m").groupBy(*keys, *at).agg(F.count(F.lit(1)).alias("n"))
        for k, adds in parts.items()
    ]

    def probing(first: int) -> DataFrame:
        only = [r.only for r in ranges[first : first + _TOGETHER]]
        asking = anchors if any(o is None for o in only) else anchors.filter(reduce(lambda a, b: a | b, only))
        ends = [row for rows in asked[first : first + _TOGETHER] for row in rows]
        return _exploded(asking, [*keys, *anchor], ends, "p").select(*keys, *anchor, "p.*")

    probes = reduce(DataFrame.unionByName, map(probing, range(0, len(ranges), _TOGETHER)))
    line = probes.filter("_end is null").drop("_end").withColumn("n", F.lit(0).cast("long"))
    for rows in counted:
        line = line.unionByName(rows.filter("_end is null").drop("_end"), allowMissingColumns=True)
    running = F.sum("n").over(Window.partitionBy(*keys, *where).orderBy("day"))
    upto = line.withColumn("upto", running).filter("answer is not null").select(*keys, *anchor, "answer", "sign", "upto")
    if swept:
        upto = upto.unionByName(_swept(probes, counted, keys, anchor, where))
    return upto.groupBy(*keys, *anchor).agg(
        *[
            F.greatest(
                F.coalesce(F.sum(F.when(F.col("answer") == i, F.col("sign") * F.col("upto"))), F.lit(0)), F.lit(0)
            ).alias(r.name)
            for i, r in enumerate(ranges)
        ]
    )


def _exploded(df: DataFrame, keys: list[str], rows: list[Column], name: str) -> DataFrame:
    """`keys` and each of `rows` that is not null, as rows of their own."""
    return df.select(*keys, F.explode(F.array(*rows)).alias(name)).filter(F.col(name).isNotNull())


def _swept(probes: DataFrame, counted: list[DataFrame], keys: list[str], anchor: list[str], where: list[str]) -> DataFrame:
    """The counts of the corners; names of keys and anchors are set aside, as they may be any."""
    group = [f"_k{i}" for i in range(len(keys))]
    held = [f"_a{i}" for i in range(len(anchor))]
    named = [F.col(k).alias(g) for k, g in zip(keys, group)]
    days = [F.col("day").alias("x"), F.col("_end").alias("y")]
    points = reduce(
        DataFrame.unionByName, [rows.filter("_end is not null").select(*named, *where, *days, "n") for rows in counted]
    )
    corners = probes.filter("_end is not null").select(
        *named, *where, *days, *[F.col(a).alias(h) for a, h in zip(anchor, held)], "answer", "sign"
    )
    below = count_dominated(points, corners, [*group, *where], [*held, "answer", "sign"])
    back = [F.col(c).alias(n) for c, n in zip((*group, *held), (*keys, *anchor))]
    return below.select(*back, "answer", "sign", F.col("below").alias("upto"))


@dataclass(frozen=True)
class Nearest:
    """One question: the first or last event date in anchor + [lower, upper] days."""

    name: str
    events: DataFrame
    date: str
    lower: int | None
    upper: int | None
    which: str


def nearest_in_ranges(index: DataFrame, keys: list[str], anchor: str, questions: list[Nearest]) -> DataFrame:
    """`index` plus one date column per question, null where there is no event.

    Works on distinct days of both sides, all questions in one pass. Events without a
    date are left out, and rows without an anchor have no answers. A question
    for the first event runs on negated days, so that every answer is the last
    day at or before a probe.
    """
    hits, probes = [], []
    for i, q in enumerate(questions):
        sign = 1 if q.which == "last" else -1
        day = (F.unix_date(q.date) * sign).alias("day")
        hits.append(q.events.filter(F.col(q.date).isNotNull()).select(*keys, F.lit(i).alias("question"), day, day.alias("hit")).distinct())
        edge = q.upper if q.which == "last" else q.lower
        at = F.lit(_PAST_ALL) if edge is None else (F.unix_date("_anchor") + edge) * sign
        probes.append(F.struct(F.lit(i).alias("question"), at.alias("day")))
    anchors = index.select(*keys, F.col(anchor).alias("_anchor")).filter("_anchor is not null").distinct()
    line = anchors.select(*keys, "_anchor", F.explode(F.array(*probes)).alias("p")).select(*keys, "_anchor", "p.*")
    for rows in hits:
        line = line.unionByName(rows, allowMissingColumns=True)
    latest = F.max("hit").over(Window.partitionBy(*keys, "question").orderBy("day"))
    answers = []
    for i, q in enumerate(questions):
        sign = 1 if q.which == "last" else -1
        hit = F.max(F.when(F.col("question") == i, F.col("latest"))) * sign
        far = q.lower if q.which == "last" else q.upper
        if far is not None:
            limit = F.unix_date("_anchor") + far
            hit = F.when(hit >= limit if q.which == "last" else hit <= limit, hit)
        answers.append(F.date_from_unix_date(hit).alias(q.name))
    found = (
        line.withColumn("latest", latest)
        .filter("_anchor is not null")
        .groupBy(*keys, "_anchor")
        .agg(*answers)
        .withColumnRenamed("_anchor", anchor)
    )
    return index.join(found, [*keys, anchor], "left").select(*index.columns, *[q.name for q in questions])
