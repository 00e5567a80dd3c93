"""Temporal criteria on index events.

A criterion becomes a count column on the index events, a group of criteria a
boolean expression over those columns. All counts of a group come from one pass
(`ranges.count_in_ranges`), so a group costs the same shuffles however many
members it has.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epiloom.functions.dates import age_at
from epiloom.operators.codesets import match_codeset, match_codesets
from epiloom.operators.events import compare, domain_events, filter_age, filter_date, first_ever, longer_than
from epiloom.operators.observation import attach_observation, periods
from epiloom.operators.ranges import DayRange, count_in_ranges
from epiloom.sources.tables import Cdm, materialize


@dataclass(frozen=True)
class Comparison:
    """`op` is gt, gte, lt, lte, eq or bt (between value and extent)."""

    op: str
    value: int | date
    extent: int | date | None = None


@dataclass(frozen=True)
class EventQuery:
    """Which events of a domain a criterion is about."""

    domain: str
    codeset_id: int | None = None
    first: bool = False
    age: Comparison | None = None
    start: Comparison | None = None
    end: Comparison | None = None
    longer_than_days: int | None = None
    where: Group | None = None


@dataclass(frozen=True)
class Window:
    """Days around the index event; None is open (up to the period's edge).

    `from_index_end` measures from the index event's end date.
    """

    start: int | None = None
    end: int | None = None
    from_index_end: bool = False


@dataclass(frozen=True)
class Correlated:
    """So many events of a kind around the index event.

    `occurrence` is at_least, at_most or exactly. `window` bounds the start of
    the counted event, `end_window` its end. Unless `ignore_observation` holds
    the event must start in the index event's observation period.
    """

    query: EventQuery
    occurrence: str = "at_least"
    count: int = 1
    window: Window = Window()
    end_window: Window | None = None
    ignore_observation: bool = False


@dataclass(frozen=True)
class Demographic:
    """Age at the index event."""

    age: Comparison


@dataclass(frozen=True)
class Group:
    """ALL, ANY, AT_LEAST or AT_MOST (`count`) of its members."""

    kind: str
    members: tuple[Correlated | Demographic | Group, ...]
    count: int | None = None


def _plain(query: EventQuery) -> bool:
    """Nothing but a domain and a codeset."""
    return query.codeset_id is not None and query == EventQuery(query.domain, query.codeset_id)


class _Frames:
    """The events of a set of criteria. Plain queries of one domain share a frame, and so do equal queries; each is read once."""

    def __init__(self, cdm: Cdm, codesets: DataFrame | None, criteria: list[Correlated]) -> None:
        self.cdm, self.codesets = cdm, codesets
        self.wanted: dict[tuple[str, bool], set[int]] = {}
        for c in criteria:
            if _plain(c.query):
                self.wanted.setdefault((c.query.domain, _by_period(c)), set()).add(c.query.codeset_id)
        self.made: dict[tuple[str | EventQuery, bool], DataFrame] = {}

    def of(self, c: Correlated) -> tuple[DataFrame, tuple[str, int] | None]:
        """The events of a criterion, and the tag of its part of them."""
        if not _plain(c.query):
            one = c.query, _by_period(c)
            if one not in self.made:
                self.made[one] = self._settled(query_events(self.cdm, self.codesets, c.query), one[1])
            return self.made[one], None
        key = c.query.domain, _by_period(c)
        if key not in self.made:
            events = self.cdm.matched.get(c.query.domain)
            if events is None:
                events = match_codesets(domain_events(self.cdm, c.query.domain), self.codesets, sorted(self.wanted[key]))
            self.made[key] = self._settled(events, key[1])
        return self.made[key], ("codeset_id", c.query.codeset_id)

    def _settled(self, events: DataFrame, by_period: bool) -> DataFrame:
        """Where start and end must lie in one observation period, that is settled on the events."""
        if not by_period:
            return events
        return attach_observation(events, self.cdm.observation_period).filter("end_date <= op_end_date")


def query_events(cdm: Cdm, codesets: DataFrame | None, query: EventQuery) -> DataFrame:
    """The events a query asks for, in the common shape."""
    if query.domain in cdm.matched:
        events = cdm.matched[query.domain].filter(F.col("codeset_id") == (query.codeset_id or 0)).drop("codeset_id")
    else:
        events = domain_events(cdm, query.domain)
        if query.codeset_id is not None:
            events = match_codeset(events, codesets, query.codeset_id)
    if query.first:
        events = first_ever(events)
    if query.start is not None:
        events = filter_date(events, query.start.op, query.start.value, query.start.extent)
    if query.end is not None:
        events = filter_date(events, query.end.op, query.end.value, query.end.extent, "end_date")
    if query.longer_than_days is not None:
        events = longer_than(events, query.longer_than_days)
    if query.age is not None:
        events = filter_age(events, cdm.person, query.age.op, query.age.value, query.age.extent)
    if query.where is not None:
        events = nested(cdm, codesets, events, query.where)
    return events


def nested(cdm: Cdm, codesets: DataFrame | None, events: DataFrame, group: Group) -> DataFrame:
    """Events that, taken as index events of their own, meet a group.

    The events are stored: they are read twice, and a filter on the few that meet the group
    would otherwise be pushed below the match of their codeset, to all events of the domain.
    """
    events = materialize(events, "nested")
    own = events.join(periods(cdm.observation_period), "person_id").filter(
        F.col("start_date").between(F.col("op_start_date"), F.col("op_end_date"))
    )
    met = filter_group(cdm, codesets, own, group).select("person_id", "event_id").distinct()
    return events.join(met, ["person_id", "event_id"], "left_semi")


def _bound(window: Window, days: int | None) -> Column | None:
    if days is None:
        return None
    return F.date_add(F.col("end_date" if window.from_index_end else "start_date"), days)


def _tighter(pick, bound: Column | None, edge: Column | None) -> Column | None:
    if bound is None or edge is None:
        return edge if bound is None else bound
    return F.when(bound.isNotNull(), pick(bound, edge))  # an unknown day is no bound to fall back from


def _spans(c: Correlated) -> bool:
    """Started by some day and not over before another: the event meets those days."""
    w, e = c.window, c.end_window
    return (
        e is not None
        and w.start is None
        and e.end is None
        and w.end is not None
        and e.start is not None
        and e.start <= w.end + 1
        and w.from_index_end == e.from_index_end
    )


def _by_period(c: Correlated) -> bool:
    return _spans(c) and not c.ignore_observation


def _range(name: str, events: DataFrame, tag: tuple[str, int] | None, c: Correlated) -> DayRange:
    inside = not c.ignore_observation
    if _spans(c):
        cell = ("op_start_date", "op_end_date") if inside else None
        first, last = _bound(c.end_window, c.end_window.start), _bound(c.window, c.window.end)
        return DayRange(name, events, first, last, overlap=True, cell=cell, tag=tag)
    op_start = F.col("op_start_date") if inside else None
    op_end = F.col("op_end_date") if inside else None
    end_lower = end_upper = None
    if c.end_window is not None:
        w = c.end_window
        end_lower = op_start if w.start is None else _bound(w, w.start)
        end_upper = op_end if w.end is None else _bound(w, w.end)
    return DayRange(
        name,
        events,
        _tighter(F.greatest, _bound(c.window, c.window.start), op_start),
        _tighter(F.least, _bound(c.window, c.window.end), op_end),
        end_lower,
        end_upper,
        tag=tag,
    )


def _correlated(group: Group) -> list[Correlated]:
    found = []
    for m in group.members:
        if isinstance(m, Group):
            found += _correlated(m)
        elif isinstance(m, Correlated):
            found.append(m)
    return found


def _has_demographic(group: Group) -> bool:
    return any(
        isinstance(m, Demographic) or (isinstance(m, Group) and _has_demographic(m)) for m in group.members
    )


def _occurs(count: Column, c: Correlated) -> Column:
    return {"at_least": count >= c.count, "at_most": count <= c.count, "exactly": count == c.count}[c.occurrence]


def _meets(group: Group, names: dict[int, str]) -> Column:
    tests = []
    for m in group.members:
        if isinstance(m, Group):
            tests.append(_meets(m, names))
        elif isinstance(m, Demographic):
            age = age_at(F.col("start_date"), F.col("year_of_birth"))
            tests.append(compare(age, m.age.op, m.age.value, m.age.extent))
        else:
            tests.append(_occurs(F.col(names[id(m)]), m))
    if not tests:
        return F.lit(True)
    met = reduce(add, [F.coalesce(t, F.lit(False)).cast("int") for t in tests])
    return {
        "ALL": met == len(tests),
        "ANY": met > 0,
        "AT_LEAST": met >= (group.count or 0),
        "AT_MOST": met <= (group.count or 0),
    }[group.kind]


def add_groups(
    cdm: Cdm, codesets: DataFrame | None, index: DataFrame, groups: dict[str, Group], only: dict[str, int] | None = None
) -> DataFrame:
    """Index events plus one boolean column per named group.

    With `only`, the index events of several cohorts stand in one table, and the value for a group is the `cohort_definition_id` of the
    events that it is for; its column says nothing about others.

    The index events are stored before they are asked about: the counts read
    them twice, and definitions stack one group on another.
    """
    names: dict[int, str] = {}
    ranges = []
    criteria = [c for group in groups.values() for c in _correlated(group)]
    frames = _Frames(cdm, codesets, criteria)
    asked_by: dict[int, set[int]] = {}
    for name, cohort_id in (only or {}).items():
        for c in _correlated(groups[name]):
            asked_by.setdefault(id(c), set()).add(cohort_id)
    for c in criteria:
        if id(c) not in names:
            names[id(c)] = f"_count_{len(names)}"
            asks = F.col("cohort_definition_id").isin(sorted(asked_by[id(c)])) if only else None
            ranges.append(replace(_range(names[id(c)], *frames.of(c), c), only=asks))
    anchor = ["start_date", "op_start_date", "op_end_date", *(["cohort_definition_id"] if only else [])]
    windows = [w for g in groups.values() for c in _correlated(g) for w in (c.window, c.end_window) if w]
    if any(w.from_index_end for w in windows):
        anchor.insert(1, "end_date")
    if ranges:
        index = materialize(index, "index")
    known = count_in_ranges(index, ["person_id"], anchor, ranges)
    if any(_has_demographic(g) for g in groups.values()):
        known = known.join(cdm.person.select("person_id", "year_of_birth"), "person_id")
    return known.select(*index.columns, *[_meets(g, names).alias(name) for name, g in groups.items()])


def filter_group(cdm: Cdm, codesets: DataFrame | None, index: DataFrame, group: Group) -> DataFrame:
    """Index events that meet a group."""
    return add_groups(cdm, codesets, index, {"_met": group}).filter("_met").drop("_met")
