"""Many cohort definitions in one pass over the data.

Built one after the other, definitions read the same tables again and again. Here all their
questions are put together: each domain's table is read once and joined once to the codesets of all definitions
that ask for it, and what matches is stored; entry events of all definitions are one table, with the
definition as a column; all criteria of all definitions are answered on one time line per person, where an
index event asks only the questions of its own definition, and those of definitions without criteria stay out of it;
limits, exits and eras are keyed by definition and person.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import fields, is_dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epiloom.operators.criteria import Correlated, EventQuery, Group, add_groups, query_events
from epiloom.operators.eras import era_collapse
from epiloom.operators.events import domain_events, first_rows
from epiloom.operators.observation import periods
from epiloom.plans.cohorts import ORDER, CohortSpec, share_codesets
from epiloom.sources.tables import Cdm, materialize

KEYS = ["cohort_definition_id", "person_id"]
#: Definitions whose questions share a pass; each question is a column there.
TOGETHER = 40


def queries_of(part) -> Iterator[EventQuery]:
    """All event queries in a definition, at any depth."""
    if isinstance(part, EventQuery):
        yield part
    if isinstance(part, tuple):
        for p in part:
            yield from queries_of(p)
    elif isinstance(part, (CohortSpec, EventQuery, Correlated, Group)) and is_dataclass(part):
        for f in fields(part):
            yield from queries_of(getattr(part, f.name))


def matched_events(cdm: Cdm, codesets: DataFrame | None, queries: list[EventQuery]) -> dict[str, DataFrame]:
    """By domain, the events that any query can be about, with `codeset_id` (0: all events), from one scan of its table.

    Rows are stored in the order of the codesets, so that a query reads the row groups of its own. A whole domain that one
    query asks for is not: it would be a copy of the table, with columns that the query may not need.
    """
    wanted: dict[str, list[int]] = {}
    for q in queries:
        wanted.setdefault(q.domain, []).append(q.codeset_id or 0)
    out = {}
    for domain, users in sorted(wanted.items()):
        ids = set(users)
        events = domain_events(cdm, domain)
        if users == [0]:
            out[domain] = events.withColumn("codeset_id", F.lit(0))
            continue
        if ids == {0}:
            tagged = events.withColumn("codeset_id", F.lit(0))
        else:
            sets = codesets.where(F.col("codeset_id").isin(sorted(ids))).groupBy(F.col("concept_id").alias("target_concept_id"))
            sets = sets.agg(F.collect_set(F.col("codeset_id").cast("int")).alias("_sets"))
            every = F.array(F.lit(0)) if 0 in ids else F.array().cast("array<int>")
            joined = events.join(sets, "target_concept_id", "left" if 0 in ids else "inner")
            tags = F.concat(every, F.coalesce("_sets", F.array().cast("array<int>")))
            tagged = joined.select(*events.columns, F.explode(tags).alias("codeset_id"))
        out[domain] = materialize(tagged.sortWithinPartitions("codeset_id"), f"matched-{domain}")
    return out


def _by_cohort(specs: list[CohortSpec], value) -> Column:
    """A value of each definition, as an expression over `cohort_definition_id`."""
    found = None
    for s in specs:
        here = F.col("cohort_definition_id") == s.cohort_id
        found = F.when(here, value(s)) if found is None else found.when(here, value(s))
    return found


def _limited(events: DataFrame, first: list[int]) -> DataFrame:
    """The first event of each person in the definitions of `first`, all events of the others, which no aggregate sees.

    `events` is read twice where there are both kinds.
    """
    if not first:
        return events
    limited = F.col("cohort_definition_id").isin(first)
    return first_rows(events.filter(limited), KEYS, ORDER).unionByName(events.filter(~limited))


def _groups(spec: CohortSpec) -> list[Group]:
    return [g for g in (spec.additional, *spec.rules) if g is not None]


def primary_rows(cdm: Cdm, codesets: DataFrame | None, specs: list[CohortSpec]) -> DataFrame:
    """Events of all primary queries with the observation periods of their person, stored; `_asked` says which query.

    An event is joined and stored once, however many definitions begin with its query.
    """
    asked = dict.fromkeys(q for s in specs for q in s.primary)
    parts = [query_events(cdm, codesets, q).withColumn("_asked", F.lit(k)) for k, q in enumerate(asked)]
    events = reduce(DataFrame.unionByName, parts).join(periods(cdm.observation_period), "person_id")
    # What no definition takes, whichever days it asks for before and after.
    early, late = min(s.prior_days for s in specs), min(s.post_days for s in specs)
    inside = (F.date_add("op_start_date", early) <= F.col("start_date")) & (F.date_add("start_date", late) <= F.col("op_end_date"))
    return materialize(events.filter(inside), "primary")


def entry_events(primary: DataFrame, every: list[CohortSpec], specs: list[CohortSpec], first: list[int]) -> DataFrame:
    """Primary events of `specs`, limited for those in `first`; `primary` holds the `primary_rows` of `every` definition."""
    number = {q: k for k, q in enumerate(dict.fromkeys(q for s in every for q in s.primary))}
    users: dict[int, list[Column]] = {}
    for s in specs:
        for i, q in enumerate(s.primary):
            fields = {"cohort_definition_id": F.lit(s.cohort_id).cast("long"), "criterion": F.lit(i), "_prior": F.lit(s.prior_days), "_post": F.lit(s.post_days)}
            users.setdefault(number[q], []).append(F.struct(*[v.alias(n) for n, v in fields.items()]))
    of = None
    for k, by in users.items():
        here = F.col("_asked") == k
        of = F.when(here, F.array(*by)) if of is None else of.when(here, F.array(*by))
    prior, post = (F.col(c) for c in ("_prior", "_post"))
    events = primary.withColumn("_for", F.explode(of)).select(*primary.columns, "_for.*")
    inside = (F.date_add("op_start_date", prior) <= F.col("start_date")) & (F.date_add("start_date", post) <= F.col("op_end_date"))
    inside = inside & ((prior >= 0) & (post >= 0) | F.col("start_date").between(F.col("op_start_date"), F.col("op_end_date")))
    return _limited(events.filter(inside).drop("_asked", "_prior", "_post"), first)


def _judged(cdm: Cdm, codesets: DataFrame | None, specs: list[CohortSpec]) -> DataFrame:
    """Included events of all definitions; those without criteria are not asked about."""
    primary = primary_rows(cdm, codesets, specs)
    asking, plain = [s for s in specs if _groups(s)], [s for s in specs if not _groups(s)]
    parts = []
    if plain:
        # With nothing to meet in between, the limits are one.
        first = [s.cohort_id for s in plain if "First" in (s.primary_limit, s.qualified_limit, s.expression_limit)]
        parts.append(entry_events(primary, specs, plain, first))
    if asking:
        events = entry_events(primary, specs, asking, [s.cohort_id for s in asking if s.primary_limit == "First"])
        parts.append(_included(cdm, codesets, events, asking))
    return reduce(DataFrame.unionByName, parts)


def _included(cdm: Cdm, codesets: DataFrame | None, events: DataFrame, specs: list[CohortSpec]) -> DataFrame:
    """The entry events that meet the groups of their definition, limited; one that is limited before holds a row per person already."""
    groups: dict[str, Group] = {}
    only: dict[str, int] = {}
    for k, s in enumerate(specs):
        for name, group in [(f"_also_{k}", s.additional), *((f"_rule_{k}_{i}", g) for i, g in enumerate(s.rules))]:
            if group is not None:
                groups[name], only[name] = group, s.cohort_id
    events = materialize(add_groups(cdm, codesets, events, groups, only), "judged")

    def met(names) -> Column:
        # Which groups a definition has is known here; without any it is met.
        return _by_cohort(specs, lambda s: reduce(lambda a, b: a & b, [F.col(n) for n in names(s) if n in groups], F.lit(True)))

    place = {s.cohort_id: k for k, s in enumerate(specs)}
    rest = [s for s in specs if s.primary_limit != "First"]
    events = events.filter(met(lambda s: [f"_also_{place[s.cohort_id]}"]))
    events = _limited(events, [s.cohort_id for s in rest if s.qualified_limit == "First"])
    events = events.filter(met(lambda s: [f"_rule_{place[s.cohort_id]}_{i}" for i in range(len(s.rules))]))
    rest = [s for s in rest if s.qualified_limit != "First"]
    return _limited(events.drop(*groups), [s.cohort_id for s in rest if s.expression_limit == "First"])


def _ended(events: DataFrame, specs: list[CohortSpec]) -> DataFrame:
    """Exit dates by definition."""

    def end(s: CohortSpec) -> Column:
        if s.exit is None:
            return F.col("op_end_date")
        day = F.greatest(F.date_add(s.exit.field, s.exit.days), F.col("start_date"))
        return F.least(day, F.col("op_end_date")) if s.exit.cap else day

    return events.withColumn("end_date", _by_cohort(specs, end)).filter("end_date >= start_date")


def build_cohorts(cdm: Cdm, specs: list[CohortSpec], together: int = TOGETHER) -> DataFrame:
    """The cohort rows of all definitions; the same as those of `build_cohort` for each."""
    if len({s.cohort_id for s in specs}) < len(specs):
        raise ValueError("definitions need ids of their own")
    specs, codesets = share_codesets(cdm, specs)
    shared = replace(cdm, matched=matched_events(cdm, codesets, [q for s in specs for q in queries_of(s)]))
    parts = []
    for i in range(0, len(specs), together):
        some = specs[i : i + together]
        ended = _ended(_judged(shared, codesets, some), some).withColumn("_pad", _by_cohort(some, lambda s: s.era_pad))
        parts.append(era_collapse(ended, [*KEYS, "_pad"], pad=F.col("_pad")))
    return reduce(DataFrame.unionByName, parts).select(
        "cohort_definition_id",
        F.col("person_id").cast("long").alias("subject_id"),
        F.col("start_date").alias("cohort_start_date"),
        F.col("end_date").alias("cohort_end_date"),
    )
