"""From a cohort definition to cohort rows.

Lazy but for the codesets and the index events of each criteria group, which
are stored, as several steps read them.
"""

from __future__ import annotations

from dataclasses import dataclass, fields, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epiloom.operators.codesets import ConceptSet, stored_codesets
from epiloom.operators.criteria import Correlated, EventQuery, Group, add_groups, filter_group, query_events
from epiloom.operators.eras import era_collapse, exit_at_observation_end, exit_fixed_offset, to_cohort
from epiloom.operators.events import domain_events, first_rows
from epiloom.operators.inclusion import all_rules_met, inclusion_result, inclusion_stats, rule_mask, summary_stats
from epiloom.operators.observation import attach_observation
from epiloom.sources.tables import Cdm, materialize

ORDER = ["start_date", "event_id", "criterion", "end_date"]


@dataclass(frozen=True)
class DateOffset:
    """Exit so many days after the event's start or end."""

    days: int
    field: str = "start_date"
    cap: bool = False


@dataclass(frozen=True)
class CohortSpec:
    """A cohort definition; limits are First or All."""

    cohort_id: int
    primary: tuple[EventQuery, ...]
    concept_sets: tuple[ConceptSet, ...] = ()
    prior_days: int = 0
    post_days: int = 0
    primary_limit: str = "First"
    additional: Group | None = None
    qualified_limit: str = "First"
    rules: tuple[Group, ...] = ()
    rule_names: tuple[tuple[str | None, str | None], ...] = ()  # name and description of each rule
    expression_limit: str = "First"
    exit: DateOffset | None = None
    era_pad: int = 0


def limited(events: DataFrame, limit: str) -> DataFrame:
    return first_rows(events, ["person_id"], ORDER) if limit == "First" else events


def primary_events(cdm: Cdm, codesets: DataFrame | None, spec: CohortSpec) -> DataFrame:
    """Entry events of all primary criteria with their observation period.

    `criterion` tells apart events of different tables with the same id.
    """
    parts = [
        query_events(cdm, codesets, q).withColumn("criterion", F.lit(i)) for i, q in enumerate(spec.primary)
    ]
    found = attach_observation(
        reduce(DataFrame.unionByName, parts), cdm.observation_period, spec.prior_days, spec.post_days
    )
    return limited(found, spec.primary_limit)


def qualified_events(cdm: Cdm, codesets: DataFrame | None, spec: CohortSpec) -> DataFrame:
    events = primary_events(cdm, codesets, spec)
    if spec.additional is not None:
        events = filter_group(cdm, codesets, events, spec.additional)
    return limited(events, spec.qualified_limit)


def masked_events(cdm: Cdm, codesets: DataFrame | None, spec: CohortSpec) -> DataFrame:
    """Qualified events with the bit mask of the inclusion rules they meet."""
    events = qualified_events(cdm, codesets, spec)
    names = [f"_rule_{i}" for i in range(len(spec.rules))]
    known = add_groups(cdm, codesets, events, dict(zip(names, spec.rules)))
    return known.withColumn("inclusion_rule_mask", rule_mask(names)).drop(*names)


def included_events(masked: DataFrame, spec: CohortSpec) -> DataFrame:
    kept = all_rules_met(masked, len(spec.rules)) if spec.rules else masked
    return limited(kept, spec.expression_limit)


def cohort_rows(included: DataFrame, spec: CohortSpec) -> DataFrame:
    """Exit dates, then eras, then the cohort table layout."""
    if spec.exit is None:
        ended = exit_at_observation_end(included)
    else:
        ended = exit_fixed_offset(included, spec.exit.days, spec.exit.field, spec.exit.cap)
    eras = era_collapse(ended.filter("end_date >= start_date"), ["person_id"], pad=spec.era_pad)
    return to_cohort(eras, spec.cohort_id)


def spec_codesets(cdm: Cdm, spec: CohortSpec) -> DataFrame | None:
    if not spec.concept_sets:
        return None
    return stored_codesets(list(spec.concept_sets), cdm.concept, cdm.concept_ancestor)


def share_codesets(cdm: Cdm, specs: list[CohortSpec]) -> tuple[list[CohortSpec], DataFrame | None]:
    """Specs whose codesets have ids of their own, equal sets one, and all these sets expanded and stored together."""
    number: dict[ConceptSet, int] = {}
    changed = []
    for spec in specs:
        ids = {s.codeset_id: number.setdefault(replace(s, codeset_id=0), len(number) + 1) for s in spec.concept_sets}
        changed.append(_renumbered(spec, ids) if ids else spec)
    sets = [replace(s, codeset_id=i) for s, i in number.items()]
    return changed, stored_codesets(sets, cdm.concept, cdm.concept_ancestor) if sets else None


def _renumbered(part, ids: dict[int, int]):
    """The same criteria, with other ids of codesets."""
    if isinstance(part, tuple):
        return tuple(_renumbered(p, ids) for p in part)
    if isinstance(part, ConceptSet):
        return replace(part, codeset_id=ids[part.codeset_id])
    if not isinstance(part, (CohortSpec, EventQuery, Correlated, Group)):
        return part
    held = {f.name: _renumbered(getattr(part, f.name), ids) for f in fields(part)}
    if isinstance(part, EventQuery) and part.codeset_id is not None:
        held["codeset_id"] = ids[part.codeset_id]
    return replace(part, **held)


def build_cohort(cdm: Cdm, spec: CohortSpec, codesets: DataFrame | None = None) -> DataFrame:
    """Cohort rows of a definition; pass `codesets` where many share them."""
    if codesets is None:
        codesets = spec_codesets(cdm, spec)
    return cohort_rows(included_events(masked_events(cdm, codesets, spec), spec), spec)


STATISTICS = ("cohort_inclusion", "cohort_inclusion_result", "cohort_inclusion_stats", "cohort_summary_stats")
_MODES = (0, 1)  # all events; the best event of each person


def build_with_statistics(cdm: Cdm, spec: CohortSpec, codesets: DataFrame | None = None) -> dict[str, DataFrame]:
    """The cohort (`cohort`) and the tables of STATISTICS on its inclusion rules.

    The masks are stored, as all five tables start from them. Rules that no event
    meets, and definitions without any event, count 0.
    """
    if codesets is None:
        codesets = spec_codesets(cdm, spec)
    masked = materialize(masked_events(cdm, codesets, spec), "masked")
    spark, n = masked.sparkSession, len(spec.rules)
    own = F.lit(spec.cohort_id).cast("long").alias("cohort_definition_id")
    names = [*spec.rule_names, *[(None, None)] * (n - len(spec.rule_names))]
    rules = spark.createDataFrame(
        [(i, name, text) for i, (name, text) in enumerate(names)], "rule_sequence int, name string, description string"
    )
    modes = spark.createDataFrame([(m,) for m in _MODES], "mode_id int")
    result = reduce(DataFrame.unionByName, [inclusion_result(masked, m) for m in _MODES])
    result = materialize(result, "inclusion_result")
    found = summary_stats(result, n)
    summary = modes.join(found, "mode_id", "left").fillna(0)
    every = rules.select("rule_sequence", F.explode(F.array(*map(F.lit, _MODES))).alias("mode_id"))
    totals = summary.select("mode_id", F.col("base_count").alias("person_total"))
    per_rule = inclusion_stats(result, n).drop("person_total") if n else None
    stats = every.join(totals, "mode_id")
    if per_rule is None:
        stats = stats.withColumns({"person_count": F.lit(0).cast("long"), "gain_count": F.lit(0).cast("long")})
    else:
        stats = stats.join(per_rule, ["mode_id", "rule_sequence"], "left").fillna(0)
    return {
        "cohort": cohort_rows(included_events(masked, spec), spec),
        "cohort_inclusion": rules.select(own, "rule_sequence", "name", "description"),
        "cohort_inclusion_result": result.select(own, "inclusion_rule_mask", "person_count", "mode_id"),
        "cohort_inclusion_stats": stats.select(own, "rule_sequence", "person_count", "gain_count", "person_total", "mode_id"),
        "cohort_summary_stats": summary.select(own, "base_count", "final_count", "mode_id"),
    }


def same_day_death_cohort(cdm: Cdm, cohort_id: int) -> DataFrame:
    """First death inside an observation period; the cohort ends the same day."""
    deaths = attach_observation(domain_events(cdm, "death"), cdm.observation_period)
    first = first_rows(deaths, ["person_id"], ["start_date", "event_id", "op_start_date"])
    return to_cohort(first.withColumn("end_date", F.least("start_date", "op_end_date")), cohort_id)
