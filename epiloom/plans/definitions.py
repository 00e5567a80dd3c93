"""Cohort definitions kept as JSON documents.

Turns the exchange format of cohort editors into `CohortSpec`. Anything a
document asks for that the operators do not do is an error, never ignored.
"""

from __future__ import annotations

import json
from datetime import date

from pyspark.sql import SparkSession

from epiloom.operators.codesets import ConceptSet
from epiloom.operators.criteria import Comparison, Correlated, Demographic, EventQuery, Group, Window
from epiloom.plans.cohort_sets import build_cohorts
from epiloom.plans.cohorts import CohortSpec, DateOffset, build_with_statistics, share_codesets
from epiloom.sources.tables import Cdm, replace_cohort

# Names of the format.
DOMAINS = {
    "ConditionOccurrence": "condition",
    "DrugExposure": "drug",
    "ProcedureOccurrence": "procedure",
    "Measurement": "measurement",
    "Observation": "observation",
    "VisitOccurrence": "visit",
    "Death": "death",
    "DrugEra": "drug_era",
    "ObservationPeriod": "observation_period",
}
OCCURRENCES = {0: "exactly", 1: "at_most", 2: "at_least"}
START_DATES = {"OccurrenceStartDate", "PeriodStartDate", "EraStartDate"}
END_DATES = {"OccurrenceEndDate", "PeriodEndDate", "EraEndDate"}
AGES = {"Age", "AgeAtStart"}
DATE_FIELDS = {"StartDate": "start_date", "EndDate": "end_date"}


def _refuse(what: str, found: object) -> None:
    if found:
        raise ValueError(f"not supported in a cohort definition: {what}")


def _comparison(item: dict) -> Comparison:
    def value(v):
        return date.fromisoformat(v[:10]) if isinstance(v, str) else v

    _refuse(f"comparison {item['Op']}", item["Op"].startswith("!"))
    return Comparison(item["Op"], value(item["Value"]), value(item.get("Extent")))


def _query(criterion: dict) -> EventQuery:
    ((name, fields),) = criterion.items()
    if name not in DOMAINS:
        _refuse(name, True)
    known = {}
    for key, item in fields.items():
        if key == "CodesetId":
            known["codeset_id"] = item
        elif key == "First":
            known["first"] = bool(item)
        elif key in AGES:
            known["age"] = _comparison(item)
        elif key in START_DATES:
            known["start"] = _comparison(item)
        elif key in END_DATES:
            known["end"] = _comparison(item)
        elif key == "EraLength" and item["Op"] == "gt":
            known["longer_than_days"] = item["Value"]
        elif key == "CorrelatedCriteria":
            known["where"] = _group(item)
        else:
            _refuse(f"{name}.{key}", item)
    return EventQuery(DOMAINS[name], **known)


def _window(item: dict) -> Window:
    def days(edge: dict) -> int | None:
        return None if edge.get("Days") is None else int(edge["Days"]) * edge["Coeff"]

    return Window(days(item["Start"]), days(item["End"]), bool(item.get("UseIndexEnd")))


def _correlated(item: dict) -> Correlated:
    _refuse("RestrictVisit", item.get("RestrictVisit"))
    occurrence = item["Occurrence"]
    _refuse("Occurrence.IsDistinct", occurrence.get("IsDistinct"))
    start, end = Window(), None
    for key in ("StartWindow", "EndWindow"):
        window = item.get(key)
        if window is None:
            continue
        # Which date a window is about is said by the window itself.
        if window.get("UseEventEnd", key == "EndWindow"):
            _refuse("two windows on the end date", end)
            end = _window(window)
        else:
            start = _window(window)
    return Correlated(
        _query(item["Criteria"]), OCCURRENCES[occurrence["Type"]], occurrence["Count"], start, end,
        bool(item.get("IgnoreObservationPeriod")),
    )


def _demographics(item: dict) -> Demographic:
    for key, value in item.items():
        _refuse(f"demographic {key}", value and key != "Age")
    return Demographic(_comparison(item["Age"]))


def _group(item: dict) -> Group:
    members = [_correlated(c) for c in item.get("CriteriaList", [])]
    members += [_demographics(d) for d in item.get("DemographicCriteriaList", [])]
    members += [_group(g) for g in item.get("Groups", [])]
    return Group(item["Type"], tuple(members), item.get("Count"))


def _concept_set(item: dict) -> ConceptSet:
    lists: dict[str, list[int]] = {"concepts": [], "descendants_of": [], "excluded": [], "excluded_descendants_of": []}
    for entry in item["expression"]["items"]:
        _refuse("includeMapped", entry.get("includeMapped"))
        out, concept = entry.get("isExcluded"), entry["concept"]["CONCEPT_ID"]
        lists["excluded" if out else "concepts"].append(concept)
        if entry.get("includeDescendants"):
            lists["excluded_descendants_of" if out else "descendants_of"].append(concept)
    return ConceptSet(item["id"], **{k: tuple(v) for k, v in lists.items()})


def read_definition(document: dict | str, cohort_id: int) -> CohortSpec:
    """The spec of a JSON document (text or parsed)."""
    doc = json.loads(document) if isinstance(document, str) else document
    primary = doc["PrimaryCriteria"]
    _refuse("CensoringCriteria", doc.get("CensoringCriteria"))
    _refuse("CensorWindow", doc.get("CensorWindow"))
    leave = doc.get("EndStrategy")
    offset = None
    if leave:
        _refuse("this EndStrategy", set(leave) - {"DateOffset"})
        offset = DateOffset(leave["DateOffset"]["Offset"], DATE_FIELDS[leave["DateOffset"]["DateField"]])
    additional = doc.get("AdditionalCriteria")

    def limit(item: dict | None) -> str:
        return "First" if item and item["Type"].lower() == "first" else "All"

    window = primary.get("ObservationWindow", {})
    return CohortSpec(
        cohort_id=cohort_id,
        primary=tuple(_query(c) for c in primary["CriteriaList"]),
        concept_sets=tuple(_concept_set(s) for s in doc.get("ConceptSets", [])),
        prior_days=window.get("PriorDays", 0),
        post_days=window.get("PostDays", 0),
        primary_limit=limit(primary.get("PrimaryCriteriaLimit")),
        additional=_group(additional) if additional else None,
        # Without additional criteria the qualified limit does not apply.
        qualified_limit=limit(doc.get("QualifiedLimit")) if additional else "All",
        rules=tuple(_group(r["expression"]) for r in doc.get("InclusionRules", [])),
        rule_names=tuple((r.get("name"), r.get("description")) for r in doc.get("InclusionRules", [])),
        expression_limit=limit(doc.get("ExpressionLimit")),
        exit=offset,
        era_pad=doc.get("CollapseSettings", {}).get("EraPad", 0),
    )


def generate_cohorts(spark: SparkSession, cdm: Cdm, documents: dict[int, str], path: str, statistics: str | None = None) -> None:
    """Build each definition and write it under its cohort id, replacing older rows.

    All definitions go through one pass over the data (`cohort_sets`). With a folder for `statistics`, the
    tables of STATISTICS are written there in the same way (to be read by `versions.read_ids`); then definitions are built one after the other, with the concept sets of all expanded together.
    """
    specs = [read_definition(document, cohort_id) for cohort_id, document in documents.items()]
    if statistics is None:
        if specs:
            replace_cohort(build_cohorts(cdm, specs), [s.cohort_id for s in specs], path)
        return
    specs, codesets = share_codesets(cdm, specs)
    for spec in specs:
        tables = build_with_statistics(cdm, spec, codesets)
        replace_cohort(tables.pop("cohort"), [spec.cohort_id], path)
        for name, rows in tables.items():
            replace_cohort(rows, [spec.cohort_id], f"{statistics}/{name}")
