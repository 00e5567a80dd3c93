import copy
import json

import pytest

from epiloom.operators.codesets import ConceptSet
from epiloom.operators.criteria import Comparison, Correlated, Demographic, EventQuery, Group, Window
from epiloom.plans.cohorts import CohortSpec, DateOffset, build_cohort
from epiloom.plans.definitions import generate_cohorts, read_definition
from epiloom.sources.tables import Cdm, materialize, read_cohorts
from epiloom.sources.versions import read_ids
from helpers import cdm, day, rows


# The field names of the exchange format, here and in the documents below.
def concept_set(number, *items):
    return {
        "id": number,
        "name": f"set {number}",
        "expression": {
            "items": [
                {"concept": {"CONCEPT_ID": c}, "isExcluded": out, "includeDescendants": below, "includeMapped": False}
                for c, out, below in items
            ]
        },
    }


def near(criterion, start, end, kind=2, count=1, **more):
    def edge(days, open_side):
        return {"Coeff": open_side} if days is None else {"Days": abs(days), "Coeff": -1 if days < 0 else 1}

    window = {"Start": edge(start, -1), "End": edge(end, 1), "UseIndexEnd": False, "UseEventEnd": False}
    return {"Criteria": criterion, "StartWindow": window, "Occurrence": {"Type": kind, "Count": count}, **more}


DOCUMENT = {
    "ConceptSets": [concept_set(1, (1, False, False)), concept_set(2, (2, False, True), (9, True, True))],
    "PrimaryCriteria": {
        "CriteriaList": [{"ConditionOccurrence": {"CodesetId": 1, "ConditionTypeExclude": False, "Age": {"Value": 18, "Op": "gte"}}}],
        "ObservationWindow": {"PriorDays": 30, "PostDays": 0},
        "PrimaryCriteriaLimit": {"Type": "All"},
    },
    "AdditionalCriteria": {
        "Type": "ALL",
        "CriteriaList": [
            near({"DrugExposure": {"CodesetId": 2}}, None, -5, 0, 0, IgnoreObservationPeriod=True),
            {
                **near({"VisitOccurrence": {}}, None, 0),
                "EndWindow": {"Start": {"Days": 0, "Coeff": -1}, "End": {"Coeff": 1}, "UseEventEnd": True},
            },
        ],
        "DemographicCriteriaList": [{"Age": {"Value": 60, "Op": "lt"}}],
        "Groups": [{"Type": "ANY", "CriteriaList": [near({"Death": {}}, 0, 365)], "DemographicCriteriaList": [], "Groups": []}],
    },
    "QualifiedLimit": {"Type": "First"},
    "ExpressionLimit": {"Type": "All"},
    "InclusionRules": [{"name": "treated", "expression": {"Type": "ALL", "CriteriaList": [near({"DrugExposure": {"CodesetId": 2}}, 0, None)]}}],
    "EndStrategy": {"DateOffset": {"DateField": "EndDate", "Offset": 7}},
    "CensoringCriteria": [],
    "CollapseSettings": {"CollapseType": "ERA", "EraPad": 180},
    "CensorWindow": {},
}


def test_every_part_is_read():
    assert read_definition(json.dumps(DOCUMENT), 4) == CohortSpec(
        4,
        (EventQuery("condition", 1, age=Comparison("gte", 18)),),
        (ConceptSet(1, (1,)), ConceptSet(2, (2,), (2,), (9,), (9,))),
        prior_days=30,
        primary_limit="All",
        additional=Group(
            "ALL",
            (
                Correlated(EventQuery("drug", 2), "exactly", 0, Window(None, -5), ignore_observation=True),
                Correlated(EventQuery("visit"), "at_least", 1, Window(None, 0), Window(0, None)),
                Demographic(Comparison("lt", 60)),
                Group("ANY", (Correlated(EventQuery("death"), "at_least", 1, Window(0, 365)),)),
            ),
        ),
        qualified_limit="First",
        rules=(Group("ALL", (Correlated(EventQuery("drug", 2), "at_least", 1, Window(0, None)),)),),
        rule_names=(("treated", None),),
        expression_limit="All",
        exit=DateOffset(7, "end_date"),
        era_pad=180,
    )


@pytest.mark.parametrize(
    "path, value",
    [
        (("CensoringCriteria",), [{"Death": {}}]),
        (("AdditionalCriteria", "CriteriaList", 0, "RestrictVisit"), True),
        (("PrimaryCriteria", "CriteriaList", 0, "ConditionOccurrence", "ProviderSpecialty"), [1]),
        (("AdditionalCriteria", "CriteriaList", 0, "Occurrence", "IsDistinct"), True),
        (("EndStrategy",), {"CustomEra": {}}),
    ],
)
def test_what_is_not_supported_is_an_error(path, value):
    doc = copy.deepcopy(DOCUMENT)
    place = doc
    for key in path[:-1]:
        place = place[key]
    place[path[-1]] = value
    with pytest.raises(ValueError):
        read_definition(doc, 1)


def test_documents_run(spark, tmp_path):
    c = cdm(
        spark, [(i, 8507, 1970, 1, 1) for i in (1, 2, 3)], periods=[(i, 0, 900) for i in (1, 2, 3)],
        concepts=[(1, None), (2, None), (3, None), (9, None)], ancestors=[(2, 2), (2, 3), (9, 9)],
        conditions=[(i, i, 1, 100, 110) for i in (1, 2, 3)], visits=[(i, i, 8, 90, 120) for i in (1, 2, 3)],
        deaths=[(1, 300), (2, 300)], drugs=[(1, 1, 3, 150, None), (2, 2, 3, 150, None), (3, 2, 3, 50, None), (4, 3, 2, 150, None)],
    )
    simple = {
        "ConceptSets": [], "PrimaryCriteria": {"CriteriaList": [{"ObservationPeriod": {
            "PeriodStartDate": {"Value": str(day(5)), "Op": "lte"}, "AgeAtStart": {"Value": 30, "Op": "eq"}}}]},
        "InclusionRules": [],
    }
    path = str(tmp_path / "cohorts")
    generate_cohorts(spark, c, {4: json.dumps(DOCUMENT), 5: json.dumps(simple)}, path)
    assert rows(read_cohorts(spark, path)) == [(4, 1, 100, 117), (5, 1, 0, 900), (5, 2, 0, 900), (5, 3, 0, 900)]
    assert rows(build_cohort(c, read_definition(simple, 5))) == rows(read_cohorts(spark, path))[1:]


def test_generation_with_statistics(spark, tmp_path):
    """Two definitions with the same codeset numbers for other sets; a rebuilt one without events leaves no rows."""
    plain = {
        "ConceptSets": [concept_set(1, (1, False, False))],
        "PrimaryCriteria": {"CriteriaList": [{"ConditionOccurrence": {"CodesetId": 1}}], "ObservationWindow": {"PriorDays": 0, "PostDays": 0},
                            "PrimaryCriteriaLimit": {"Type": "All"}},
        "QualifiedLimit": {"Type": "First"}, "ExpressionLimit": {"Type": "All"}, "CollapseSettings": {"CollapseType": "ERA", "EraPad": 0},
        "InclusionRules": [
            {"name": "drug", "description": "any later", "expression": {"Type": "ALL", "CriteriaList": [near({"DrugExposure": {"CodesetId": 1}}, 0, None)]}},
            {"name": "alone", "expression": {"Type": "ALL", "CriteriaList": [near({"ConditionOccurrence": {"CodesetId": 1}}, 0, 0, 0, 1)]}},
        ],
    }
    other = copy.deepcopy(plain)
    other["ConceptSets"] = [concept_set(1, (5, False, False))]
    c = cdm(
        spark, [(i, 8507, 1980, 1, 1) for i in range(1, 5)], [(i, 0, 400) for i in range(1, 5)],
        conditions=[(1, 1, 1, 10, None), (2, 2, 1, 10, None), (3, 2, 1, 10, None), (4, 3, 5, 10, None)],
        drugs=[(1, 1, 1, 20, None), (2, 2, 1, 20, None), (3, 3, 5, 20, None)], concepts=[(1, None), (5, None)],
    )
    path, stats = str(tmp_path / "cohorts"), str(tmp_path / "statistics")
    generate_cohorts(spark, c, {1: json.dumps(plain), 2: json.dumps(other)}, path, stats)
    assert rows(read_cohorts(spark, path), "cohort_definition_id", "subject_id") == [(1, 1), (2, 3)]

    def table(name, *columns):
        return rows(read_ids(spark, f"{stats}/{name}"), *columns)

    assert table("cohort_inclusion", "cohort_definition_id", "rule_sequence", "name", "description") == [
        (i, k, n, d) for i in (1, 2) for k, n, d in ((0, "drug", "any later"), (1, "alone", None))
    ]
    assert table("cohort_inclusion_result", "cohort_definition_id", "mode_id", "inclusion_rule_mask", "person_count") == [
        (1, 0, 1, 2), (1, 0, 3, 1), (1, 1, 1, 1), (1, 1, 3, 1), (2, 0, 3, 1), (2, 1, 3, 1)
    ]
    first = [r for r in table("cohort_inclusion_stats", "cohort_definition_id", "mode_id", "rule_sequence", "person_count", "gain_count", "person_total") if r[0] == 1]
    assert first == [(1, 0, 0, 3, 0, 3), (1, 0, 1, 1, 2, 3), (1, 1, 0, 2, 0, 2), (1, 1, 1, 1, 1, 2)]
    c.tables["condition_occurrence"] = c.condition_occurrence.filter("person_id > 2")
    generate_cohorts(spark, c, {1: json.dumps(plain)}, path, stats)
    assert rows(read_cohorts(spark, path), "cohort_definition_id", "subject_id") == [(2, 3)]
    assert table("cohort_summary_stats", "cohort_definition_id", "mode_id", "base_count", "final_count") == [(1, 0, 0, 0), (1, 1, 0, 0), (2, 0, 1, 1), (2, 1, 1, 1)]


def test_nested_events_are_read_once(spark, monkeypatch):
    from epiloom.operators import criteria

    stored = []
    monkeypatch.setattr(criteria, "materialize", lambda df, name="table": (stored.append(name), materialize(df, name))[1])
    period = "SELECT 1L AS person_id, DATE '2000-01-01' AS observation_period_start_date, DATE '2001-01-01' AS observation_period_end_date"
    data = Cdm({"observation_period": spark.sql(period)})
    events = spark.sql(
        "SELECT 1L AS person_id, id AS event_id, date_add(DATE '2000-01-01', CAST(id AS INT)) AS start_date, DATE '2002-01-01' AS end_date, "
        "NULL AS target_concept_id, NULL AS visit_occurrence_id FROM range(4)"
    )
    rows = criteria.nested(data, None, events.select("*"), Group("ALL", ()))
    assert sorted(r.event_id for r in rows.collect()) == [0, 1, 2, 3] and stored == ["nested"]
