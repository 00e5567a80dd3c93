"""Definitions built together against definitions built one by one."""

from dataclasses import replace

from epiloom.operators.codesets import ConceptSet
from epiloom.operators.criteria import Comparison, Correlated, Demographic, EventQuery, Group, Window
from epiloom.plans.cohort_sets import build_cohorts, matched_events, queries_of
from epiloom.plans.cohorts import CohortSpec, DateOffset, build_cohort, share_codesets
from epiloom.sources.tables import Cdm

from helpers import cdm, rows

COLUMNS = ["cohort_definition_id", "subject_id", "cohort_start_date", "cohort_end_date"]
SETS = (ConceptSet(1, concepts=(10,)), ConceptSet(2, concepts=(20, 10)))
ILL, EITHER, DRUG = EventQuery("condition", 1), EventQuery("condition", 2), EventQuery("drug", 2)


class Counted(Cdm):
    """Counts how often each table is read."""

    def __getattr__(self, name):
        self.__dict__.setdefault("reads", {}).setdefault(name, 0)
        self.__dict__["reads"][name] += 1
        return super().__getattr__(name)


def database(spark):
    many = [(100 + i, 3, (10, 20, 30)[i % 3], i * 5, i * 5 + 3 if i % 4 else None) for i in range(40)]
    return cdm(
        spark,
        persons=[(1, 8507, 1970, 1, 1), (2, 8532, 1990, 6, 1), (3, 8507, 1950, 2, 29)],
        periods=[(1, 0, 400), (1, 500, 900), (2, 0, 300), (3, 0, 250)],
        conditions=[(1, 1, 10, 30, None), (2, 1, 20, 100, 110), (3, 1, 10, 100, 101), (4, 1, 10, 600, 610), (5, 2, 20, 5, 6), (6, 2, 10, 299, None), (6, 2, 10, 299, None), *many],
        drugs=[(1, 1, 10, 40, 50), (2, 1, 10, 590, 595), (3, 2, 20, 1, 2), (4, 3, 10, 60, 61)],
        deaths=[(2, 300), (3, 240)],
        concepts=[(10, None), (20, None), (30, None)],
    )


DEAD_SOON = Correlated(EventQuery("death"), "at_least", 1, Window(0, 365))
SPECS = [
    CohortSpec(1, (ILL,), SETS),
    CohortSpec(2, (ILL, EITHER), SETS, prior_days=20, primary_limit="All", qualified_limit="All", expression_limit="All", exit=DateOffset(7), era_pad=3),
    CohortSpec(3, (EITHER,), SETS, post_days=50, primary_limit="All", additional=Group("ANY", (Correlated(DRUG, "at_least", 1, Window(-30, 30)),)), era_pad=0),
    CohortSpec(4, (ILL,), SETS, primary_limit="All", qualified_limit="All", rules=(Group("ALL", (DEAD_SOON,)), Group("ALL", (Demographic(Comparison("gt", 20)),)))),
    CohortSpec(5, (replace(EITHER, first=True),), SETS, rules=(Group("ALL", (Correlated(DRUG, "at_most", 0, Window(None, -1)),)),)),
    CohortSpec(6, (EventQuery("death"),)),
    CohortSpec(7, (EventQuery("condition"),), primary_limit="All", qualified_limit="All", expression_limit="All", exit=DateOffset(1, "end_date", cap=True), era_pad=10),
    CohortSpec(8, (replace(ILL, where=Group("ALL", (Correlated(DRUG, "at_least", 1, Window(-10, 10)),))),), SETS, primary_limit="All"),
]


def test_the_same_as_one_by_one(spark):
    data = database(spark)
    single = sorted(r for s in SPECS for r in rows(build_cohort(data, s), *COLUMNS))
    assert single and rows(build_cohorts(data, SPECS), *COLUMNS) == single
    assert rows(build_cohorts(data, SPECS, together=3), *COLUMNS) == single


def test_each_domain_is_read_once(spark):
    data = Counted(database(spark).tables)
    specs, codesets = share_codesets(data, SPECS)
    data.__dict__["reads"] = {}
    matched_events(data, codesets, [q for s in specs for q in queries_of(s)])
    assert data.__dict__["reads"] == {"condition_occurrence": 1, "drug_exposure": 1, "death": 1}
    data.__dict__["reads"] = {}
    build_cohorts(data, [s for s in SPECS if s.cohort_id != 8])
    assert all(data.__dict__["reads"][t] == 1 for t in ("condition_occurrence", "drug_exposure", "death"))


def test_no_rows(spark):
    empty = cdm(spark, concepts=[(10, None)])
    assert build_cohorts(empty, SPECS[:5]).collect() == []


def test_definitions_without_criteria_are_not_asked_about(spark, monkeypatch):
    """Their events are no anchors, and a whole domain that one query asks for is not copied."""
    from epiloom.operators import criteria
    from epiloom.plans import cohort_sets
    from epiloom.sources.tables import materialize

    stored = {}

    def noted(df, name="table"):
        stored[name] = materialize(df, name)
        return stored[name]

    monkeypatch.setattr(criteria, "materialize", noted)
    monkeypatch.setattr(cohort_sets, "materialize", noted)
    build_cohorts(database(spark), [s for s in SPECS if s.cohort_id in (1, 2, 3, 4, 7)])
    assert {r[0] for r in stored["index"].select("cohort_definition_id").distinct().collect()} == {3, 4}
    assert "matched-death" not in stored and "matched-condition" in stored
