"""Criteria and whole definitions on hand-made people."""

import pytest

from epiloom.operators.codesets import ConceptSet
from epiloom.operators.criteria import Comparison, Correlated, Demographic, EventQuery, Group, Window, add_groups
from epiloom.operators.events import domain_events
from epiloom.operators.inclusion import best_events, inclusion_result, inclusion_stats, summary_stats
from epiloom.operators.observation import attach_observation
from epiloom.plans.cohorts import CohortSpec, DateOffset, build_cohort, masked_events, same_day_death_cohort
from helpers import cdm, day, rows

CONCEPTS = [(1, None), (2, None), (9, None)]
SETS = (ConceptSet(1, (1,)), ConceptSet(2, (2,)), ConceptSet(9, (9,)))
A = EventQuery("condition", 1)
B = EventQuery("drug", 2)


def people(n):
    return [(i, 8507 if i % 2 else 8532, 1970, 1, 1) for i in range(1, n + 1)]


def build(spark, spec, **tables):
    return rows(build_cohort(cdm(spark, people(6), concepts=CONCEPTS, **tables), spec))


def test_prior_days_are_inclusive_and_gaps_exclude(spark):
    # 1: exactly 365 days after the start; 2: one day less; 3: in the gap of two periods; 4: second period
    found = build(
        spark,
        CohortSpec(5, (A,), SETS, prior_days=365),
        periods=[(1, 0, 900), (2, 0, 900), (3, 0, 400), (3, 600, 1200), (4, 0, 100), (4, 200, 900)],
        conditions=[(1, 1, 1, 365, None), (2, 2, 1, 364, None), (3, 3, 1, 500, None), (4, 4, 1, 565, None)],
    )
    assert found == [(5, 1, 365, 900), (5, 4, 565, 900)]


def test_first_event_is_taken_after_the_period_check(spark):
    found = build(
        spark, CohortSpec(5, (A,), SETS, prior_days=10), periods=[(1, 0, 100)],
        conditions=[(1, 1, 1, 5, None), (2, 1, 1, 20, None), (3, 1, 1, 30, None)],
    )
    assert found == [(5, 1, 20, 100)]


def test_first_ever_is_taken_before_the_period_check(spark):
    first = EventQuery("condition", 1, first=True)
    found = build(
        spark, CohortSpec(5, (first,), SETS, prior_days=10), periods=[(1, 0, 100)],
        conditions=[(1, 1, 1, 5, None), (2, 1, 1, 20, None)],
    )
    assert found == []


def test_all_events_with_offset_and_pad(spark):
    spec = CohortSpec(
        5, (A,), SETS, primary_limit="All", qualified_limit="All", expression_limit="All", exit=DateOffset(7), era_pad=3
    )
    found = build(
        spark, spec, periods=[(1, 0, 100)],
        conditions=[(1, 1, 1, 5, None), (2, 1, 1, 15, None), (3, 1, 1, 26, None), (4, 1, 1, 5, None)],
    )
    assert found == [(5, 1, 5, 22), (5, 1, 26, 33)]


def test_events_of_two_tables_with_one_id_stay_apart(spark):
    spec = CohortSpec(
        5, (A, B), SETS, primary_limit="All", qualified_limit="All", expression_limit="All", exit=DateOffset(0)
    )
    found = build(
        spark, spec, periods=[(1, 0, 100)], conditions=[(1, 1, 1, 5, None)], drugs=[(1, 1, 2, 50, None)]
    )
    assert found == [(5, 1, 5, 5), (5, 1, 50, 50)]


@pytest.mark.parametrize(
    "member, expected",
    [
        (Correlated(B, "at_least", 1, Window(5, 90)), [1, 2]),
        (Correlated(B, "at_least", 2, Window(5, 90)), [2]),
        (Correlated(B, "exactly", 1, Window(5, 90)), [1]),
        (Correlated(B, "at_most", 1, Window(5, 90)), [1, 3, 4, 5]),
        (Correlated(B, "exactly", 0, Window(None, None)), [3]),
        (Correlated(B, "at_least", 1, Window(None, -30)), [4]),
        (Correlated(B, "at_least", 1, Window(None, -30), ignore_observation=True), [4, 5]),
    ],
)
def test_occurrences_and_windows(spark, member, expected):
    found = build(
        spark,
        CohortSpec(5, (A,), SETS, additional=Group("ALL", (member,))),
        periods=[(i, 0, 500) for i in range(1, 5)] + [(5, 150, 500)],
        conditions=[(i, i, 1, 200, None) for i in range(1, 6)],
        drugs=[
            (1, 1, 2, 205, None), (2, 1, 2, 291, None), (3, 2, 2, 290, None), (4, 2, 2, 290, None),
            (5, 3, 9, 210, None), (6, 4, 2, 170, None), (7, 5, 2, 100, None), (8, 5, 2, 400, None),
        ],
    )
    assert [subject for _, subject, _, _ in found] == expected


def test_end_window_finds_the_stay_around_the_index(spark):
    stay = Correlated(EventQuery("visit", 9), window=Window(None, 0), end_window=Window(0, None))
    found = build(
        spark,
        CohortSpec(5, (A,), SETS, additional=Group("ALL", (stay,))),
        periods=[(i, 0, 500) for i in range(1, 6)],
        conditions=[(i, i, 1, 200, None) for i in range(1, 6)],
        visits=[
            (1, 1, 9, 190, 210), (2, 2, 9, 190, 199), (3, 3, 9, 201, 210), (4, 4, 9, 200, 200), (5, 5, 9, 190, 501)
        ],
    )
    assert [subject for _, subject, _, _ in found] == [1, 4]


def test_nested_criterion_counts_only_events_that_qualify(spark):
    drug_after = Group("ALL", (Correlated(B, "at_least", 1, Window(0, 10)),))
    again = Correlated(EventQuery("condition", 9, where=drug_after), "at_least", 1, Window(1, None))
    found = build(
        spark,
        CohortSpec(5, (A,), SETS, additional=Group("ALL", (again,))),
        periods=[(1, 0, 500), (2, 0, 500)],
        conditions=[(1, 1, 1, 50, None), (2, 2, 1, 50, None), (3, 1, 9, 60, None), (4, 2, 9, 60, None)],
        drugs=[(1, 1, 2, 65, None), (2, 2, 2, 75, None)],
    )
    assert found == [(5, 1, 50, 500)]


def test_groups(spark):
    c = cdm(
        spark, people(2), periods=[(1, 0, 500), (2, 0, 500)], concepts=CONCEPTS,
        conditions=[(1, 1, 1, 50, None), (2, 2, 1, 50, None)], drugs=[(1, 1, 2, 60, None)],
    )
    index = attach_observation(domain_events(c, "condition"), c.observation_period)
    drug = Correlated(EventQuery("drug"), "at_least", 1, Window(0, None))
    death = Correlated(EventQuery("death"))
    adult, child = Demographic(Comparison("gte", 30)), Demographic(Comparison("lt", 30))
    groups = {
        "all": Group("ALL", (drug, adult)),
        "any": Group("ANY", (drug, death)),
        "none": Group("AT_MOST", (drug, death), 0),
        "two": Group("AT_LEAST", (drug, adult, child), 2),
        "inner": Group("ALL", (adult, Group("AT_MOST", (drug,), 0))),
        "empty": Group("ALL", ()),
    }
    found = rows(add_groups(c, None, index, groups), "person_id", *groups)
    assert found == [(1, True, True, False, True, False, True), (2, False, False, True, False, True, True)]


RULED = CohortSpec(
    5, (A,), SETS, primary_limit="All", qualified_limit="All",
    rules=(
        Group("ALL", (Correlated(B, "at_least", 1, Window(0, 10)),)),
        Group("ALL", (Correlated(EventQuery("visit", 9), "at_least", 1, Window(-10, 0)),)),
    ),
)


def ruled(spark):
    return cdm(
        spark, people(4), periods=[(i, 0, 500) for i in range(1, 5)], concepts=CONCEPTS,
        conditions=[(1, 1, 1, 50, None), (2, 1, 1, 100, None), (3, 2, 1, 50, None), (4, 3, 1, 50, None), (5, 4, 1, 50, None)],
        drugs=[(1, 1, 2, 55, None), (2, 1, 2, 105, None), (3, 2, 2, 50, None)],
        visits=[(1, 1, 9, 95, 96), (2, 3, 9, 45, 46)],
    )


def test_inclusion_rules(spark):
    c = ruled(spark)
    assert rows(build_cohort(c, RULED)) == [(5, 1, 100, 500)]
    masked = masked_events(c, None, CohortSpec(5, (EventQuery("condition"),), rules=tuple(
        Group("ALL", (Correlated(EventQuery(m.query.domain), m.occurrence, m.count, m.window),))
        for g in RULED.rules for m in g.members), primary_limit="All", qualified_limit="All"))
    assert rows(masked, "event_id", "inclusion_rule_mask") == [(1, 1), (2, 3), (3, 1), (4, 2), (5, 0)]
    assert rows(best_events(masked), "person_id", "event_id") == [(1, 2), (2, 3), (3, 4), (4, 5)]
    events, best = inclusion_result(masked, 0), inclusion_result(masked, 1)
    assert rows(events) == [(0, 1, 0), (1, 2, 0), (2, 1, 0), (3, 1, 0)]
    assert rows(best) == [(0, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1)]
    # rule 0: met by 3 events, the one with mask 2 fails only it
    assert rows(inclusion_stats(events, 2)) == [(0, 0, 3, 1, 5), (0, 1, 2, 2, 5)]
    assert rows(summary_stats(events, 2)) == [(0, 5, 1)]


def test_death_cohort_needs_observation(spark):
    c = cdm(spark, people(2), periods=[(1, 0, 100), (2, 0, 50)], deaths=[(1, 100), (2, 51)])
    assert rows(same_day_death_cohort(c, 3)) == [(3, 1, 100, 100)]


def test_two_periods_of_one_person(spark):
    found = build(
        spark,
        CohortSpec(5, (A,), SETS, primary_limit="All", qualified_limit="All", expression_limit="All"),
        periods=[(1, 0, 100), (1, 200, 300)],
        conditions=[(1, 1, 1, 50, None), (2, 1, 1, 150, None), (3, 1, 1, 250, None)],
    )
    assert found == [(5, 1, 50, 100), (5, 1, 250, 300)]


def test_observation_period_as_entry(spark):
    started = EventQuery("observation_period", start=Comparison("lte", day(50)), end=Comparison("gte", day(50)))
    found = build(spark, CohortSpec(5, (started,)), periods=[(1, 0, 100), (2, 60, 100), (3, 0, 40)])
    assert found == [(5, 1, 0, 100)]
