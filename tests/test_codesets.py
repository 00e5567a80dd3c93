from epiloom.operators.codesets import ConceptSet, expand_codesets, match_codeset, match_codeset_in, stored_codesets
from epiloom.operators.events import domain_events
from helpers import cdm, rows

CONCEPTS = [(1, None), (2, None), (3, "D"), (4, None), (5, "D"), (10, None)]
ANCESTORS = [(10, 10), (10, 1), (10, 2), (10, 3), (4, 4), (2, 2)]


def expand(spark, *sets):
    c = cdm(spark, concepts=CONCEPTS, ancestors=ANCESTORS)
    return rows(expand_codesets(list(sets), c.concept, c.concept_ancestor))


def test_named_concepts_must_exist_but_may_be_invalid(spark):
    assert expand(spark, ConceptSet(0, concepts=(3, 5, 99))) == [(0, 3), (0, 5)]


def test_descendants_must_be_valid(spark):
    assert expand(spark, ConceptSet(0, descendants_of=(10,))) == [(0, 1), (0, 2), (0, 10)]


def test_exclusion_wins(spark):
    assert expand(spark, ConceptSet(0, (1, 4), (10,), (4,), (2,))) == [(0, 1), (0, 10)]


def test_sets_do_not_mix(spark):
    found = expand(spark, ConceptSet(0, (1,)), ConceptSet(1, (1, 2), (), (1,)), ConceptSet(2))
    assert found == [(0, 1), (1, 2)]


def test_no_sets_give_no_rows(spark):
    assert expand(spark, ConceptSet(3)) == []


def test_matching_does_not_repeat_events(spark):
    c = cdm(spark, concepts=CONCEPTS, ancestors=ANCESTORS, conditions=[(1, 1, 1, 0, None), (2, 1, 4, 3, 9), (3, 2, 2, 0, 0)])
    sets = stored_codesets([ConceptSet(0, (1,), (10,)), ConceptSet(1, (1,))], c.concept, c.concept_ancestor)
    events = domain_events(c, "condition")
    for match in (match_codeset, match_codeset_in):
        assert rows(match(events, sets, 0), "event_id", "start_date", "end_date") == [(1, 0, 1), (3, 0, 0)]
