"""Every registered query against its SQL, and what its plan may not contain."""

import pytest

import __spark_entry__ as entry
from check_oracles import compare, database

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return database(SF)


# Queries on corpora have tests of their own.
NAMES = [n for n in entry.queries() if not n.startswith("op") and n != "pipeline"]


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, db, name):
    assert compare(spark, db, name, SF) == ""


def test_entry_gives_the_cohort_layout(spark):
    df = entry.entry(spark)
    assert df.columns == ["cohort_definition_id", "subject_id", "cohort_start_date", "cohort_end_date"]
    assert df.count() > 0


def test_every_query_has_sql():
    assert set(entry.oracle_sql()) >= set(NAMES)


@pytest.mark.parametrize("name", ["a11_incidence_rate", "cohort_with_rules", "j8_end_window", "u3_overlap_cohorts", "w10_at_risk_end"])
def test_no_pairs_without_keys(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan and "EvalPython" not in plan


def test_scans_read_only_needed_columns(spark):
    plan = entry.queries()["f15_study_window"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    schema = plan.split("ReadSchema: ")[1].split(">")[0]
    assert "o_totalprice" not in schema and "o_orderstatus" not in schema
