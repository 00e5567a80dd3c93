"""Registered queries on the smallest tables: against SQL where there is any, else that they give a row for each of the table."""

import pytest

import __spark_entry__ as entry
from check_oracles import compare, database

SF = "/root/testdata/sf0.001"
# op7, op8 and the pipeline run for long; their operators have tests of their own.
NAMES = [n for n in entry.queries() if n.startswith("op") and not n.startswith(("op7_", "op8_"))]


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, name):
    assert compare(spark, database(SF), name, SF) == ""


def test_all_are_registered():
    numbers = {n.split("_")[0] for n in entry.queries() if n.startswith("op")}
    assert numbers == {f"op{i}" for i in range(1, 14)} and "pipeline" in entry.queries()
