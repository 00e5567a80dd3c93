import random

import pytest

from epiloom.operators.eras import era_collapse, exit_fixed_offset
from helpers import day, intervals, rows


@pytest.mark.parametrize(
    "gap, pad, eras",
    [(0, 0, 1), (1, 0, 2), (1, 1, 1), (2, 1, 2), (180, 180, 1), (181, 180, 2)],
)
def test_gap_and_pad(spark, gap, pad, eras):
    df = intervals(spark, [(1, 0, 10), (1, 10 + gap, 20 + gap)])
    found = rows(era_collapse(df, ["person_id"], pad=pad))
    assert found == ([(1, 0, 20 + gap)] if eras == 1 else [(1, 0, 10), (1, 10 + gap, 20 + gap)])


def test_contained_interval_keeps_the_long_end(spark):
    df = intervals(spark, [(1, 0, 100), (1, 5, 10), (1, 50, 60), (1, 0, 3), (2, 7, 7)])
    assert rows(era_collapse(df, ["person_id"])) == [(1, 0, 100), (2, 7, 7)]


@pytest.mark.parametrize("pad", [0, 1, 30])
def test_against_brute_force(spark, pad):
    rnd = random.Random(pad)
    data = []
    for person in range(6):
        for _ in range(200 if person == 0 else 15):
            a = rnd.randint(0, 3000)
            data.append((person, a, a + rnd.randint(0, 20)))
    expected = []
    for person in range(6):
        current = None
        for a, b in sorted((a, b) for p, a, b in data if p == person):
            if current and a <= current[1] + pad:
                current[1] = max(current[1], b)
            else:
                current = [a, b]
                expected.append((person, current))
    found = rows(era_collapse(intervals(spark, data), ["person_id"], pad=pad))
    assert found == sorted((p, a, b) for p, (a, b) in expected)


def test_offset_never_ends_before_start_and_can_be_capped(spark):
    df = spark.createDataFrame([(1, day(5), day(2), day(8))], "person_id int, start_date date, end_date date, op_end_date date")
    assert rows(exit_fixed_offset(df, 1, "end_date"), "end_date") == [(5,)]
    assert rows(exit_fixed_offset(df, 7), "end_date") == [(12,)]
    assert rows(exit_fixed_offset(df, 7, cap=True), "end_date") == [(8,)]
