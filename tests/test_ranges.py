"""Range counts and nearest events against brute force over all pairs."""

import random
from datetime import date

from pyspark.sql import functions as F

from epiloom.operators.criteria import Correlated, EventQuery, Group, Window, filter_group
from epiloom.operators import ranges as R
from epiloom.operators.dominance import count_dominated
from epiloom.operators.events import domain_events
from epiloom.operators.observation import attach_observation
from epiloom.operators.ranges import DayRange, Nearest, count_in_ranges, nearest_in_ranges
from helpers import cdm, day


def frames(spark, seed):
    rnd = random.Random(seed)
    index, events = [], []
    for person in range(5):
        for _ in range(20 if person else 60):  # person 0 holds most rows
            first = rnd.randint(-100, 0)
            index.append((person, rnd.randint(0, 300), first, first + rnd.randint(200, 500)))
        for _ in range(100 if person else 400):
            start = rnd.randint(-150, 420)
            events.append((person, start, start + rnd.randint(0, 60)))
    left = spark.createDataFrame(
        [(p, day(s), day(a), day(b)) for p, s, a, b in index],
        "person_id int, start_date date, op_start_date date, op_end_date date",
    )
    right = spark.createDataFrame([(p, day(s), day(e)) for p, s, e in events], "person_id int, start_date date, end_date date")
    return index, events, left, right


def test_counts(spark):
    index, events, left, right = frames(spark, 1)
    start, a, b = F.col("start_date"), F.col("op_start_date"), F.col("op_end_date")
    ranges = [
        DayRange("inside", right, F.greatest(a, F.date_add(start, 5)), F.least(b, F.date_add(start, 90))),
        DayRange("before", right, None, start),
        DayRange("after", right, F.date_add(start, 1), None),
        DayRange("stab", right, a, start, start, b),
        DayRange("short", right, F.date_add(start, -30), None, None, F.date_add(start, 7)),
        DayRange("overlap", right, F.date_add(start, -18), F.date_add(start, -1), overlap=True),
        DayRange("empty", right, F.date_add(start, 10), F.date_add(start, 5)),
    ]
    found = count_in_ranges(left, ["person_id"], ["start_date", "op_start_date", "op_end_date"], ranges).collect()

    def expected(p, s, a, b):
        mine = [(x, y) for q, x, y in events if q == p]
        return (
            sum(max(a, s + 5) <= x <= min(b, s + 90) for x, y in mine),
            sum(x <= s for x, y in mine),
            sum(x >= s + 1 for x, y in mine),
            sum(a <= x <= s and s <= y <= b for x, y in mine),
            sum(x >= s - 30 and y <= s + 7 for x, y in mine),
            sum(x <= s - 1 and y >= s - 18 for x, y in mine),
            0,
        )

    left_rows = sorted((p, day(s), day(a), day(b), *expected(p, s, a, b)) for p, s, a, b in index)
    assert sorted(tuple(r) for r in found) == left_rows


def test_end_range_without_bound_days(spark):
    index, events, left, right = frames(spark, 2)
    start = F.col("start_date")
    ranges = [
        DayRange("ends_after", right, None, None, start, None),
        DayRange("ends_by", right, None, None, None, start),
        DayRange("ends_on", right, None, None, start, start),
    ]
    for r in count_in_ranges(left, ["person_id"], ["start_date", "op_start_date", "op_end_date"], ranges).collect():
        mine = [day(y) for q, _, y in events if q == r.person_id]
        assert r.ends_after == sum(y >= r.start_date for y in mine)
        assert r.ends_by == sum(y <= r.start_date for y in mine)
        assert r.ends_on == sum(y == r.start_date for y in mine)


def test_start_and_end_ranges(spark):
    """Small Arrow batches, so that persons are swept over many of them; reversed ranges count nothing; cells keep apart."""
    index, events, left, right = frames(spark, 4)
    right = right.withColumns({"from": F.lit(day(0)), "to": F.when(F.dayofmonth("start_date") % 2 == 0, F.lit(day(9)))})
    left = left.withColumns({"from": F.lit(day(0)), "to": F.lit(day(9)), "x": F.col("start_date")})
    start, a, b = F.col("start_date"), F.col("op_start_date"), F.col("op_end_date")
    none = F.lit(None).cast("date")
    ranges = [
        DayRange("four", right, F.date_add(start, -40), F.date_add(start, 20), F.date_add(start, -5), F.date_add(start, 30)),
        DayRange("open", right, None, start, F.date_add(start, 20), None),
        DayRange("reversed", right, start, F.date_add(start, -20), F.date_add(start, 60), start),
        DayRange("celled", right, F.date_add(start, -90), None, None, F.date_add(start, 7), cell=("from", "to")),
        DayRange("unknown", right, start, none, start, None),
        DayRange("some", right, None, start, start, None, only=F.dayofmonth("start_date") > 15),
    ]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        found = count_in_ranges(left, ["person_id"], ["start_date", "x", "from", "to"], ranges).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert len(found) == len(index)
    for r in found:
        s = (r.start_date - day(0)).days
        mine = [(x, y) for q, x, y in events if q == r.person_id]
        assert r.four == sum(s - 40 <= x <= s + 20 and s - 5 <= y <= s + 30 for x, y in mine)
        assert r.open == sum(x <= s and y >= s + 20 for x, y in mine)
        assert (r.reversed, r.unknown) == (0, 0)
        assert r.celled == sum(x >= s - 90 and y <= s + 7 and day(x).day % 2 == 0 for x, y in mine)
        assert r.some == (sum(x <= s <= y for x, y in mine) if r.start_date.day > 15 else 0)


def test_dominance(spark):
    """Against all pairs, with text groups, nulls in them and weights."""
    rnd = random.Random(5)
    groups = ["a", "b", None]
    points = [(g, x, y, rnd.randint(0, 3)) for g in groups for x in range(12) for y in range(12) if rnd.random() < 0.6]
    corners = [(rnd.choice(["a", "b", "c", None]), rnd.randint(-2, 13), rnd.randint(-2, 13), i) for i in range(300)]
    found = count_dominated(
        spark.createDataFrame(points, "g string, x int, y int, n long"),
        spark.createDataFrame(corners, "g string, x int, y int, id int"), ["g"], ["id"],
    )
    expected = {(g, i, sum(n for h, p, q, n in points if h == g and g is not None and p <= x and q <= y)) for g, x, y, i in corners}
    got = {tuple(r) for r in found.collect()}
    assert {t for t in got if t[0] is not None} == {t for t in expected if t[0] is not None}
    assert len(got) == 300 and all(t[2] == 0 for t in got if t[0] is None)


def test_nearest(spark):
    index, events, left, right = frames(spark, 3)
    windows = [("last", None, -1), ("last", -90, -1), ("first", 1, 365), ("first", -3, 5), ("first", 0, None)]
    questions = [Nearest(f"q{i}", right, "start_date", lo, hi, w) for i, (w, lo, hi) in enumerate(windows)]
    found = nearest_in_ranges(left, ["person_id"], "start_date", questions).collect()
    assert len(found) == len(index)
    for r in found:
        for i, (which, lo, hi) in enumerate(windows):
            gaps = [(day(x) - r.start_date).days for q, x, _ in events if q == r.person_id]
            gaps = [g for g in gaps if (lo is None or g >= lo) and (hi is None or g <= hi)]
            best = (max if which == "last" else min)(gaps, default=None)
            assert (None if r[f"q{i}"] is None else (r[f"q{i}"] - r.start_date).days) == best


def test_any_date(spark):
    """Late, missing and reversed dates against a comparison of all pairs, as a left join would make them."""
    rnd = random.Random(7)
    days = [date(1, 1, 1), date(1970, 1, 1), *[date(2000, 1, d) for d in range(1, 12)], date(8300, 5, 5), date(9999, 12, 31), None]
    index = [(i, rnd.randrange(4), rnd.choice(days), rnd.choice(days)) for i in range(60)]
    events = [(rnd.randrange(4), rnd.choice(days), rnd.choice(days)) for _ in range(120)]
    left = spark.createDataFrame(index, "row int, person_id int, start_date date, other date")
    right = spark.createDataFrame(events, "person_id int, start_date date, end_date date")
    a, b = F.col("start_date"), F.col("other")
    ranges = [
        DayRange("after", right, a, None),
        DayRange("before", right, None, a),
        DayRange("between", right, a, b),
        DayRange("all", right, None, None),
        DayRange("spans", right, a, a, overlap=True),
        DayRange("from_to", right, a, None, None, b),
        DayRange("stab", right, None, a, b, None),
        DayRange("ends_after", right, None, None, a, None),
        DayRange("ends_between", right, None, None, a, b),
    ]

    def at_least(x, y):
        return x is not None and y is not None and x >= y

    def expected(p, s, o):
        mine = [(x, y) for q, x, y in events if q == p]
        return (
            sum(at_least(x, s) for x, y in mine),
            sum(at_least(s, x) for x, y in mine),
            sum(at_least(x, s) and at_least(o, x) for x, y in mine),
            sum(x is not None for x, y in mine),
            sum(at_least(s, x) and at_least(y, s) for x, y in mine),
            sum(at_least(x, s) and at_least(o, y) for x, y in mine),
            sum(at_least(s, x) and at_least(y, o) for x, y in mine),
            sum(x is not None and at_least(y, s) for x, y in mine),
            sum(x is not None and at_least(y, s) and at_least(o, y) for x, y in mine),
        )

    found = {r.row: tuple(r)[4:] for r in count_in_ranges(left, ["person_id"], ["start_date", "other"], ranges).collect()}
    assert found == {i: expected(p, s, o) for i, p, s, o in index}


def test_nearest_without_dates(spark):
    left = spark.createDataFrame([(1, None), (1, day(5)), (2, day(5))], "person_id int, start_date date")
    right = spark.createDataFrame([(1, None), (1, date(9999, 12, 31)), (1, date(1, 1, 1))], "person_id int, start_date date")
    questions = [Nearest("next", right, "start_date", 0, None, "first"), Nearest("last", right, "start_date", None, 0, "last")]
    found = {(r.person_id, r.start_date): (r["next"], r["last"]) for r in nearest_in_ranges(left, ["person_id"], "start_date", questions).collect()}
    assert found == {(1, None): (None, None), (1, day(5)): (date(9999, 12, 31), date(1, 1, 1)), (2, day(5)): (None, None)}


def test_an_open_window_reaches_the_last_day(spark):
    """A criterion outside observation finds a visit that never ends; absence holds for index events without an end."""
    c = cdm(spark, periods=[(1, 0, 900)], visits=[(1, 1, 20, 5, 9)], conditions=[(1, 1, 10, 0, None)])
    forever = F.lit(date(9999, 12, 31))
    c.tables["visit_occurrence"] = c.visit_occurrence.withColumn("visit_end_date", forever)
    index = attach_observation(domain_events(c, "condition"), c.observation_period)
    visit = Correlated(EventQuery("visit"), "at_least", 1, Window(0, None), end_window=Window(30, None), ignore_observation=True)
    assert filter_group(c, None, index, Group("ALL", (visit,))).count() == 1
    unknown_end = index.withColumn("end_date", F.lit(None).cast("date"))
    absent = Correlated(EventQuery("visit"), "exactly", 0, Window(0, None, from_index_end=True))
    assert filter_group(c, None, unknown_end, Group("ALL", (absent,))).count() == 1


def test_criteria_of_a_domain_read_it_once(spark, tmp_path):
    c = cdm(spark, periods=[(1, 0, 900)], conditions=[(i, 1, 10 + i % 4, i, None) for i in range(40)])
    c.condition_occurrence.write.parquet(str(tmp_path / "conditions"))
    c.tables["condition_occurrence"] = spark.read.parquet(str(tmp_path / "conditions"))
    codesets = spark.createDataFrame([(s, s) for s in range(10, 14)] + [(20, 10), (20, 11)], "codeset_id int, concept_id bigint")
    index = attach_observation(domain_events(c, "condition"), c.observation_period).filter("start_date = date'2000-01-05'")
    members = tuple(Correlated(EventQuery("condition", s), "at_least", n, Window(0, 20)) for s, n in ((10, 2), (11, 2), (12, 2), (20, 9)))
    met = filter_group(c, codesets, index, Group("ALL", members))
    plan = met._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("condition_concept_id") and sum("Relation" in x and "condition_concept_id" in x for x in plan.split("\n")) == 1
    assert met.count() == index.count()
    assert filter_group(c, codesets, index, Group("ALL", (*members[:3], Correlated(members[3].query, "at_least", 12, Window(0, 20))))).count() == 0


def test_ranges_that_ask_the_same_events_share_their_rows(spark, monkeypatch):
    added = []
    row = R._row
    monkeypatch.setattr(R, "_row", lambda *a, **more: (more or added.append(a[0]), row(*a, **more))[1])
    index = spark.sql("SELECT 1L AS person_id, DATE '2000-01-10' AS start_date, DATE '2000-02-01' AS op_end_date")
    events = spark.sql("SELECT 1L AS person_id, date_add(DATE '2000-01-01', 3 * CAST(id AS INT)) AS start_date, date_add(DATE '2000-01-04', 3 * CAST(id AS INT)) AS end_date FROM range(9)")
    start = F.col("start_date")
    ranges = [
        R.DayRange("before", events, None, start),
        R.DayRange("around", events, F.date_add(start, -3), F.date_add(start, 3)),
        R.DayRange("to_end", events, start, F.col("op_end_date")),
        R.DayRange("met", events, start, start, overlap=True),
        R.DayRange("ended", events, None, None, None, start),
    ]
    rows = R.count_in_ranges(index, ["person_id"], ["start_date", "op_end_date"], ranges).collect()
    assert [rows[0][r.name] for r in ranges] == [4, 3, 6, 2, 3]
    # Starts; starts and ends of those in order; ends.
    assert sorted(added) == [0, 1, 2, 3]
