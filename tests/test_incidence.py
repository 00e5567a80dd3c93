"""Denominators and incidence on edge cases and against the row-level form."""

import math
import random
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from epiloom.functions.poisson import gamma_quantile
from epiloom.operators import incidence as inc
from epiloom.operators.denominators import denominator, risk_intervals
from epiloom.operators.results import interval_rates, intervals, to_summarised_result
from epiloom.plans.study import Analysis, incidence_study, export_study, read_analyses, run_or_log, study_incidence
from epiloom.sources.tables import read_settings
from epiloom import schema
from helpers import cdm, cohort, day, rows


def row_level(denominators, outcomes, ids):
    """Months of every interval and outcome, counted one by one."""
    at_risk = inc.at_risk(inc.pair_with_outcomes(denominators, outcomes, ids))
    slices = inc.month_slices(at_risk, "cohort_start_date", "at_risk_end_date")
    return inc.with_rates(
        inc.slice_summary(slices, ["denom_id", "outcome_id"]), inc.incidence_numerator(denominators, outcomes, ids)
    )


def test_counting_once_equals_counting_every_row(spark):
    rnd = random.Random(4)
    risk, events = [], []
    for subject in range(60):
        for _ in range(rnd.randint(1, 4)):
            a = rnd.randint(0, 600)
            b = a + rnd.randint(0, 300)
            risk += [(d, subject, a, b) for d in rnd.sample([1, 2, 3], 2)]
        for outcome in (7, 8, 9):
            events += [(outcome, subject, e, e) for e in rnd.sample(range(-50, 900), rnd.randint(0, 3))]
    denominators, outcomes = cohort(spark, risk), cohort(spark, events)
    fast = inc.monthly_incidence(denominators, outcomes, [7, 8, 9])
    slow = row_level(denominators, outcomes, [7, 8, 9])
    assert rows(fast, *slow.columns) == rows(slow)


def one_person(spark, event, start=40, end=70):
    """January has 31 days, so day 40 is 10 February 2000 and day 70 is 11 March."""
    found = inc.monthly_incidence(cohort(spark, [(1, 1, start, end)]), cohort(spark, [(5, 1, event, event), (5, 2, 0, 0)]), [5])
    return rows(found, "cal_month", "outcome_count", "denom_count", "person_days")


def test_event_on_the_first_day(spark):
    assert one_person(spark, 40) == [(2, 1, 1, 1)]


def test_event_on_the_last_day(spark):
    assert one_person(spark, 70) == [(2, 0, 1, 20), (3, 1, 1, 11)]


def test_event_inside(spark):
    assert one_person(spark, 49) == [(2, 1, 1, 10)]


def test_earlier_event_removes_the_person(spark):
    assert one_person(spark, 39) == []


def test_later_event_changes_nothing(spark):
    assert one_person(spark, 71) == [(2, 0, 1, 20), (3, 0, 1, 11)]


def test_two_intervals_in_one_month_count_one_person(spark):
    risk = cohort(spark, [(1, 1, 0, 5), (1, 1, 10, 15), (1, 2, 0, 0)])
    found = inc.monthly_incidence(risk, cohort(spark, [(5, 9, 0, 0)]), [5])
    assert rows(found, "cal_month", "denom_count", "person_days") == [(1, 2, 13)]


def test_event_in_first_interval_removes_the_second(spark):
    risk = cohort(spark, [(1, 1, 0, 5), (1, 1, 10, 45)])
    found = inc.monthly_incidence(risk, cohort(spark, [(5, 1, 3, 3)]), [5])
    assert rows(found, "cal_month", "outcome_count", "person_days") == [(1, 1, 4)]


def test_listed_outcome_that_never_occurs_gives_no_rows(spark):
    found = inc.monthly_incidence(cohort(spark, [(1, 1, 0, 5)]), cohort(spark, [(5, 1, 3, 3)]), [5, 6])
    assert rows(found.select("outcome_id").distinct()) == [(5,)]


def test_rollups_take_the_largest_month(spark):
    monthly = spark.createDataFrame(
        [(1, 5, 2000, 1, 2, 10, 310), (1, 5, 2000, 2, 0, 12, 290), (1, 5, 2001, 1, 1, 3, 90)],
        "denom_id int, outcome_id int, cal_year int, cal_month int, outcome_count long, denom_count long, person_days long",
    )
    years = rows(inc.rollup_years(monthly), "cal_year", "outcome_count", "person_days", "max_monthly_denominator")
    assert years == [(2000, 2, 600, 12), (2001, 1, 90, 3)]
    assert rows(inc.rollup_overall(monthly), "outcome_count", "max_monthly_denominator") == [(3, 12)]
    spans = intervals(monthly, date(2000, 1, 1), date(2001, 6, 30), ["denom_id", "outcome_id"])
    rated = interval_rates(spans, 5).filter("interval_name = 'years' and year(interval_start_date) = 2000").first()
    # rolled up before hiding: two events are hidden with their rate, twelve people are not
    assert (rated.outcome_count, rated.incidence_100000_pys, rated.denom_count) == (None, None, 12)
    plain = interval_rates(spans, None).filter("interval_name = 'overall'").first()
    assert plain.incidence_100000_pys == pytest.approx(3 / (690 / 365.25) * 1e5)
    assert plain.incidence_100000_pys_95CI_lower == pytest.approx(0.6186721 / (690 / 365.25) * 1e5)
    assert plain.incidence_100000_pys_95CI_upper == pytest.approx(8.7672731 / (690 / 365.25) * 1e5)


def test_limits_without_events(spark):
    df = spark.createDataFrame([(0, 36525), (None, 36525), (3, 0)], "outcome_count long, person_days long")
    names = ["incidence_100000_pys_95CI_lower", "incidence_100000_pys_95CI_upper"]
    assert rows(inc.with_limits(df), *names) == [(None, None)] * 3
    found = rows(inc.with_limits(df, upper_without_events=True), *names)
    assert found[:2] == [(None, None)] * 2 and found[2] == (None, pytest.approx(3688.879454))


PERSONS = [(1, 8507, 1981, 2, 28), (2, 8532, 1980, 2, 29), (3, 8507, 1960, 0, None), (4, 0, 1960, 1, 1), (5, 8532, None, 1, 1)]


def test_bands_meet_at_the_birthday(spark):
    c = cdm(spark, PERSONS, periods=[(i, -400, 800) for i in range(1, 6)])
    found = rows(denominator(c.person, c.observation_period, day(0), day(700)))
    by = {(d, s): (a, b) for d, s, a, b in found}
    turning = (date(2000, 2, 28) - day(0)).days
    assert by[1, 1] == (0, turning - 1) and by[4, 1] == (turning, 700)
    assert by[3, 1] == by[1, 1] and by[6, 1] == by[4, 1] and (2, 1) not in by
    # born on 29 February 1980: 20 in 2000, so in band 19-39 all along, as in the female and both strata
    assert by[5, 2] == by[6, 2] == by[14, 2] == by[15, 2] == (0, 700)
    # missing month and day count as 1 January 1960: 40 on the first day
    assert by[7, 3] == (0, 700) and (4, 3) not in by
    assert {s for _, s in by} == {1, 2, 3}


def test_risk_starts_after_prior_days(spark):
    c = cdm(spark, PERSONS[:3], periods=[(1, 0, 500), (2, 0, 364), (3, 0, 365), (3, 600, 1100)])
    found = risk_intervals(c.person, c.observation_period, day(100), day(1000))
    assert rows(found, "person_id", "risk_start_date", "risk_end_date") == [(1, 365, 500), (3, 365, 365), (3, 965, 1000)]


def test_labels_fall_back_to_table_and_id(spark):
    rates = spark.createDataFrame([(1, "a"), (2, "a"), (1, "b")], "outcome_id long, outcome_table string")
    labels = spark.createDataFrame([(1, "asthma", "a"), (2, "", "a")], "cohort_id int, cohort_name string, table_name string")
    found = rows(inc.label_outcomes(rates, labels), "outcome_table", "outcome_id", "outcome_name")
    assert found == [("a", 1, "asthma"), ("a", 2, "a_2"), ("b", 1, "b_1")]


def test_standardized_rate(spark):
    data = spark.createDataFrame(
        [(2000, "young", 1, 1000), (2000, "old", 9, 1000), (2001, "young", 0, 0)],
        "year int, age string, events long, population long",
    )
    weights = spark.createDataFrame([("young", 3.0), ("old", 1.0)], "age string, weight double")
    found = inc.age_adjusted_rate(data.filter("year = 2000"), weights, ["year"], ["age"]).first()
    assert found.crude_rate == pytest.approx(500)
    assert found.adjusted_rate == pytest.approx((0.001 * 3 + 0.009) / 4 * 1e5)
    # A stratum that a year lacks has no events and keeps its weight.
    young = inc.age_adjusted_rate(data.filter("year = 2000 and age = 'old'"), weights, ["year"], ["age"]).first()
    assert young.adjusted_rate == pytest.approx(0.009 / 4 * 1e5) and young.population == 1000
    assert inc.age_adjusted_rate(data.filter("year = 2001"), weights, ["year"], ["age"]).first().adjusted_rate == 0


def test_a_hidden_count_cannot_be_computed(spark):
    rates = spark.createDataFrame(
        [(3, 10, 365, 9.0, 8.0, 10.0), (0, 10, 365, 0.0, None, None), (7, 2, 365, 7.0, 6.0, 8.0)],
        "outcome_count long, denom_count long, person_days long, incidence_100000_pys double, "
        "incidence_100000_pys_95CI_lower double, incidence_100000_pys_95CI_upper double",
    )
    found = [tuple(r) for r in inc.suppress_incidence(rates, 5).collect()]
    assert found == [(None, 10, 365, None, None, None), (0, 10, 365, 0.0, None, None), (7, None, 365, 7.0, 6.0, 8.0)]


@pytest.mark.parametrize("k", [1, 2, 15, 16, 17, 100, 1000, 10**6, 9_999_999, 10**7, 10**7 + 1])
def test_poisson_limits(k):
    """The limits put 2.5 % of the distribution on either side: summed over the counts around them."""

    def at_least(n, mean):
        last = n + int(40 + 12 * math.sqrt(mean) + abs(mean - n))
        return math.fsum(math.exp(i * math.log(mean) - mean - math.lgamma(i + 1)) for i in range(n, last))

    low, high = gamma_quantile(0.025, np.array([k]))[0], gamma_quantile(0.975, np.array([k + 1]))[0]
    assert at_least(k, low) == pytest.approx(0.025, rel=1e-7)
    assert at_least(k + 1, high) == pytest.approx(0.975, rel=1e-7)


def test_poisson_limits_of_huge_counts_are_near_normal():
    for k in (1e9, 1e12):
        assert gamma_quantile(0.025, np.array([k]))[0] == pytest.approx(k - 1.959964 * math.sqrt(k), rel=1e-8)


def test_one_bad_outcome_leaves_the_others(spark):
    c = cdm(spark, PERSONS, periods=[(i, -400, 800) for i in range(1, 6)])
    table = cohort(spark, [(1, 1, 50, 50), (2, 2, 60, 60), (3, 3, 10, 20)])
    bad = F.when(F.col("cohort_definition_id") == 2, F.raise_error(F.lit("unreadable")).cast("date"))
    table = table.withColumn("cohort_start_date", bad.otherwise(F.col("cohort_start_date")))
    strata = denominator(c.person, c.observation_period, day(0), day(700))
    analyses = [Analysis("t", i) for i in (1, 2, 3)]
    done, failed = run_or_log(spark, analyses, lambda g: study_incidence(strata, {"t": table}, g))
    assert rows(failed, "outcome_table_name", "outcome_id") == [("t", 2)]
    assert rows(done.select("outcome_id").distinct()) == [(1,), (3,)]

    def unreachable(group):
        raise OSError("disk")

    with pytest.raises(OSError):
        run_or_log(spark, analyses, unreachable)


def test_study_with_a_missing_table(spark, tmp_path):
    c = cdm(spark, PERSONS, periods=[(i, -400, 800) for i in range(1, 6)])
    table = cohort(spark, [(1, 1, 50, 50), (1, 2, 60, 60), (2, 3, 10, 20)])
    path = str(tmp_path / "analyses")
    lines = ["denominator_id,denominator_name,denominator_table_name,outcome_id,outcome_name,outcome_table_name,time_at_risk"]
    lines += [f"1,all_population,all_population,{i},x,{t},NA" for t, i in (("good", 1), ("good", 2), ("lost", 1), ("good", 1))]
    lines += ["2,other,other,9,x,good,NA"]
    (tmp_path / "analyses").write_text("\n".join(lines))
    settings = read_settings(spark, path, schema.ANALYSES)
    assert settings.first().time_at_risk is None
    analyses = read_analyses(settings)
    assert analyses == [Analysis("good", 1), Analysis("good", 2), Analysis("lost", 1)]
    labels = spark.createDataFrame([(1, "first", "good")], "cohort_id int, cohort_name string, table_name string")
    found = incidence_study(c, {"good": table}, analyses, labels, day(0), day(700), min_cell_count=0)
    assert rows(found["failed_incidence_log"], "outcome_table_name", "outcome_id") == [("lost", 1)]
    names = found["incidence"].select("outcome_name").distinct()
    assert rows(names) == [("first",), ("good_2",)]
    long = found["main_incidence_results"]
    total = long.filter(
        "group_level = 'denominator_cohort_15 &&& first' and additional_level like '%overall' and estimate_name = 'outcome_count'"
    )
    assert rows(total, "estimate_value") == [("2",)]
    assert long.columns == schema.RESULT_COLUMNS
    export_study(found, 5, str(tmp_path / "out"))
    written = spark.read.csv(str(tmp_path / "out" / "incidence_and_characteristics"), header=True)
    assert {"outcome_count", "estimate_value", "cohort_table"} <= set(written.columns)
    assert written.filter("outcome_count > 0 and outcome_count < 5").count() == 0
    with pytest.raises(KeyError):
        run_or_log(spark, analyses, lambda g: study_incidence(table, {}, g), continue_on_error=False)


def test_long_result_shape(spark):
    monthly = spark.createDataFrame(
        [(1, "x", 2000, 1, 6, 10, 310)],
        "denom_id int, outcome_name string, cal_year int, cal_month int, outcome_count long, denom_count long, person_days long",
    )
    found = to_summarised_result(monthly, date(2000, 1, 1), date(2000, 12, 31), 5)
    assert found.count() == 3 * 7 + 7
    months = found.filter(F.col("additional_level") == "2000-01-01 &&& 2000-01-31 &&& months")
    values = {r.estimate_name: r.estimate_value for r in months.collect()}
    assert values["outcome_count"] == "6" and values["person_days"] == "310.000000"


def test_limits_of_adjusted_rates(spark):
    """With one stratum they are the exact limits of its count; without events there are none."""
    from epiloom.functions.poisson import gamma_quantile
    from epiloom.operators.incidence import age_adjusted_rate

    known = spark.createDataFrame([("a", 1, 7, 1000), ("b", 1, 0, 500), ("c", 1, 3, 0)], "g string, s int, events long, population long")
    reference = spark.createDataFrame([(1, 10)], "s int, weight long")
    found = {r["g"]: r for r in age_adjusted_rate(known, reference, ["g"], ["s"], limits=True).collect()}
    low, high = gamma_quantile(0.025, [7.0])[0], gamma_quantile(0.975, [8.0])[0]
    assert found["a"]["adjusted_rate_95CI_lower"] == pytest.approx(low * 100)
    assert found["a"]["adjusted_rate_95CI_upper"] == pytest.approx(high * 100)
    assert found["b"]["adjusted_rate_95CI_lower"] is None and found["c"]["adjusted_rate_95CI_upper"] is None


def test_people_with_events_do_not_repeat_the_denominator(spark, monkeypatch):
    """Runs of months are merged for each stratum, not for each outcome; counts are those of the row-level form."""
    import random
    from datetime import date, timedelta

    from epiloom.operators import incidence as inc

    rng = random.Random(4)
    days = [date(2000, 1, 1) + timedelta(d) for d in range(150)]
    spans = [sorted((rng.choice(days), rng.choice(days[:60]))) for _ in range(400)]
    strata = [(rng.randrange(1, 3), rng.randrange(60), a, min(b, a + timedelta(rng.randrange(70)))) for a, b in spans]
    events = [(rng.randrange(1, 4), rng.randrange(60), rng.choice([*days, None])) for _ in range(100)]
    layout = "cohort_definition_id bigint, subject_id bigint, cohort_start_date date"
    denominator = spark.createDataFrame(strata, layout + ", cohort_end_date date")
    outcomes = spark.createDataFrame([e for e in events if e[2]], layout)
    merged = []
    before = inc._month_runs
    monkeypatch.setattr(inc, "_month_runs", lambda df, keys, *rest: merged.append(keys) or before(df, keys, *rest))
    shown = ["denom_id", "outcome_id", "cal_year", "cal_month", "denom_count", "person_days"]
    got = sorted(map(tuple, inc.incidence_denominator(denominator, outcomes, [1, 2, 3]).select(*shown).collect()))
    assert merged == [["denom_id"]]
    paired = inc.at_risk(inc.pair_with_outcomes(denominator, outcomes, [1, 2, 3]))
    slices = inc.month_slices(paired, "cohort_start_date", "at_risk_end_date")
    assert got and got == sorted(map(tuple, inc.slice_summary(slices, ["denom_id", "outcome_id"]).select(*shown).collect()))
