"""Incidence: people at risk, person-time, first events and rates per month.

Person-time of a stratum does not depend on the outcome except for people who
have the outcome. So the plan counts every stratum once, and per outcome takes
away what people lose after their first event. No denominator row is repeated
per outcome, and no interval is spread over its months: an interval adds 1 to
the running count at its first month and takes 1 away after its last.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epiloom.functions.cells import hide_small, suppress_small
from epiloom.functions.dates import clip_to_month, days_inclusive, month_from_number, month_grid, month_number
from epiloom.functions.poisson import poisson_limits, rate, weighted_limits


def first_event(outcomes: DataFrame) -> DataFrame:
    """First event ever per subject and outcome: (outcome_id, subject_id, first_event_date)."""
    return outcomes.groupBy(F.col("cohort_definition_id").alias("outcome_id"), "subject_id").agg(
        F.min("cohort_start_date").alias("first_event_date")
    )


def pair_with_outcomes(denominator: DataFrame, outcomes: DataFrame, outcome_ids: list[int]) -> DataFrame:
    """Every denominator row with every listed outcome and its first event, if any.

    The row-level form, as wide as denominator x outcomes; `monthly_incidence`
    does not need it.
    """
    rows = denominator.filter("cohort_start_date <= cohort_end_date").select(
        F.col("cohort_definition_id").alias("denom_id"),
        F.explode(F.lit(outcome_ids).cast("array<bigint>")).alias("outcome_id"),
        "subject_id",
        "cohort_start_date",
        "cohort_end_date",
    )
    return rows.join(first_event(outcomes), ["outcome_id", "subject_id"], "left")


def at_risk(paired: DataFrame) -> DataFrame:
    """Risk ends with the first event; people with an earlier event leave."""
    first = F.col("first_event_date")
    return paired.filter(first.isNull() | (first >= F.col("cohort_start_date"))).withColumn(
        "at_risk_end_date", F.least("first_event_date", "cohort_end_date")
    )


def month_slices(intervals: DataFrame, start: str, end: str) -> DataFrame:
    """One row per interval and calendar month it meets, clipped to the month."""
    rows = intervals.withColumn("month_start", F.explode(month_grid(F.col(start), F.col(end))))
    first, last = clip_to_month(F.col(start), F.col(end), F.col("month_start"))
    return rows.withColumns({"start_in_month": first, "end_in_month": last})


def slice_summary(slices: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct subjects and person-days per key and month of month slices."""
    return slices.groupBy(
        *keys, F.year("month_start").alias("cal_year"), F.month("month_start").alias("cal_month")
    ).agg(
        F.countDistinct("subject_id").alias("denom_count"),
        F.sum(days_inclusive(F.col("start_in_month"), F.col("end_in_month"))).alias("person_days"),
    )


def _changes(intervals: DataFrame, keys: list[str], opened: dict[str, Column], closed: dict[str, Column]) -> DataFrame:
    """Sums per key and month of what begins and what ends there, in one pass.

    Each side gives `month` and the columns to add up; the other side's are 0.
    """
    names = [c for c in (*opened, *closed) if c != "month"]

    def side(values: dict[str, Column]) -> Column:
        return F.struct(
            values["month"].cast("long").alias("month"),
            *[values.get(c, F.lit(0)).cast("long").alias(c) for c in names],
        )

    rows = intervals.select(*keys, F.explode(F.array(side(opened), side(closed))).alias("c"))
    return rows.groupBy(*keys, F.col("c.month").alias("month")).agg(*[F.sum(f"c.{c}").alias(c) for c in names])


def _running(changes: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Running totals of `columns` for every month from a key's first to its last change.

    Months without a change repeat the totals of the month before.
    """
    w = Window.partitionBy(*keys).orderBy("month")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    following = F.coalesce(F.lead("month").over(w), F.col("month") + 1)
    totals = changes.select(*keys, "month", following.alias("_next"), *[F.sum(c).over(upto).alias(c) for c in columns])
    return totals.withColumn("month", F.explode(F.sequence(F.col("month"), F.col("_next") - 1))).drop("_next")


def person_days_by_month(intervals: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """Days of all intervals per key and month: (keys, month, person_days).

    Reduced to counts and sums of day numbers per key and month on the map side.
    Up to a month's last day M, intervals begun by M hold M + 1 - start days,
    less M - end for those that ended.
    """
    s, e = F.col(start), F.col(end)
    opened = {"month": month_number(s), "s_n": F.lit(1), "s_sum": F.unix_date(s)}
    closed = {"month": month_number(e), "e_n": F.lit(1), "e_sum": F.unix_date(e)}
    running = _running(_changes(intervals, keys, opened, closed), keys, ["s_n", "s_sum", "e_n", "e_sum"])
    last = F.unix_date(F.last_day(month_from_number(F.col("month"))))
    upto = (last + 1) * F.col("s_n") - F.col("s_sum") - (last * F.col("e_n") - F.col("e_sum"))
    w = Window.partitionBy(*keys).orderBy("month")
    days = F.col("_upto") - F.coalesce(F.lag("_upto").over(w), F.lit(0))
    return running.withColumn("_upto", upto).select(*keys, "month", days.alias("person_days"))


def subjects_by_month(intervals: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """Distinct subjects with a day in each month: (keys, month, denom_count).

    Intervals of a subject are merged into runs of months first, so that a
    subject counts once; a subject has at most one row per starting month.
    """
    return _subjects(_month_runs(intervals, keys, start, end), keys)


def _month_runs(intervals: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """(keys, subject_id, _a, _b, _first): runs of months `_a` to `_b` that share none, and the earliest start of an interval behind each."""
    runs = intervals.groupBy(*keys, "subject_id", month_number(F.col(start)).alias("_a")).agg(
        F.max(month_number(F.col(end))).alias("_b"), F.min(start).alias("_first")
    )
    w = Window.partitionBy(*keys, "subject_id").orderBy("_a")
    seen = F.max("_b").over(w.rowsBetween(Window.unboundedPreceding, -1))
    # Only the months past those already counted open a new run.
    fresh = runs.withColumn("_seen", seen).withColumn("_a", F.greatest(F.col("_a"), F.col("_seen") + 1)).filter("_a <= _b")
    return fresh.drop("_seen")


def _subjects(runs: DataFrame, keys: list[str]) -> DataFrame:
    """Subjects per key and month of runs that share no month of a subject."""
    opened = {"month": F.col("_a"), "s_n": F.lit(1)}
    closed = {"month": F.col("_b") + 1, "e_n": F.lit(1)}
    running = _running(_changes(runs, keys, opened, closed), keys, ["s_n", "e_n"])
    return running.select(*keys, "month", (F.col("s_n") - F.col("e_n")).alias("denom_count"))


def _parts(denominator: DataFrame, totals: dict[int, tuple[int, ...]]) -> DataFrame:
    """The rows of a denominator without the strata that are sums of others."""
    return denominator.filter(~F.col("cohort_definition_id").isin(list(totals))) if totals else denominator


def _with_totals(counts: DataFrame, totals: dict[int, tuple[int, ...]], columns: list[str]) -> DataFrame:
    """Counts per stratum, and those of each total as the sum of its parts."""
    if not totals:
        return counts
    into: dict[int, list[int]] = {}
    for total, parts in totals.items():
        for part in parts:
            into.setdefault(part, []).append(total)
    known = F.create_map(*[F.lit(v) for part, all_ in into.items() for v in (part, all_)]).cast("map<bigint,array<bigint>>")
    own = F.array(F.col("denom_id").cast("bigint"))
    ids = F.concat(own, F.coalesce(F.element_at(known, F.col("denom_id").cast("bigint")), F.array().cast("array<bigint>")))
    keys = [c for c in counts.columns if c not in columns]
    return (
        counts.withColumn("denom_id", F.explode(ids))
        .groupBy(*keys)
        .agg(*[F.sum(c).alias(c) for c in columns])
        .select(*counts.columns)
    )


def incidence_denominator(
    denominator: DataFrame, outcomes: DataFrame, outcome_ids: list[int], totals: dict[int, tuple[int, ...]] | None = None
) -> DataFrame:
    """(denom_id, outcome_id, cal_year, cal_month, denom_count, person_days).

    `totals` names strata that are sums of others which share no person (`denominators.sex_totals`):
    their rows are not read, and their counts are added up from the monthly ones.
    """
    return _with_totals(_denominator(_parts(denominator, totals or {}), outcomes, outcome_ids), totals or {}, ["denom_count", "person_days"])


def _denominator(denominator: DataFrame, outcomes: DataFrame, outcome_ids: list[int]) -> DataFrame:
    rows = denominator.filter("cohort_start_date <= cohort_end_date").select(
        F.col("cohort_definition_id").alias("denom_id"), "subject_id", "cohort_start_date", "cohort_end_date"
    )
    wanted = outcomes.filter(F.col("cohort_definition_id").isin(outcome_ids))
    start, end, event = F.col("cohort_start_date"), F.col("cohort_end_date"), F.col("first_event_date")

    firsts = first_event(wanted)

    def signed(df: DataFrame, sign: int, *columns: Column | str) -> DataFrame:
        of = F.lit(None).cast("long").alias("outcome_id") if sign > 0 else "outcome_id"
        return df.select("denom_id", of, F.lit(sign).alias("sign"), *columns)

    # Everyone, for no outcome in particular. Then, for people with an outcome, what lies after their event is taken away:
    # days, and months without a day up to it. Events after the end change nothing.
    after = rows.join(firsts, "subject_id").filter(~F.coalesce(event >= end, F.lit(False)))
    after = after.withColumn("cohort_start_date", F.greatest(start, F.date_add(event, 1)))
    dates = [start.alias("start"), end.alias("end")]
    days = signed(rows, 1, *dates).unionByName(signed(after, -1, *dates))

    # A run has a day up to the event in the event's month if one of its intervals has begun by then.
    runs = _month_runs(rows, ["denom_id"], "cohort_start_date", "cohort_end_date")
    month = month_number(event)
    lost = F.greatest("_a", F.when(F.col("_first") <= event, month + 1).otherwise(month))
    gone = runs.join(firsts, "subject_id").withColumn("_a", lost).filter("_a <= _b")
    seen = signed(runs, 1, "_a", "_b").unionByName(signed(gone, -1, "_a", "_b"))

    keys = ["denom_id", "outcome_id", "sign"]
    counts = person_days_by_month(days, keys, "start", "end").unionByName(_subjects(seen, keys), allowMissingColumns=True)
    counts = counts.groupBy("denom_id", "outcome_id", "month").agg(
        F.sum(F.col("person_days") * F.col("sign")).alias("person_days"),
        F.sum(F.col("denom_count") * F.col("sign")).alias("denom_count"),
    )
    # The counts of everyone hold for each outcome that occurs at all.
    listed = F.array(*[F.lit(i).cast("long") for i in outcome_ids])
    occurring = wanted.select(F.col("cohort_definition_id").alias("outcome_id")).distinct()
    return (
        counts.withColumn("outcome_id", F.explode(F.coalesce(F.when(F.col("outcome_id").isNull(), listed), F.array("outcome_id"))))
        .join(occurring, "outcome_id", "left_semi")
        .groupBy("denom_id", "outcome_id", "month")
        .agg(F.sum("denom_count").alias("denom_count"), F.sum("person_days").alias("person_days"))
        .filter("person_days > 0")
        .select(
            "denom_id",
            "outcome_id",
            F.floor(F.col("month") / 12).cast("int").alias("cal_year"),
            (F.col("month") % 12 + 1).cast("int").alias("cal_month"),
            "denom_count",
            "person_days",
        )
    )


def incidence_numerator(
    denominator: DataFrame, outcomes: DataFrame, outcome_ids: list[int], totals: dict[int, tuple[int, ...]] | None = None
) -> DataFrame:
    """First events inside a denominator interval, per stratum, outcome and month; `totals` as in `incidence_denominator`."""
    return _with_totals(_numerator(_parts(denominator, totals or {}), outcomes, outcome_ids), totals or {}, ["outcome_count"])


def _numerator(denominator: DataFrame, outcomes: DataFrame, outcome_ids: list[int]) -> DataFrame:
    firsts = first_event(outcomes.filter(F.col("cohort_definition_id").isin(outcome_ids)))
    rows = denominator.select(
        F.col("cohort_definition_id").alias("denom_id"), "subject_id", "cohort_start_date", "cohort_end_date"
    )
    return (
        rows.join(firsts, "subject_id")
        .filter(F.col("first_event_date").between(F.col("cohort_start_date"), F.col("cohort_end_date")))
        .groupBy(
            "denom_id",
            "outcome_id",
            F.year("first_event_date").alias("cal_year"),
            F.month("first_event_date").alias("cal_month"),
        )
        .agg(F.count(F.lit(1)).alias("outcome_count"))
    )


def with_rates(at_risk_summary: DataFrame, events: DataFrame) -> DataFrame:
    """Rates per 100 000 person-years; a month without events counts 0."""
    keys = ["denom_id", "outcome_id", "cal_year", "cal_month"]
    joined = at_risk_summary.join(events, keys, "left").fillna(0, ["outcome_count"])
    return joined.select(
        *keys,
        "outcome_count",
        "denom_count",
        "person_days",
        (F.col("person_days") / F.lit(365.25)).alias("person_years"),
        rate(F.col("outcome_count"), F.col("person_days")).alias("incidence_100000_pys"),
    )


def monthly_incidence(
    denominator: DataFrame, outcomes: DataFrame, outcome_ids: list[int], totals: dict[int, tuple[int, ...]] | None = None
) -> DataFrame:
    """All outcomes and strata in one job, unsuppressed; `totals` as in `incidence_denominator`."""
    return with_rates(
        incidence_denominator(denominator, outcomes, outcome_ids, totals),
        incidence_numerator(denominator, outcomes, outcome_ids, totals),
    )


def roll_up(monthly: DataFrame, keys: list[str]) -> DataFrame:
    """Sums of events and days; the people count is the largest monthly one."""
    return monthly.groupBy(*keys).agg(
        F.sum("outcome_count").alias("outcome_count"),
        F.sum("person_days").alias("person_days"),
        F.max("denom_count").alias("max_monthly_denominator"),
    )


def rollup_years(monthly: DataFrame, keys: tuple[str, ...] = ("denom_id", "outcome_id")) -> DataFrame:
    return roll_up(monthly, [*keys, "cal_year"])


def rollup_overall(monthly: DataFrame, keys: tuple[str, ...] = ("denom_id", "outcome_id")) -> DataFrame:
    return roll_up(monthly, list(keys))


def with_limits(rates: DataFrame, upper_without_events: bool = False) -> DataFrame:
    """Exact 95 % limits of the rate; null where there are no events.

    `upper_without_events` gives a count of 0 its upper limit.
    """
    per = F.col("person_days") / F.lit(365.25)
    limits = rates.withColumn("_ci", poisson_limits(F.col("outcome_count").cast("double")))
    ok = F.col("person_days") > 0
    upper = F.col("_ci.upper")
    if upper_without_events:
        upper = F.when(F.col("outcome_count") == 0, -math.log(0.025)).otherwise(upper)
    return limits.select(
        *rates.columns,
        F.when(ok, F.col("_ci.lower") / per * 100_000).alias("incidence_100000_pys_95CI_lower"),
        F.when(ok, upper / per * 100_000).alias("incidence_100000_pys_95CI_upper"),
    )


def suppress_incidence(rates: DataFrame, min_cell_count: int) -> DataFrame:
    """Small counts hidden, and with a hidden event count the rate and its limits, from which it follows."""
    shown = hide_small(F.col("outcome_count"), min_cell_count).isNotNull()
    follows = {c: F.when(shown, F.col(c)) for c in rates.columns if c.startswith("incidence_100000")}
    return suppress_small(rates.withColumns(follows), ["outcome_count", "denom_count"], min_cell_count)


def label_outcomes(rates: DataFrame, labels: DataFrame) -> DataFrame:
    """Outcome names from (cohort_id, cohort_name, table_name); else `table_id`."""
    named = labels.select(
        F.col("cohort_id").cast("long").alias("outcome_id"), "cohort_name", F.col("table_name").alias("outcome_table")
    )
    name = F.when(F.col("cohort_name") != "", F.col("cohort_name"))
    return (
        rates.join(named, ["outcome_id", "outcome_table"], "left")
        .withColumn("outcome_name", F.coalesce(name, F.concat_ws("_", "outcome_table", "outcome_id")))
        .drop("cohort_name")
    )


def age_adjusted_rate(
    stratum_rates: DataFrame, reference: DataFrame, by: list[str], strata: list[str], limits: bool = False
) -> DataFrame:
    """Direct standardization: rates weighted by a reference population.

    `stratum_rates` holds events and population per (by, strata); `reference`
    holds `weight` per strata. Every group is completed to all strata of the
    reference: those absent from its data count no events and keep their weight.
    Strata that the reference does not have count nowhere. With `limits`, 95 % limits of the adjusted rate follow.
    """
    weights = reference.select(*strata, "weight")
    # Groups of an aggregate against the strata of a reference: few rows on both sides.
    listed = weights.agg(F.collect_list(F.struct(*strata, "weight")).alias("_all"))
    full = stratum_rates.select(*by).distinct().withColumn("_s", F.explode(listed.scalar())).select(*by, "_s.*")
    keys = [*by, *strata]
    known = stratum_rates.select(*[F.col(c).alias(f"_of_{c}") for c in keys], "events", "population")
    joined = full.join(known, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in keys], "left")
    joined = joined.select(*keys, "weight", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("events", "population")])
    weighted = F.when(F.col("population") > 0, F.col("events") / F.col("population") * F.col("weight")).otherwise(0.0)
    per_event = F.when(F.col("population") > 0, F.col("weight") / F.col("population"))
    sums = joined.groupBy(*by).agg(
        F.sum("events").alias("events"),
        F.sum("population").alias("population"),
        (F.try_divide(F.sum("events"), F.sum("population")) * 100_000).alias("crude_rate"),
        (F.sum(weighted) / F.sum("weight") * 100_000).alias("adjusted_rate"),
        (F.sum(F.col("events") * per_event * per_event) / F.sum("weight") / F.sum("weight")).alias("_variance"),
        (F.max(per_event) / F.sum("weight")).alias("_widest"),
    )
    if not limits:
        return sums.drop("_variance", "_widest")
    found = weighted_limits(F.col("adjusted_rate") / 100_000, F.col("_variance"), F.col("_widest"))
    sums = sums.withColumn("_limits", found)
    return sums.withColumns(
        {f"adjusted_rate_95CI_{side}": F.col(f"_limits.{side}") * 100_000 for side in ("lower", "upper")}
    ).drop("_variance", "_widest", "_limits")
