"""Description of cohorts: counts, dates, age, sex, time in observation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epiloom.functions.cells import as_text, hide_small, percentage
from epiloom.functions.dates import age_at, days_inclusive
from epiloom.operators.events import sex_label
from epiloom.operators.observation import periods
from epiloom.sources.tables import materialize

# Age groups of the description.
AGE_GROUPS = [(0, 19), (20, 39), (40, 59), (60, 79), (80, 150)]

# Labels of the long format, with the column each one describes.
DATES = {"Cohort start date": "cohort_start_date", "Cohort end date": "cohort_end_date"}
NUMBERS = {
    "Age": "age_years",
    "Prior observation": "prior_observation",
    "Future observation": "future_observation",
    "Days in cohort": "days_in_cohort",
}


def describe_entries(cohort: DataFrame, person: DataFrame, observation_period: DataFrame) -> DataFrame:
    """Cohort rows with age, sex and days before, after and in the cohort.

    Rows outside observation stay, without days before and after.
    """
    people = person.select(
        F.col("person_id").cast("long").alias("subject_id"), "year_of_birth", sex_label(F.col("gender_concept_id")).alias("sex")
    )
    c, op = cohort.alias("c"), periods(observation_period, "subject_id").alias("op")
    inside = (F.col("c.subject_id") == F.col("op.subject_id")) & F.col("c.cohort_start_date").between(
        F.col("op.op_start_date"), F.col("op.op_end_date")
    )
    seen = c.join(op, inside, "left").select("c.*", "op.op_start_date", "op.op_end_date")
    start = F.col("cohort_start_date")
    return seen.join(people, "subject_id").select(
        "cohort_definition_id",
        "subject_id",
        "cohort_start_date",
        "cohort_end_date",
        days_inclusive(start, F.col("cohort_end_date")).alias("days_in_cohort"),
        age_at(start, F.col("year_of_birth")).alias("age_years"),
        "sex",
        F.datediff(start, "op_start_date").alias("prior_observation"),
        F.datediff("op_end_date", start).alias("future_observation"),
    )


def quantiles(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Min, quartiles and max per key as struct columns `<column>_q`; dates as day numbers.

    The percentile aggregate merges counts of distinct values, here whole days
    or years, so its state is bounded by the number of days, not rows.
    """
    aggs = []
    for c in columns:
        v = F.unix_date(c) if dict(rows.dtypes)[c] == "date" else F.col(c)
        p = F.percentile(v, [0.25, 0.5, 0.75])
        aggs.append(
            F.struct(
                F.min(v).cast("double").alias("min"), p[0].alias("q25"), p[1].alias("median"), p[2].alias("q75"),
                F.max(v).cast("double").alias("max"),
            ).alias(f"{c}_q")
        )
    return rows.groupBy(*keys).agg(*aggs)


def mean_sd(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(
        *[f(c).alias(f"{c}_{n}") for c in columns for n, f in (("mean", F.avg), ("sd", F.stddev_samp))]
    )


def conditional_counts(entries: DataFrame) -> DataFrame:
    """Per cohort: subjects, and distinct (subject, age, sex) by sex and age group.

    A subject with entries at several ages counts at each of them.
    """
    once = entries.select("cohort_definition_id", "subject_id", "age_years", "sex").distinct()

    def when(test: Column, name: str) -> Column:
        return F.sum(F.when(test, 1).otherwise(0)).alias(name)

    tests = [when(F.col("sex") == s, f"n_{s.lower()}") for s in ("Female", "Male")] + [
        when(F.col("age_years").between(a, b), f"n_{a}_{b}") for a, b in AGE_GROUPS
    ]
    names = ["n_female", "n_male", *[f"n_{a}_{b}" for a, b in AGE_GROUPS]]
    return (
        once.groupBy("cohort_definition_id", "subject_id")
        .agg(*tests)
        .groupBy("cohort_definition_id")
        .agg(F.count(F.lit(1)).alias("n_subjects"), *[F.sum(n).alias(n) for n in names])
    )


def _line(variable: str, level: str, estimate: str, kind: str, value: Column) -> Column:
    return F.struct(
        F.lit(variable).alias("variable_name"), F.lit(level).alias("variable_level"),
        F.lit(estimate).alias("estimate_name"), F.lit(kind).alias("estimate_type"), value.alias("estimate_value"),
    )


def cohort_characteristics(
    cohort: DataFrame, person: DataFrame, observation_period: DataFrame, min_cell_count: int | None = None
) -> DataFrame:
    """The long description of every cohort in the table.

    Aggregations per cohort id, then one explode of the few wide rows.
    Quartiles interpolate; a date quartile falls on the day it lies in. Counts
    below `min_cell_count`, and their percentages, are null.
    """
    # Three aggregates read the entries; stored, so that their joins run once.
    entries = materialize(describe_entries(cohort, person, observation_period), "entries")
    key = ["cohort_definition_id"]
    columns = [*DATES.values(), *NUMBERS.values()]
    numbers = list(NUMBERS.values())
    n = F.count(F.lit(1)).alias("n_records")
    q = quantiles(entries, key, columns)
    wide = entries.groupBy(*key).agg(
        n, *[f(c).alias(f"{c}_{m}") for c in numbers for m, f in (("mean", F.avg), ("sd", F.stddev_samp))]
    )
    wide = wide.join(q, key).join(conditional_counts(entries), key)

    def shown(column: str) -> Column:
        return F.col(column) if min_cell_count is None else hide_small(F.col(column), min_cell_count)

    lines = [
        _line("Number records", "NA", "count", "integer", shown("n_records").cast("string")),
        _line("Number subjects", "NA", "count", "integer", shown("n_subjects").cast("string")),
    ]
    for label, c in DATES.items():
        for e in ("min", "q25", "median", "q75", "max"):
            day = F.date_from_unix_date(F.floor(F.col(f"{c}_q.{e}")).cast("int"))
            lines.append(_line(label, "NA", e, "date", day.cast("string")))
    for label, c in NUMBERS.items():
        for e in ("min", "q25", "median", "q75", "max"):
            lines.append(_line(label, "NA", e, "integer", as_text(F.col(f"{c}_q.{e}"))))
        for e in ("mean", "sd"):
            lines.append(_line(label, "NA", e, "numeric", as_text(F.col(f"{c}_{e}"))))
    groups = [("Sex", "Female", "n_female"), ("Sex", "Male", "n_male")]
    groups += [("Age group", f"{a} to {b}", f"n_{a}_{b}") for a, b in AGE_GROUPS]
    for variable, level, c in groups:
        share = percentage(shown(c), F.col("n_subjects"))
        lines.append(_line(variable, level, "count", "integer", shown(c).cast("string")))
        lines.append(_line(variable, level, "percentage", "percentage", as_text(share)))
    return wide.select("cohort_definition_id", F.explode(F.array(*lines)).alias("l")).select(
        "cohort_definition_id",
        F.lit("cohort_name").alias("group_name"),
        F.col("cohort_definition_id").cast("string").alias("group_level"),
        F.lit("overall").alias("strata_name"),
        F.lit("overall").alias("strata_level"),
        "l.*",
        F.lit("overall").alias("additional_name"),
        F.lit("overall").alias("additional_level"),
    )
