"""Populations at risk: sex by age-band strata with clipped intervals."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epiloom import schema
from epiloom.functions.dates import birth_date, birthday
from epiloom.operators.observation import periods

# Age bands (first age, last age) and sexes, in the order that
# numbers the strata 1 to 15.
AGE_BANDS = [(0, 18), (19, 39), (40, 65), (66, 150), (0, 150)]
SEXES = [(schema.MALE,), (schema.FEMALE,), (schema.MALE, schema.FEMALE)]


def risk_intervals(person: DataFrame, observation_period: DataFrame, start: date, end: date, prior_days: int = 365) -> DataFrame:
    """Distinct (person_id, gender_concept_id, dob, risk_start_date, risk_end_date).

    Risk starts after `prior_days` of observation or at the study start,
    whichever is later, and ends with the observation or the study.
    """
    op = periods(observation_period).filter(
        (F.col("op_end_date") >= F.lit(start)) & (F.col("op_start_date") <= F.lit(end))
    )
    people = person.filter(
        F.col("year_of_birth").isNotNull() & F.col("gender_concept_id").isin(schema.MALE, schema.FEMALE)
    ).select(
        F.col("person_id").cast("long").alias("person_id"),
        "gender_concept_id",
        birth_date(F.col("year_of_birth"), F.col("month_of_birth"), F.col("day_of_birth")).alias("dob"),
    )
    return (
        op.select(
            "person_id",
            F.greatest(F.date_add("op_start_date", prior_days), F.lit(start)).alias("risk_start_date"),
            F.least(F.col("op_end_date"), F.lit(end)).alias("risk_end_date"),
        )
        .filter("risk_start_date <= risk_end_date")
        .distinct()
        .join(people, "person_id")
    )


def strata(intervals: DataFrame, bands: list[tuple[int, int]] = AGE_BANDS, sexes: list[tuple[int, ...]] = SEXES) -> DataFrame:
    """Risk intervals cut to every age band and labelled per sex, as cohort rows.

    Stratum ids count sexes within bands from 1. The all-ages band (0 to 150) is
    not cut at birth. One explode per row; nothing is shuffled.
    """
    cells = []
    for b, (low, high) in enumerate(bands):
        begin = F.col("risk_start_date")
        if (low, high) != (0, 150):
            begin = F.greatest(birthday(F.col("dob"), low), begin)
        finish = F.least(F.date_sub(birthday(F.col("dob"), high + 1), 1), F.col("risk_end_date"))
        for s, concepts in enumerate(sexes):
            cell = F.struct(
                F.lit(b * len(sexes) + s + 1).cast("long").alias("cohort_definition_id"),
                begin.alias("cohort_start_date"),
                finish.alias("cohort_end_date"),
            )
            cells.append(F.when(F.col("gender_concept_id").isin(*concepts) & (begin <= finish), cell))
    return intervals.select(
        F.col("person_id").alias("subject_id"), F.explode(F.array_compact(F.array(*cells))).alias("c")
    ).select("c.cohort_definition_id", "subject_id", "c.cohort_start_date", "c.cohort_end_date")


def denominator(
    person: DataFrame,
    observation_period: DataFrame,
    start: date,
    end: date,
    prior_days: int = 365,
    bands: list[tuple[int, int]] = AGE_BANDS,
    sexes: list[tuple[int, ...]] = SEXES,
) -> DataFrame:
    return strata(risk_intervals(person, observation_period, start, end, prior_days), bands, sexes)


def sex_totals(bands: list[tuple[int, int]] = AGE_BANDS, sexes: list[tuple[int, ...]] = SEXES) -> dict[int, tuple[int, ...]]:
    """The strata of several sexes, each with the strata of one sex that make it up: a person is in one of these only."""
    single = {concepts[0]: s for s, concepts in enumerate(sexes) if len(concepts) == 1}
    return {
        b * len(sexes) + s + 1: tuple(b * len(sexes) + single[c] + 1 for c in concepts)
        for b in range(len(bands))
        for s, concepts in enumerate(sexes)
        if len(set(concepts)) == len(concepts) > 1 and all(c in single for c in concepts)
    }
