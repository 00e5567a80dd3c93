"""Symptoms and conditions after an infection.

Infections pass entry conditions and get a follow-up; symptom and condition
cohorts that follow a clear period are kept; people with one, two and three of
them form six cohorts.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epiloom.functions.cells import suppress_small
from epiloom.operators.counts import attrition, cohort_counts
from epiloom.operators.followup import (
    censor_reason,
    follow_up_end,
    intersect_dates,
    k_of_n_levels,
    outcome_after_index,
    target_start,
)
from epiloom.operators.observation import observation_with_death
from epiloom.sources.tables import materialize

# The six result cohorts.
COHORT_NAMES = {
    1: "long_covid_one_symptom",
    2: "long_covid_two_symptoms",
    3: "long_covid_three_symptoms",
    4: "pasc_one_event",
    5: "pasc_two_events",
    6: "pasc_three_events",
}


@dataclass(frozen=True)
class EntryRules:
    """Conditions on infections; cohort ids are those of the acute table."""

    study_start: date
    latest: date
    infection_id: int = 1
    influenza_id: int = 2
    washout_days: int = 42
    prior_days: int = 365
    influenza_days: int = 90
    margin_days: int = 365
    next_within: int = 365
    follow_up_days: int = 120


def infections(acute: DataFrame, observation_period: DataFrame, death: DataFrame, rules: EntryRules) -> DataFrame:
    """All infections with everything the entry conditions ask about.

    Nothing is filtered yet, so the attrition table and the kept rows come from
    the same frame. The follow-up uses the period that holds the entry.
    """

    def of(cohort_id: int) -> DataFrame:
        return acute.filter(F.col("cohort_definition_id") == cohort_id)

    entries = of(rules.infection_id)
    known = intersect_dates(
        entries,
        [
            target_start("previous_date", entries, None, -1, "last"),
            target_start("influenza_date", of(rules.influenza_id), -rules.influenza_days, -1, "last"),
            target_start("next_date", entries, 1, rules.next_within, "first"),
        ],
    )
    obs = observation_with_death(observation_period, death).alias("o")
    k = known.alias("k")
    inside = (F.col("k.subject_id") == F.col("o.subject_id")) & F.col("k.cohort_start_date").between(
        F.col("o.observation_period_start_date"), F.col("o.observation_period_end_date")
    )
    seen = k.join(obs, inside, "left").select(
        "k.*", "o.observation_period_start_date", "o.observation_period_end_date", "o.death_date"
    )
    end = follow_up_end(F.col("observation_period_end_date"), F.col("death_date"), F.col("next_date"))
    reason = censor_reason(
        F.col("follow_up_end"), F.col("observation_period_end_date"), F.col("death_date"), F.col("next_date")
    )
    return (
        seen.withColumn("follow_up_end", end)
        .withColumn("follow_up_days", F.datediff("follow_up_end", "cohort_start_date"))
        .withColumn("reason_censoring", reason)
    )


def entry_steps(rules: EntryRules) -> list[tuple[str, Column]]:
    entry = F.col("cohort_start_date")
    previous = F.datediff("previous_date", entry)
    before = F.date_sub(F.lit(rules.latest), rules.margin_days)
    return [
        ("Event washout", previous.isNull() | (previous < -rules.washout_days)),
        ("In observation at cohort entry", F.col("observation_period_end_date").isNotNull()),
        (f"{rules.prior_days} days of prior history", F.datediff(entry, "observation_period_start_date") >= rules.prior_days),
        ("Historical influenza", F.col("influenza_date").isNull()),
        ("Entry in the study window", (entry > F.lit(rules.study_start)) & (entry < before)),
        (f">={rules.follow_up_days} days of follow-up", F.col("follow_up_days") >= rules.follow_up_days),
    ]


def kept_infections(known: DataFrame, rules: EntryRules) -> DataFrame:
    """Infections that pass all conditions, ending with their follow-up."""
    rows = known
    for _, test in entry_steps(rules):
        rows = rows.filter(test)
    return rows.select(
        F.lit(1).cast("long").alias("cohort_definition_id"), "subject_id", "cohort_start_date",
        F.col("follow_up_end").alias("cohort_end_date"),
    )


def entry_attrition(known: DataFrame, rules: EntryRules) -> DataFrame:
    return attrition(known, "Initial events", entry_steps(rules))


def censoring_reasons(known: DataFrame, rules: EntryRules) -> DataFrame:
    """Infections lost to a short follow-up, by what ended it."""
    rows = known
    for _, test in entry_steps(rules)[:-1]:
        rows = rows.filter(test)
    return (
        rows.filter(F.col("follow_up_days") < rules.follow_up_days)
        .groupBy("reason_censoring")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def overlap_cohorts(kept: DataFrame, symptoms: DataFrame, conditions: DataFrame) -> DataFrame:
    """The six cohorts of people with at least one, two, three symptoms or conditions.

    The kept infections are stored first, as both halves start from them.
    """
    kept = materialize(kept, "infections")
    after = [outcome_after_index(kept, table) for table in (symptoms, conditions)]
    return k_of_n_levels(after[0], {1: 1, 2: 2, 3: 3}).unionByName(k_of_n_levels(after[1], {1: 4, 2: 5, 3: 6}))


def final_counts(tables: dict[str, DataFrame], names: dict[str, dict[int, str]], min_cell_count: int) -> DataFrame:
    """Records and subjects of every named cohort of every table; small numbers are hidden, cohorts without rows count 0."""
    parts = []
    for table, rows in tables.items():
        lines = [F.struct(F.lit(i).cast("long").alias("cohort_definition_id"), F.lit(n).alias("cohort_name")) for i, n in names[table].items()]
        named = rows.sparkSession.range(1).select(F.inline(F.array(*lines)))
        counted = named.join(cohort_counts(rows), "cohort_definition_id", "left").fillna(0, ["number_records", "number_subjects"])
        parts.append(counted.select(F.lit(table).alias("cohort_table"), "cohort_definition_id", "cohort_name", "number_records", "number_subjects"))
    return suppress_small(reduce(DataFrame.unionByName, parts), ["number_records", "number_subjects"], min_cell_count)
