"""Study populations: features, first-only entries, samples, observation as cohort."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epiloom.functions.dates import age_at
from epiloom.functions.ordinals import number_rows
from epiloom.operators.observation import periods
from epiloom.sources.tables import materialize


def first_only(cohort: DataFrame) -> DataFrame:
    """Earliest start and earliest end per subject and cohort."""
    return cohort.groupBy("subject_id", "cohort_definition_id").agg(
        F.min("cohort_start_date").alias("cohort_start_date"), F.min("cohort_end_date").alias("cohort_end_date")
    )


def observation_as_cohort(observation_period: DataFrame, cohort_id: int, start: date | None = None, end: date | None = None) -> DataFrame:
    """Observation periods as cohort rows, clipped to the study dates."""
    op = periods(observation_period, "subject_id")
    if end is not None:
        op = op.filter(F.col("op_start_date") <= F.lit(end))
    begin, finish = F.col("op_start_date"), F.col("op_end_date")
    return op.select(
        F.lit(cohort_id).cast("long").alias("cohort_definition_id"),
        "subject_id",
        (F.greatest(begin, F.lit(start)) if start else begin).alias("cohort_start_date"),
        (F.least(finish, F.lit(end)) if end else finish).alias("cohort_end_date"),
    )


def anchor_start(cohort: DataFrame, anchor: date) -> DataFrame:
    """Starts on or before the anchor become the anchor."""
    start = F.col("cohort_start_date")
    return cohort.withColumn("cohort_start_date", F.greatest(start, F.lit(anchor)))


def _observed(cohort: DataFrame, cdm, start: date | None, end: date | None, washout: int) -> DataFrame:
    op = periods(cdm.observation_period, "subject_id")
    entry = F.col("cohort_start_date")
    keep = entry.between(F.col("op_start_date"), F.col("op_end_date"))
    if start is not None:
        keep = keep & (entry >= F.lit(start))
    if end is not None:
        keep = keep & (entry < F.lit(end))
    if washout:
        keep = keep & (F.datediff(entry, "op_start_date") >= washout)
    people = cdm.person.select(
        F.col("person_id").cast("long").alias("subject_id"), "year_of_birth", "gender_concept_id"
    )
    return cohort.join(op, "subject_id").filter(keep).join(people, "subject_id")


def sample_n(rows: DataFrame, n: int) -> DataFrame:
    """First `n` rows in a fixed scrambled order of subject and entry date.

    A top-n: every task keeps at most `n` rows.
    """
    entry = F.col("cohort_start_date")
    # The factors of the scrambled order.
    scrambled = ((F.col("subject_id") * F.month(entry)) % 123) * ((F.year(entry) * F.day(entry)) % 123)
    return rows.orderBy(scrambled, "subject_id", entry, "cohort_end_date", "cohort_definition_id").limit(n)


def population_features(
    cohort: DataFrame,
    cdm,
    start: date | None = None,
    end: date | None = None,
    first: bool = False,
    washout: int = 0,
    sample: int | None = None,
) -> DataFrame:
    """Numbered entries with days from and to the edges of observation, age and sex.

    Days to the end of cohort and observation stop at the study end.
    """
    rows = _observed(first_only(cohort) if first else cohort, cdm, start, end, washout)
    if sample is not None:
        rows = sample_n(rows, sample)
    entry = F.col("cohort_start_date")

    def until(last: str):
        stop = F.col(last) if end is None else F.least(F.col(last), F.lit(end))
        return F.datediff(stop, entry)

    ties = ["cohort_end_date", "cohort_definition_id", "op_start_date"]
    rows = materialize(rows, "population")  # each level of numbering reads them
    numbered = number_rows(rows, "subject_id", "cohort_start_date", ties, "row_id")
    return numbered.select(
        "row_id",
        "subject_id",
        "cohort_definition_id",
        "cohort_start_date",
        "cohort_end_date",
        F.datediff(entry, "op_start_date").alias("days_from_obs_start"),
        until("cohort_end_date").alias("days_to_cohort_end"),
        until("op_end_date").alias("days_to_obs_end"),
        age_at(entry, F.col("year_of_birth")).alias("age_year"),
        F.col("gender_concept_id").alias("gender"),
    )
