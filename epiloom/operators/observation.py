"""Events and cohort entries against observation periods and deaths."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def periods(observation_period: DataFrame, person: str = "person_id") -> DataFrame:
    """(person, op_start_date, op_end_date)."""
    return observation_period.select(
        F.col("person_id").cast("long").alias(person),
        F.col("observation_period_start_date").cast("date").alias("op_start_date"),
        F.col("observation_period_end_date").cast("date").alias("op_end_date"),
    )


def attach_observation(events: DataFrame, observation_period: DataFrame, prior: int = 0, post: int = 0) -> DataFrame:
    """Events inside a period that starts `prior` days before and ends `post` after.

    Keyed on the person; a person has few periods, so the join adds no rows to
    speak of, and adaptive execution splits a partition with too many events.
    """
    inside = (F.date_add("op_start_date", prior) <= F.col("start_date")) & (
        F.date_add("start_date", post) <= F.col("op_end_date")
    )
    if prior < 0 or post < 0:
        inside = inside & F.col("start_date").between(F.col("op_start_date"), F.col("op_end_date"))
    return events.join(periods(observation_period), "person_id").filter(inside)


def in_observation(cohort: DataFrame, observation_period: DataFrame) -> DataFrame:
    """Entries whose start lies inside some observation period."""
    op = periods(observation_period, "subject_id").alias("op")
    c = cohort.alias("c")
    inside = (F.col("c.subject_id") == F.col("op.subject_id")) & F.col("c.cohort_start_date").between(
        F.col("op.op_start_date"), F.col("op.op_end_date")
    )
    return c.join(op, inside, "left_semi").select("c.*")


def prior_observation(cohort: DataFrame, observation_period: DataFrame) -> DataFrame:
    """Entries with `prior_observation`: days since the start of their period."""
    op = periods(observation_period, "subject_id")
    return (
        cohort.join(op, "subject_id")
        .filter(F.col("cohort_start_date").between(F.col("op_start_date"), F.col("op_end_date")))
        .select(*cohort.columns, F.datediff("cohort_start_date", "op_start_date").alias("prior_observation"))
    )


def study_window(cohort: DataFrame, start: date, latest: date, margin: int = 365) -> DataFrame:
    """Entries strictly after the study start and strictly before latest - margin."""
    entry = F.col("cohort_start_date")
    return cohort.filter((entry > F.lit(start)) & (entry < F.date_sub(F.lit(latest), margin)))


def observation_with_death(observation_period: DataFrame, death: DataFrame) -> DataFrame:
    """Every period with the person's death date and a 0/1 `death` flag."""
    op = periods(observation_period, "subject_id").select(
        "subject_id", F.col("op_start_date").alias("observation_period_start_date"),
        F.col("op_end_date").alias("observation_period_end_date"),
    )
    died = death.groupBy(F.col("person_id").cast("long").alias("subject_id")).agg(
        F.min(F.col("death_date").cast("date")).alias("death_date")
    )
    return op.join(died, "subject_id", "left").withColumn("death", F.col("death_date").isNotNull().cast("int"))


def latest_data_date(observation_period: DataFrame) -> DataFrame:
    """One row: the last day any person is observed."""
    return observation_period.agg(F.max(F.col("observation_period_end_date").cast("date")).alias("max_end_date"))


def require_latest_date(observation_period: DataFrame) -> date:
    """The same as a value; an empty table is an error."""
    latest = latest_data_date(observation_period).first()[0]
    if latest is None:
        raise ValueError("observation_period holds no end date")
    return latest
