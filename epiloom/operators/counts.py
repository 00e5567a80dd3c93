"""Cohort counts and attrition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cohort_counts(cohort: DataFrame) -> DataFrame:
    """Records and distinct subjects per cohort.

    Counted per subject first, so one large cohort is spread over all tasks.
    """
    return (
        cohort.groupBy("cohort_definition_id", "subject_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("cohort_definition_id")
        .agg(F.sum("n").alias("number_records"), F.count(F.lit(1)).alias("number_subjects"))
    )


def counts_with_zero(cohort: DataFrame, cohort_set: DataFrame) -> DataFrame:
    """Counts for every cohort of the set; cohorts without rows show 0."""
    ids = cohort_set.select("cohort_definition_id").distinct()
    return cohort_counts(cohort).join(ids, "cohort_definition_id", "right").fillna(0)


def attrition(rows: DataFrame, initial: str, steps: list[tuple[str, Column]]) -> DataFrame:
    """Records and subjects left after each step, in one pass.

    A step is a reason and a test on the row; a row is lost at its first failed
    test. `rows` must not be filtered by the steps yet.
    """
    passed = F.lit(len(steps))
    for i in range(len(steps) - 1, -1, -1):
        passed = F.when(F.coalesce(steps[i][1], F.lit(False)), passed).otherwise(i)
    ids = range(len(steps) + 1)
    per_subject = (
        rows.select("subject_id", passed.alias("passed"))
        .groupBy("subject_id")
        .agg(F.max("passed").alias("most"), *[F.sum(F.when(F.col("passed") >= i, 1).otherwise(0)).alias(f"r{i}") for i in ids])
    )
    totals = per_subject.agg(
        *[F.coalesce(F.sum(f"r{i}"), F.lit(0)).alias(f"r{i}") for i in ids],
        *[F.count(F.when(F.col("most") >= i, 1)).alias(f"s{i}") for i in ids],
    )
    reasons = [initial, *[reason for reason, _ in steps]]
    lines = [
        F.struct(
            F.lit(i + 1).alias("reason_id"),
            F.lit(reasons[i]).alias("reason"),
            F.col(f"r{i}").alias("number_records"),
            F.col(f"s{i}").alias("number_subjects"),
            (F.col(f"r{max(i - 1, 0)}") - F.col(f"r{i}")).alias("excluded_records"),
            (F.col(f"s{max(i - 1, 0)}") - F.col(f"s{i}")).alias("excluded_subjects"),
        )
        for i in ids
    ]
    return totals.select(F.explode(F.array(*lines)).alias("l")).select("l.*")
