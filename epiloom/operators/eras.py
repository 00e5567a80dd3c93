"""Cohort exit and merging of intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def exit_at_observation_end(events: DataFrame) -> DataFrame:
    return events.withColumn("end_date", F.col("op_end_date"))


def exit_fixed_offset(events: DataFrame, days: int, field: str = "start_date", cap: bool = False) -> DataFrame:
    """End = `field` + days, never before the start; `cap` stops it at the period's end."""
    end = F.greatest(F.date_add(field, days), F.col("start_date"))
    if cap:
        end = F.least(end, F.col("op_end_date"))
    return events.withColumn("end_date", end)


def era_collapse(intervals: DataFrame, keys: list[str], start: str = "start_date", end: str = "end_date", pad: int | Column = 0) -> DataFrame:
    """Merge intervals of a key that overlap, touch or lie up to `pad` days apart.

    A new era begins where a start lies after every earlier end + pad; its end is
    the latest unpadded end. Rows are first reduced to one per key and start day
    on the map side, so a window group holds at most as many rows as there are
    days, whatever share of the table one key has.
    """
    daily = intervals.groupBy(*keys, start).agg(F.max(end).alias(end)).filter(F.col(end) >= F.col(start))
    w = Window.partitionBy(*keys).orderBy(start)
    reach = F.max(F.date_add(end, pad)).over(w.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(reach.isNull() | (F.col(start) > reach), 1).otherwise(0)
    era = F.sum("_opens").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return (
        daily.withColumn("_opens", opens)
        .withColumn("_era", era)
        .groupBy(*keys, "_era")
        .agg(F.min(start).alias(start), F.max(end).alias(end))
        .drop("_era")
    )


def to_cohort(eras: DataFrame, cohort_id: int) -> DataFrame:
    """Rows of the cohort table."""
    return eras.select(
        F.lit(cohort_id).cast("long").alias("cohort_definition_id"),
        F.col("person_id").cast("long").alias("subject_id"),
        F.col("start_date").alias("cohort_start_date"),
        F.col("end_date").alias("cohort_end_date"),
    )
