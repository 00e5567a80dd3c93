"""Clinical tables in one common event shape, and filters on single events."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epiloom import schema
from epiloom.functions.dates import age_at
from epiloom.sources.tables import Cdm


@dataclass(frozen=True)
class Domain:
    """Where a table keeps the parts of an event.

    `end` is the stored end; without one, or where it is null and `day_long`
    holds, the event ends on the day after its start.
    """

    table: str
    event: str
    concept: str | None
    start: str
    end: str | None = None
    day_long: bool = True
    visit: bool = True


# Column names of the common data model.
DOMAINS = {
    "condition": Domain("condition_occurrence", "condition_occurrence_id", "condition_concept_id", "condition_start_date", "condition_end_date"),
    "drug": Domain("drug_exposure", "drug_exposure_id", "drug_concept_id", "drug_exposure_start_date", "drug_exposure_end_date"),
    "procedure": Domain("procedure_occurrence", "procedure_occurrence_id", "procedure_concept_id", "procedure_date"),
    "measurement": Domain("measurement", "measurement_id", "measurement_concept_id", "measurement_date"),
    "observation": Domain("observation", "observation_id", "observation_concept_id", "observation_date"),
    "visit": Domain("visit_occurrence", "visit_occurrence_id", "visit_concept_id", "visit_start_date", "visit_end_date", day_long=False),
    "death": Domain("death", "person_id", "cause_concept_id", "death_date", visit=False),
    "drug_era": Domain("drug_era", "drug_era_id", "drug_concept_id", "drug_era_start_date", "drug_era_end_date", day_long=False, visit=False),
    "observation_period": Domain(
        "observation_period", "observation_period_id", "period_type_concept_id",
        "observation_period_start_date", "observation_period_end_date", day_long=False, visit=False,
    ),
}


def domain_events(cdm: Cdm, domain: str) -> DataFrame:
    """All events of a domain in the common shape."""
    d = DOMAINS[domain]
    start = F.col(d.start).cast("date")
    if d.end is None:
        end = F.date_add(start, 1)
    else:
        end = F.col(d.end).cast("date")
        if d.day_long:
            end = F.coalesce(end, F.date_add(start, 1))
    no_id = F.lit(None).cast("long")
    return getattr(cdm, d.table).select(
        F.col("person_id").cast("long").alias("person_id"),
        F.col(d.event).cast("long").alias("event_id"),
        start.alias("start_date"),
        end.alias("end_date"),
        (F.col(d.concept).cast("long") if d.concept else no_id).alias("target_concept_id"),
        (F.col("visit_occurrence_id").cast("long") if d.visit else no_id).alias("visit_occurrence_id"),
    )


def longer_than(eras: DataFrame, days: int) -> DataFrame:
    """Eras of more than so many days."""
    return eras.filter(F.datediff("end_date", "start_date") > days)


def compare(value: Column, op: str, bound, extent=None) -> Column:
    """One comparison of a criterion: gt, gte, lt, lte, eq, bt (between)."""
    if op == "bt":
        return value.between(bound, extent)
    return {
        "gt": value > bound,
        "gte": value >= bound,
        "lt": value < bound,
        "lte": value <= bound,
        "eq": value == bound,
    }[op]


def filter_date(events: DataFrame, op: str, value: date, extent: date | None = None, column: str = "start_date") -> DataFrame:
    """Keep events whose start (or other) date passes a comparison."""
    bound = [F.lit(value), F.lit(extent) if extent is not None else None]
    return events.filter(compare(F.col(column), op, *bound))


def filter_age(events: DataFrame, person: DataFrame, op: str, years: int, extent: int | None = None) -> DataFrame:
    """Keep events by the person's age, in calendar years, at the event."""
    birth = person.select("person_id", "year_of_birth")
    joined = events.join(birth, "person_id")
    return joined.filter(compare(age_at(F.col("start_date"), F.col("year_of_birth")), op, years, extent)).select(events.columns)


def sex_label(concept: Column) -> Column:
    return (
        F.when(concept == schema.FEMALE, "Female").when(concept == schema.MALE, "Male").otherwise("Other/Unknown")
    )


def first_rows(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of every key in the given order.

    An aggregate, not a window: every map task keeps one row per key, so a key
    that holds a large share of all rows costs no more than any other.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    first = F.min(F.struct(*order, *rest)).alias("_first")
    return df.groupBy(*keys).agg(first).select(*keys, "_first.*").select(df.columns)


def first_ever(events: DataFrame) -> DataFrame:
    """First occurrence per person, before any date or age filter."""
    return first_rows(events, ["person_id"], ["start_date", "event_id", "end_date"])
