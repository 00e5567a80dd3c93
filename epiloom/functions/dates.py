"""Dates. All intervals are closed on both sides and counted in whole days."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def birth_date(year: Column, month: Column, day: Column) -> Column:
    """Birth date; a month or day that is missing or 0 counts as 1."""

    def part(value: Column) -> Column:
        return F.coalesce(F.nullif(value, F.lit(0)), F.lit(1))

    # A stored day past the end of its month is moved to the month's last day.
    first = F.make_date(year, part(month), F.lit(1))
    return F.least(F.date_add(first, part(day) - 1), F.last_day(first))


def age_at(date: Column, year_of_birth: Column) -> Column:
    """Age in calendar years, as the cohort definitions count it."""
    return F.year(date) - year_of_birth


def days_inclusive(start: Column, end: Column) -> Column:
    return F.datediff(end, start) + 1


def birthday(dob: Column, age: int) -> Column:
    return F.add_months(dob, 12 * age)


def month_start(date: Column) -> Column:
    return F.trunc(date, "month")


def month_grid(start: Column, end: Column) -> Column:
    """Array of first days of all months an interval meets."""
    return F.sequence(month_start(start), month_start(end), F.expr("interval 1 month"))


def clip_to_month(start: Column, end: Column, month: Column) -> tuple[Column, Column]:
    return F.greatest(start, month), F.least(end, F.last_day(month))


def day_number(date: Column) -> Column:
    return F.unix_date(date)


def month_number(date: Column) -> Column:
    """Months since year 0, for arithmetic on whole months."""
    return F.year(date) * 12 + F.month(date) - 1


def month_from_number(number: Column) -> Column:
    return F.make_date(F.floor(number / 12).cast("int"), (number % 12 + 1).cast("int"), F.lit(1))
