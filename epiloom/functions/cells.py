"""Small-cell suppression and percentages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if "count" in c.lower()]


def hide_small(value: Column, at_least: int) -> Column:
    """Null for 0 < value < at_least; 0 itself is safe to show."""
    return F.when(~((value > 0) & (value < at_least)), value)


def suppress_small(df: DataFrame, columns: list[str], at_least: int) -> DataFrame:
    return df.withColumns({c: hide_small(F.col(c), at_least) for c in columns})


def percentage(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, F.lit(0.0)).otherwise(part * F.lit(100.0) / whole)


def as_text(value: Column, digits: int = 6) -> Column:
    """A number as plain decimal text, never in exponent form."""
    return value.cast(f"decimal(38,{digits})").cast("string")
