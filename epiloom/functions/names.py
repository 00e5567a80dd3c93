"""Names of columns and tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def camel(name: str) -> str:
    """`acute_cohorts` -> `AcuteCohorts`: the folder a table's definitions live in."""
    return "".join(part[:1].upper() + part[1:] for part in name.split("_"))


def levels(*columns: Column) -> Column:
    """Composite level of the long result format."""
    return F.concat_ws(" &&& ", *columns)
