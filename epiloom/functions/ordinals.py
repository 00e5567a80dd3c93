"""Consecutive row numbers over a whole table without sorting it in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from epiloom.sources.tables import materialize


def number_rows(df: DataFrame, key: str, date: str, ties: list[str], name: str) -> DataFrame:
    """1..n in order of (key, date, ties).

    Rows are dealt into ranges of that order, and a row's number is its position in
    its range behind the rows of all ranges before. Rows that are equal in all of
    these are told apart by where they were read, so that a range ends
    anywhere, also within one key and day. The ranges are stored, as a second run
    may draw other bounds.
    """
    order = [key, date, *ties, "_read"]
    ranges = df.withColumn("_read", F.monotonically_increasing_id()).repartitionByRange(*order)
    ranges = materialize(ranges.withColumn("_range", F.spark_partition_id()), "ranges")
    # One row per range, whatever the input.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    numbered = ranges.withColumn("_rn", within).join(counts, "_range")
    return numbered.select((F.col("_before") + F.col("_rn")).alias(name), *df.columns)
