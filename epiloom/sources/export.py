"""Writing results."""

from __future__ import annotations

from pyspark.sql import DataFrame

from epiloom.functions.cells import count_columns, suppress_small


def export_results(df: DataFrame, min_cell_count: int, path: str) -> None:
    """Blank small counts in every column named like a count, then write CSV."""
    safe = suppress_small(df, count_columns(df), min_cell_count)
    safe.write.mode("overwrite").csv(path, header=True)
