"""op5: fingerprints of all documents and of edited texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from epiloom.llm.common import table
from epiloom.llm.registry import query
from epiloom.llm.spotsigs import compare_with_edits


@query("op5_spot_signatures")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_edits(table(spark, sf_dir, "documents"))
