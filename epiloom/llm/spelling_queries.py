"""op13: spelling variants among the words of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from epiloom.llm.common import table
from epiloom.llm.registry import query
from epiloom.llm.spelling import spelling_forms

LEAST_LENGTH, LEAST, RATIO = 5, 3, 2


@query("op13_spelling_variants")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_forms(table(spark, sf_dir, "documents"), LEAST_LENGTH, LEAST, RATIO)
