"""op7: near-duplicates among all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from epiloom.llm.common import table
from epiloom.llm.hyperminhash import near_duplicates
from epiloom.llm.registry import query

SIZE, PERCENT = 3, 85


@query("op7_hyperminhash")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), SIZE, PERCENT)
