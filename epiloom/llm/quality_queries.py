"""op6: quality scores of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epiloom.llm import quality
from epiloom.llm.common import table
from epiloom.llm.labelled import fold
from epiloom.llm.registry import query

FOLDS, HELD_OUT, LIMIT = 5, 0, 0.3


@query("op6_quality_machine")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    machine = quality.fit(docs, table(spark, sf_dir, "labels"), fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    return quality.score(docs, machine).select(
        "doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= LIMIT).cast("int").alias("predicted"),
    )
