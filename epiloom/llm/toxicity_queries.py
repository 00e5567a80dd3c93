"""op8: toxicity scores of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epiloom.llm import toxicity
from epiloom.llm.common import table
from epiloom.llm.labelled import fold
from epiloom.llm.registry import query

FOLDS, HELD_OUT, LIMIT = 3, 1, 0.7


def scorer(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Scorer:
    return toxicity.fit(docs, table(spark, sf_dir, "labels"), fold(F.col("doc_id"), FOLDS) != HELD_OUT)


@query("op8_toxicity_trees")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scorer(spark, docs, sf_dir).score(docs.select("doc_id", "text")).select(
        "doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), F.col("toxicity_score").alias("score"),
        (F.col("toxicity_score") >= LIMIT).cast("int").alias("predicted"),
    )
