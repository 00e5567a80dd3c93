"""op10: secrets in all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from epiloom.llm import secrets
from epiloom.llm.common import table
from epiloom.llm.registry import query


@query("op10_secret_automata")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.scan(docs, secrets.fit_on(docs))
