"""op4: main text of all pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from epiloom.llm.common import table
from epiloom.llm.maintext import main_text
from epiloom.llm.registry import query


@query("op4_page_differencing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))
