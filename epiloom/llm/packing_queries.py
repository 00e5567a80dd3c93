"""op3: all documents packed into sequences."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from epiloom.llm.common import table
from epiloom.llm.packing import ADDED, pack
from epiloom.llm.registry import query

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@query("op3_harmonic_packing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN, special=ADDED)
