"""A corpus pipeline: toxic documents go, then near-copies, then leaked benchmark text; secrets are masked, and what is left is packed."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epiloom.llm import secrets, toxicity
from epiloom.llm.common import stored, table
from epiloom.llm.decontaminate import without_windows
from epiloom.llm.hyperminhash import without_copies
from epiloom.llm.packing import ADDED, pack
from epiloom.llm.toxicity_queries import LIMIT

#: SQL can't express a trained model, tokenizer or hash sketch; tests compare the stages with brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a calibrated toxicity below the limit. All labels teach. Null texts score as empty; null and repeated ids stay."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), F.lit(True))
    return model.score(docs).where(F.col("toxicity_score") < LIMIT).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near-copies: five words, Jaccard 0.8.

    Rows that repeat an id are told apart by their text. Texts without words stay; rows that repeat
    an id and a text stay once; rows without an id stay all.
    """
    return without_copies(docs)


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten successive words of a benchmark item; a null text has no words, and a null id is its own."""
    return without_windows(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked and n_chars counted anew."""
    masked = secrets.redact(docs, secrets.fit_on(docs))
    return masked.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in pieces, in sequences of 2048 tokens."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, special=ADDED)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaked),
    ("secret_scan", mask_secrets),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the last stage returns; each stage starts from the files that the one before wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
