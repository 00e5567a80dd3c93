"""Labelled documents to learn from: a sample of bounded size, by hash of the id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epiloom.llm.common import stored

ROWS = 20_000
_SHARES = 1 << 30


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; -1 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(-1))


def sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, rows: int = ROWS) -> DataFrame:
    """text, y (0.0 or 1.0) and part (0 to 99, by hash): labelled documents that `learn` holds for.

    About `rows` documents at most, chosen by hash of the id, whatever the number of labels.
    Documents labelled twice count as 1 if any label is 1; equal texts count once.
    """
    one = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & learn)
    one = one.groupBy("doc_id").agg(F.max(F.col(label).cast("double")).alias("y"))
    share = min(1.0, rows / max(1, one.count()))
    chosen = one.where(F.pmod(F.xxhash64("doc_id"), F.lit(_SHARES)) < int(share * _SHARES))
    # The bound on `chosen` is `rows`, give or take chance, so it can go to every task.
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(stored(chosen, "labels")), "doc_id")
    key = F.xxhash64("text")
    texts = texts.select("text", "y", F.pmod(key, F.lit(100)).alias("part"), key.alias("key")).dropDuplicates(["key"])
    return stored(texts.drop("key"), "labelled")
