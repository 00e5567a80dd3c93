"""Inclusion rules: one bit per rule, and the statistics on them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rule_mask(rules: list[str]) -> Column:
    """Bit k is set where the k-th boolean column holds."""
    bits = [F.when(F.col(r), F.lit(1 << k)).otherwise(F.lit(0)).cast("long") for k, r in enumerate(rules)]
    return reduce(lambda a, b: a + b, bits, F.lit(0).cast("long"))


def mask_from_rows(events: DataFrame, met: DataFrame, keys: list[str]) -> DataFrame:
    """Events plus `inclusion_rule_mask`, from (keys, inclusion_rule_id) rows."""
    bit = F.expr("shiftleft(1L, cast(inclusion_rule_id as int))")
    masks = met.select(*keys, "inclusion_rule_id").distinct().groupBy(*keys).agg(F.sum(bit).alias("inclusion_rule_mask"))
    return events.join(masks, keys, "left").fillna(0, ["inclusion_rule_mask"])


def inclusion_rows(masked: DataFrame, keys: list[str], n_rules: int) -> DataFrame:
    """(inclusion_rule_id, keys): one row per event and rule it meets."""
    rules = F.explode(F.sequence(F.lit(0), F.lit(n_rules - 1))).alias("inclusion_rule_id")
    return (
        masked.select("inclusion_rule_mask", rules, *keys)
        .filter(F.expr("getbit(inclusion_rule_mask, inclusion_rule_id) = 1"))
        .select(F.col("inclusion_rule_id").cast("long").alias("inclusion_rule_id"), *keys)
    )


def all_rules_met(masked: DataFrame, n_rules: int) -> DataFrame:
    return masked.filter(F.col("inclusion_rule_mask") == (1 << n_rules) - 1)


def best_events(masked: DataFrame) -> DataFrame:
    """Per person the event that meets most rules, then the earliest rule, then starts first."""
    mask = F.col("inclusion_rule_mask")
    ranked = masked.withColumn("_missing", -F.bit_count(mask)).withColumn(
        # lowest set bit; an event without rules counts as rule 0
        "_first_rule", F.when(mask == 0, 0).otherwise(F.bit_count((mask - 1).bitwiseAND(F.bitwise_not(mask))))
    )
    order = ["_missing", "_first_rule", "start_date", "event_id"]
    rest = [c for c in ranked.columns if c != "person_id" and c not in order]
    best = F.min(F.struct(*order, *rest)).alias("_best")
    return ranked.groupBy("person_id").agg(best).select("person_id", "_best.*").select(masked.columns)


def inclusion_result(masked: DataFrame, mode_id: int) -> DataFrame:
    """Events per mask; mode 0 counts all events, mode 1 the best event per person."""
    rows = best_events(masked) if mode_id == 1 else masked
    return rows.groupBy("inclusion_rule_mask").agg(F.count(F.lit(1)).alias("person_count")).withColumn(
        "mode_id", F.lit(mode_id)
    )


def inclusion_stats(result: DataFrame, n_rules: int) -> DataFrame:
    """Per rule: events that meet it, events that fail only it (gain), all events."""
    full = (1 << n_rules) - 1
    rule = F.explode(F.sequence(F.lit(0), F.lit(n_rules - 1))).alias("rule_sequence")
    rows = result.select("inclusion_rule_mask", "person_count", "mode_id", rule)
    hit = F.expr("getbit(inclusion_rule_mask, rule_sequence) = 1")
    gain = F.col("inclusion_rule_mask") == F.lit(full).cast("long") - F.expr("shiftleft(1L, rule_sequence)")

    def total(when: Column) -> Column:
        return F.sum(F.when(when, F.col("person_count")).otherwise(0))

    return rows.groupBy("mode_id", "rule_sequence").agg(
        total(hit).alias("person_count"), total(gain).alias("gain_count"), F.sum("person_count").alias("person_total")
    )


def summary_stats(result: DataFrame, n_rules: int) -> DataFrame:
    """Base count (all events) and final count (all rules met) per mode."""
    full = F.col("inclusion_rule_mask") == (1 << n_rules) - 1
    return result.groupBy("mode_id").agg(
        F.sum("person_count").alias("base_count"),
        F.sum(F.when(full, F.col("person_count")).otherwise(0)).alias("final_count"),
    )
