"""Concept sets over the concept hierarchy, and matching events with them."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epiloom.sources.tables import materialize


@dataclass(frozen=True)
class ConceptSet:
    """Concepts named one by one; `*_descendants` take in all that lies below."""

    codeset_id: int
    concepts: tuple[int, ...] = ()
    descendants_of: tuple[int, ...] = ()
    excluded: tuple[int, ...] = ()
    excluded_descendants_of: tuple[int, ...] = ()


def _named(rows: DataFrame, column: str, wanted: dict[str, list[tuple[int, int]]]) -> DataFrame:
    """Rows whose concept `column` is named, with `m` for each (codeset, in or out) it stands for.

    The names come from definitions, so their number is small and Spark knows it: the
    join is a broadcast, however many sets are expanded together.
    """
    marks = sorted({(concept, codeset, kind == "in") for kind, pairs in wanted.items() for codeset, concept in pairs})
    lines = [
        F.struct(F.lit(n).cast("long").alias("named"), F.struct(F.lit(c).cast("int").alias("codeset_id"), F.lit(i).alias("inside")).alias("m"))
        for n, c, i in marks
    ]
    names = rows.sparkSession.range(1).select(F.inline(F.array(*lines)))
    return rows.withColumn("named", F.col(column).cast("long")).join(names, "named").drop("named")


def expand_codesets(sets: list[ConceptSet], concept: DataFrame, concept_ancestor: DataFrame) -> DataFrame:
    """(codeset_id, concept_id), distinct, for all sets in one pass.

    A named concept counts if it exists, a descendant if it exists and is valid.
    The hierarchy is a transitive closure, so one join reaches all depths.
    Inclusions and exclusions are marks on the concept, settled in one aggregate.
    """

    def pairs(attribute: str) -> list[tuple[int, int]]:
        return [(s.codeset_id, c) for s in sets for c in getattr(s, attribute)]

    known = concept.select(F.col("concept_id").cast("long").alias("concept_id"), "invalid_reason")
    parts = []
    named = {"in": pairs("concepts"), "out": pairs("excluded")}
    if any(named.values()):
        parts.append(_named(known, "concept_id", named).select("concept_id", "m"))
    below = {"in": pairs("descendants_of"), "out": pairs("excluded_descendants_of")}
    if any(below.values()):
        reached = _named(concept_ancestor, "ancestor_concept_id", below)
        reached = reached.select(F.col("descendant_concept_id").cast("long").alias("concept_id"), "m")
        valid = known.filter("invalid_reason is null").select("concept_id")
        parts.append(reached.join(valid, "concept_id", "left_semi"))
    if not parts:
        parts.append(known.limit(0).select("concept_id", F.expr("named_struct('codeset_id', 0, 'inside', false)").alias("m")))
    return (
        reduce(DataFrame.union, parts)
        .groupBy(F.col("m.codeset_id").alias("codeset_id"), "concept_id")
        .agg(F.min("m.inside").alias("inside"))
        .filter("inside")
        .drop("inside")
    )


def stored_codesets(sets: list[ConceptSet], concept: DataFrame, concept_ancestor: DataFrame) -> DataFrame:
    """The expanded sets of a definition, written once.

    Every criterion then reads a small table whose size Spark knows when it
    plans, so that matching broadcasts it below the session's threshold instead
    of shuffling the events.
    """
    return materialize(expand_codesets(sets, concept, concept_ancestor), "codesets")


def _concepts(codesets: DataFrame, codeset_id: int) -> DataFrame:
    return codesets.filter(F.col("codeset_id") == codeset_id).select(F.col("concept_id").alias("target_concept_id"))


def match_codeset(events: DataFrame, codesets: DataFrame, codeset_id: int) -> DataFrame:
    """Events whose concept is in the codeset (join form).

    Without a broadcast hint: a codeset above the session's threshold is joined
    by shuffle, and adaptive execution splits hot concepts.
    """
    return events.join(_concepts(codesets, codeset_id), "target_concept_id").select(events.columns)


def match_codesets(events: DataFrame, codesets: DataFrame, codeset_ids: list[int]) -> DataFrame:
    """Events of several codesets in one pass: a row, with its `codeset_id`, for each codeset that an event is in."""
    wanted = codesets.filter(F.col("codeset_id").isin(codeset_ids))
    concepts = wanted.select("codeset_id", F.col("concept_id").alias("target_concept_id"))
    return events.join(concepts, "target_concept_id").select(*events.columns, "codeset_id")


def match_codeset_in(events: DataFrame, codesets: DataFrame, codeset_id: int) -> DataFrame:
    """Events whose concept is in the codeset (membership form)."""
    return events.join(_concepts(codesets, codeset_id), "target_concept_id", "left_semi").select(events.columns)
