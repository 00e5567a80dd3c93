"""Whole studies: all outcomes, all strata, results in the long format."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import date
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import (
    AnalysisException,
    ArithmeticException,
    ArrayIndexOutOfBoundsException,
    DateTimeException,
    IllegalArgumentException,
    NumberFormatException,
    PythonException,
    SparkRuntimeException,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epiloom.operators.characterize import cohort_characteristics
from epiloom.operators.denominators import denominator, sex_totals
from epiloom.operators.incidence import label_outcomes, monthly_incidence, suppress_incidence
from epiloom.operators.results import bind_rows, to_summarised_result
from epiloom.sources.export import export_results
from epiloom.sources.tables import Cdm, materialize

_REFUSED = (
    ArithmeticException, ArrayIndexOutOfBoundsException, DateTimeException, IllegalArgumentException,
    NumberFormatException, PythonException, SparkRuntimeException,
)
# Spark's exceptions for data that an expression refuses.
_DATA = re.compile(r"spark\.Spark(?:Runtime|Arithmetic|DateTime|NumberFormat|IllegalArgument|ArrayIndexOutOfBounds)Exception$")
FAILED = "outcome_table_name string, outcome_id bigint, error_message string"


@dataclass(frozen=True)
class Analysis:
    """One outcome to estimate: a cohort id in a cohort table."""

    outcome_table: str
    outcome_id: int


def read_analyses(settings: DataFrame, population: str = "all_population") -> list[Analysis]:
    """The outcomes of a settings file for one denominator, without repeats."""
    rows = (
        settings.filter(F.col("denominator_table_name") == population)
        .select("outcome_table_name", "outcome_id")
        .distinct()
        .orderBy("outcome_table_name", "outcome_id")
    )
    return [Analysis(r.outcome_table_name, r.outcome_id) for r in rows.collect()]


def study_incidence(
    denominators: DataFrame, tables: dict[str, DataFrame], analyses: list[Analysis], totals: dict[int, tuple[int, ...]] | None = None
) -> DataFrame:
    """Monthly incidence of all outcomes of all tables in one job; strata in `totals` are sums of others.

    Outcomes of different tables may share an id; a code per (table, id) keeps
    them apart until the counts are made.
    """
    codes = {a: i for i, a in enumerate(analyses)}
    parts = []
    for name in sorted({a.outcome_table for a in analyses}):
        mine = {a.outcome_id: codes[a] for a in analyses if a.outcome_table == name}
        code = F.create_map(*[F.lit(v).cast("long") for pair in mine.items() for v in pair])
        rows = tables[name].filter(F.col("cohort_definition_id").isin(list(mine)))
        parts.append(rows.withColumn("cohort_definition_id", F.element_at(code, F.col("cohort_definition_id"))))
    outcomes = reduce(DataFrame.unionByName, parts)
    monthly = monthly_incidence(denominators, outcomes, list(codes.values()), totals)
    back = F.create_map(
        *[
            v
            for a, i in codes.items()
            for v in (F.lit(i).cast("long"), F.struct(F.lit(a.outcome_table).alias("t"), F.lit(a.outcome_id).cast("long").alias("i")))
        ]
    )
    known = monthly.withColumn("_of", F.element_at(back, F.col("outcome_id")))
    return known.withColumn("outcome_id", F.col("_of.i")).withColumn("outcome_table", F.col("_of.t")).drop("_of")


def run_or_log(
    spark: SparkSession,
    analyses: list[Analysis],
    run: Callable[[list[Analysis]], DataFrame],
    continue_on_error: bool = True,
) -> tuple[DataFrame | None, DataFrame]:
    """Run all analyses as one job; if that fails, halves of them, down to the single outcomes that fail.

    Returns the stored result and a frame of what failed and why. Only what an analysis
    can be the cause of counts as failed; a cluster that is out of order raises.
    """
    failed: list[tuple[str, int, str]] = []
    done: list[DataFrame] = []
    todo = [sorted(analyses, key=lambda a: (a.outcome_table, a.outcome_id))] if analyses else []
    while todo:
        group = todo.pop(0)
        try:
            done.append(materialize(run(group), "incidence"))
        except Exception as error:
            if not continue_on_error or not caused_by_analysis(error):
                raise
            if len(group) > 1:
                todo[:0] = [group[: len(group) // 2], group[len(group) // 2 :]]
            else:
                failed.append((group[0].outcome_table, group[0].outcome_id, str(error).splitlines()[0] if str(error) else type(error).__name__))
    return (bind_rows(done) if done else None), spark.createDataFrame(failed, FAILED)


def caused_by_analysis(error: Exception) -> bool:
    """A missing table or column, or data that an expression refuses; not lost executors, full disks or unreachable files."""
    if isinstance(error, Py4JJavaError):
        return any(_DATA.search(name) for name in _causes(error.java_exception))
    return isinstance(error, (KeyError, ValueError, ArithmeticError, AnalysisException, *_REFUSED))


def _causes(thrown) -> Iterator[str]:
    """Class names of a Java exception, of what caused it and of what was suppressed."""
    todo = [thrown]
    while todo:
        one = todo.pop()
        yield one.getClass().getName()
        todo += [x for x in (one.getCause(), *one.getSuppressed()) if x is not None]


def incidence_study(
    cdm: Cdm,
    tables: dict[str, DataFrame],
    analyses: list[Analysis],
    labels: DataFrame,
    start: date,
    latest: date,
    prior_days: int = 365,
    min_cell_count: int = 5,
    continue_on_error: bool = True,
) -> dict[str, DataFrame]:
    """Characteristics, monthly incidence, long results and the failure log.

    The denominator is written once, since several plans read it.
    """
    spark = labels.sparkSession
    strata = materialize(denominator(cdm.person, cdm.observation_period, start, latest, prior_days), "denominator")
    described = [
        cohort_characteristics(table, cdm.person, cdm.observation_period, min_cell_count).withColumn(
            "cohort_table", F.lit(name)
        )
        for name, table in [*tables.items(), ("denominator", strata)]
    ]
    monthly, failed = run_or_log(
        spark, analyses, lambda group: study_incidence(strata, tables, group, sex_totals()), continue_on_error
    )
    results = {"characteristics": bind_rows(described), "failed_incidence_log": failed}
    if monthly is not None:
        named = label_outcomes(monthly, labels)
        results["incidence"] = named
        results["main_incidence_results"] = to_summarised_result(
            named, start, latest, min_cell_count
        )
    return results


def export_study(results: dict[str, DataFrame], min_cell_count: int, folder: str) -> None:
    """The study's CSV folders; incidence and characteristics share one."""
    parts = [results["characteristics"]]
    if "incidence" in results:
        parts.append(suppress_incidence(results["incidence"], min_cell_count))
        export_results(results["main_incidence_results"], min_cell_count, f"{folder}/main_incidence_results")
    export_results(bind_rows(parts), min_cell_count, f"{folder}/incidence_and_characteristics")
    export_results(results["failed_incidence_log"], min_cell_count, f"{folder}/failed_incidence_log")
