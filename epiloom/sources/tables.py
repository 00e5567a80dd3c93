"""Reading tables and keeping cohorts."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from epiloom import schema
from epiloom.functions.names import lower_names
from epiloom.session import scratch_path
from epiloom.sources.versions import exists, read_ids, replace_ids


@dataclass
class Cdm:
    """The tables of one database, by lower-case name."""

    tables: dict[str, DataFrame] = field(default_factory=dict)
    #: By domain, events matched to codesets before: rows of the common shape with a `codeset_id`, 0 for all events of the domain.
    matched: dict[str, DataFrame] = field(default_factory=dict)

    def __getattr__(self, name: str) -> DataFrame:
        try:
            return self.__dict__["tables"][name]
        except KeyError:
            raise AttributeError(f"no table {name!r} in this data model") from None


def load_table(spark: SparkSession, location: str, name: str) -> DataFrame:
    """One table: a parquet folder or file below a path, or a table of a schema."""
    if "/" in location:
        path = f"{location.rstrip('/')}/{name}"
        df = spark.read.parquet(path if exists(spark, path) else f"{path}.parquet")
    else:
        df = spark.table(f"{location}.{name}")
    return lower_names(df)


def load_cdm(spark: SparkSession, location: str, names: list[str]) -> Cdm:
    return Cdm({name: load_table(spark, location, name) for name in names})


def read_settings(spark: SparkSession, path: str, layout: T.StructType) -> DataFrame:
    """A cohort list or analysis list; `NA` and empty fields are null."""
    return spark.read.csv(path, header=True, schema=layout, nullValue="NA")


def cohort_exists(spark: SparkSession, name: str) -> bool:
    """Is there a cohort table of this name (or at this path)?"""
    return exists(spark, name) if "/" in name else spark.catalog.tableExists(name)


def replace_cohort(cohort: DataFrame, ids: Iterable[int], path: str) -> None:
    """Write rows so that they replace whatever the cohorts `ids` held before, all at once (`versions`).

    Ids that have no rows any more are gone; rows of other ids are refused, so a run that
    is repeated leaves the same table.
    """
    replace_ids(cohort, ids, path)


def read_cohorts(spark: SparkSession, path: str) -> DataFrame:
    """All cohorts below a path; it may hold none."""
    return read_ids(spark, path, schema.COHORT)


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write to the shared folder and read back: a result many plans reuse.

    Unlike a cached frame this outlives lost executors.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
