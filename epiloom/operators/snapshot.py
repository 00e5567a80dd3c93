"""Description of a database."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epiloom import schema
from epiloom.operators.results import PACKAGE, VERSION, bind_rows, settings_rows

# Fixed values: (variable, estimate, type, column of the one-row summary).
ESTIMATES = [
    ("general", "snapshot_date", "date", "snapshot_date"),
    ("general", "person_count", "integer", "person_count"),
    ("general", "vocabulary_version", "character", "vocabulary_version"),
    ("cdm", "source_name", "character", "cdm_source_name"),
    ("cdm", "version", "character", "cdm_version"),
    ("cdm", "holder_name", "character", "cdm_holder"),
    ("cdm", "release_date", "date", "cdm_release_date"),
    ("cdm", "description", "character", "source_description"),
    ("cdm", "documentation_reference", "character", "source_documentation_reference"),
    ("observation_period", "count", "integer", "op_count"),
    ("observation_period", "start_date", "date", "op_start_date"),
    ("observation_period", "end_date", "date", "op_end_date"),
]


def person_count(person: DataFrame) -> DataFrame:
    return person.agg(F.count(F.lit(1)).alias("person_count"))


def period_summary(observation_period: DataFrame) -> DataFrame:
    return observation_period.agg(
        F.count(F.lit(1)).alias("op_count"),
        F.min(F.col("observation_period_start_date").cast("date")).alias("op_start_date"),
        F.max(F.col("observation_period_end_date").cast("date")).alias("op_end_date"),
    )


def only_row(df: DataFrame, name: str) -> DataFrame:
    """The row of a table that describes the database; an error when the plan runs if there are several different ones."""
    several = F.raise_error(F.lit(f"{name} has more than one row"))
    agree = [
        F.when(F.count_distinct(F.struct(*df.columns)) <= 1, F.max(c)).otherwise(several).cast(df.schema[c].dataType).alias(c)
        for c in df.columns
    ]
    return df.agg(*agree)


def _one_row(parts: list[DataFrame]) -> DataFrame:
    """Single-row frames side by side: stacked, then the one value per column."""
    stacked = bind_rows(parts)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def snapshot(
    person: DataFrame,
    observation_period: DataFrame,
    cdm_source: DataFrame | None = None,
    vocabulary: DataFrame | None = None,
    snapshot_date: date | None = None,
) -> DataFrame:
    """The long description: people, observation, source and vocabulary.

    Without a vocabulary version in `cdm_source`, the highest one in
    `vocabulary` is given.
    """
    parts = [person_count(person), period_summary(observation_period)]
    if cdm_source is not None:
        parts.append(only_row(cdm_source, "cdm_source"))
    if vocabulary is not None:
        parts.append(vocabulary.agg(F.max("vocabulary_version").alias("_fallback")))
    one = _one_row(parts)
    one = one.withColumn("snapshot_date", F.lit(snapshot_date) if snapshot_date else F.current_date())
    version = F.lit(None).cast("string")
    if "vocabulary_version" in one.columns:
        version = F.nullif(F.col("vocabulary_version"), F.lit(""))
    if "_fallback" in one.columns:
        version = F.coalesce(version, F.col("_fallback"))
    one = one.withColumn("vocabulary_version", version)

    def text(column: str) -> Column:
        return F.col(column).cast("string") if column in one.columns else F.lit(None).cast("string")

    lines = [
        F.struct(
            F.lit(v).alias("variable_name"), F.lit(e).alias("estimate_name"),
            F.lit(t).alias("estimate_type"), text(c).alias("estimate_value"),
        )
        for v, e, t, c in ESTIMATES
    ]
    overall = F.lit("overall")
    long = one.select(F.explode(F.array(*lines)).alias("l")).select(
        F.lit(1).alias("result_id"),
        F.lit(None).cast("string").alias("cdm_name"),
        overall.alias("group_name"),
        overall.alias("group_level"),
        overall.alias("strata_name"),
        overall.alias("strata_level"),
        "l.variable_name",
        F.lit(None).cast("string").alias("variable_level"),
        "l.estimate_name",
        "l.estimate_type",
        "l.estimate_value",
        overall.alias("additional_name"),
        overall.alias("additional_level"),
    )
    settings = [
        ("result_type", "summarise_snapshot"),
        ("package_name", PACKAGE),
        ("package_version", VERSION),
        ("group", None),
        ("strata", None),
        ("additional", None),
    ]
    return long.unionByName(settings_rows(person.sparkSession, settings)).select(schema.RESULT_COLUMNS)


def source_information(cdm_source: DataFrame, vocabulary: DataFrame, version: DataFrame | None = None) -> DataFrame:
    """Source, vocabulary and load version in one row, with a combined description."""
    # The labels in a description, and the columns they stand for.
    said = [
        (" ETL Reference: ", "cdm_etl_reference"),
        (" CDM release date: ", "cdm_release_date"),
        (" Source release date: ", "source_release_date"),
        (" Source Documentation Reference: ", "source_documentation_reference"),
    ]
    source = only_row(cdm_source, "cdm_source").withColumnRenamed("vocabulary_version", "vocabulary_version_cdm")
    parts = [
        source,
        vocabulary.filter("vocabulary_id = 'None'").select(F.col("vocabulary_version")),
    ]
    if version is not None:
        dated = version.select("version_id", F.col("version_date").cast("string").alias("version_date"))
        parts.append(only_row(dated, "version"))
    one = _one_row(parts)

    def told(label: str, column: str) -> Column:
        value = F.col(column).cast("string") if column in one.columns else F.lit(None).cast("string")
        return F.concat(F.lit(label), F.coalesce(value, F.lit("None")))

    description = F.trim(F.concat(F.coalesce(F.col("source_description"), F.lit("")), *[told(*s) for s in said]))
    tail = F.lit("")
    if version is not None:
        tail = F.coalesce(F.concat(F.lit(" (v"), F.col("version_id"), F.lit(" "), F.col("version_date"), F.lit(")")), F.lit(""))
    changed = {"cdm_source_name": F.concat("cdm_source_name", tail), "source_description": F.concat(description, tail)}
    if "cdm_source_abbreviation" in one.columns:
        changed["cdm_source_abbreviation"] = F.concat("cdm_source_abbreviation", tail)
    return one.withColumns(changed).withColumn("database_description", F.col("source_description"))
