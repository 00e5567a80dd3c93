"""Column layouts shared by the operators."""

from pyspark.sql import types as T

COHORT = T.StructType(
    [
        T.StructField("cohort_definition_id", T.LongType()),
        T.StructField("subject_id", T.LongType()),
        T.StructField("cohort_start_date", T.DateType()),
        T.StructField("cohort_end_date", T.DateType()),
    ]
)

EVENT_COLUMNS = [
    "person_id",
    "event_id",
    "start_date",
    "end_date",
    "target_concept_id",
    "visit_occurrence_id",
]

ANALYSES = T.StructType(
    [
        T.StructField("denominator_id", T.LongType()),
        T.StructField("denominator_name", T.StringType()),
        T.StructField("denominator_table_name", T.StringType()),
        T.StructField("outcome_id", T.LongType()),
        T.StructField("outcome_name", T.StringType()),
        T.StructField("outcome_table_name", T.StringType()),
        T.StructField("time_at_risk", T.StringType()),
    ]
)

# Columns by position; the names are those `label_outcomes` asks for.
COHORT_LIST = T.StructType(
    [
        T.StructField("definition_id", T.LongType()),
        T.StructField("definition_name", T.StringType()),
        T.StructField("cohort_id", T.LongType()),
        T.StructField("cohort_name", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("file_root", T.StringType()),
    ]
)

RESULT_COLUMNS = [
    "result_id",
    "cdm_name",
    "group_name",
    "group_level",
    "strata_name",
    "strata_level",
    "variable_name",
    "variable_level",
    "estimate_name",
    "estimate_type",
    "estimate_value",
    "additional_name",
    "additional_level",
]

# Concept ids for sex in the common data model.
MALE = 8507
FEMALE = 8532
