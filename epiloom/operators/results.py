"""The long result format."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from epiloom import schema
from epiloom.functions.cells import as_text, hide_small
from epiloom.functions.names import levels
from epiloom.operators.incidence import rollup_overall, rollup_years, with_limits
from epiloom.functions.poisson import rate

PACKAGE = "epiloom"
VERSION = "0.1.0"

# The estimates of an incidence interval, in output order.
ESTIMATES = [
    ("Denominator", "denominator_count", "integer", "denom_count"),
    ("Denominator", "person_days", "numeric", "person_days"),
    ("Denominator", "person_years", "numeric", "person_years"),
    ("Outcome", "outcome_count", "integer", "outcome_count"),
    ("Outcome", "incidence_100000_pys", "numeric", "incidence_100000_pys"),
    ("Outcome", "incidence_100000_pys_95CI_lower", "numeric", "incidence_100000_pys_95CI_lower"),
    ("Outcome", "incidence_100000_pys_95CI_upper", "numeric", "incidence_100000_pys_95CI_upper"),
]

INCIDENCE_GROUP = "denominator_cohort_name &&& outcome_cohort_name"
INCIDENCE_ADDITIONAL = "incidence_start_date &&& incidence_end_date &&& interval_name"


def intervals(monthly: DataFrame, start: date, end: date, keys: list[str]) -> DataFrame:
    """Monthly, yearly and overall rows with the dates and name of the interval."""
    first = F.make_date("cal_year", "cal_month", F.lit(1))
    parts = [
        (monthly, "denom_count", first, F.last_day(first), "months"),
        (rollup_years(monthly, tuple(keys)), "max_monthly_denominator",
         F.make_date("cal_year", F.lit(1), F.lit(1)), F.make_date("cal_year", F.lit(12), F.lit(31)), "years"),
        (rollup_overall(monthly, tuple(keys)), "max_monthly_denominator", F.lit(start), F.lit(end), "overall"),
    ]
    return reduce(
        DataFrame.unionByName,
        [
            df.select(
                *keys,
                a.alias("interval_start_date"),
                b.alias("interval_end_date"),
                F.lit(label).alias("interval_name"),
                "outcome_count",
                F.col(people).alias("denom_count"),
                "person_days",
            )
            for df, people, a, b, label in parts
        ],
    )


def interval_rates(rows: DataFrame, min_cell_count: int | None) -> DataFrame:
    """Rates and limits per interval; small counts are hidden after rolling up.

    A rate whose count is hidden is hidden too, as the count follows from it.
    """
    rated = rows.withColumns(
        {
            "person_years": F.col("person_days") / F.lit(365.25),
            "incidence_100000_pys": rate(F.col("outcome_count"), F.col("person_days")),
        }
    )
    rated = with_limits(rated)
    if min_cell_count is None:
        return rated
    shown = hide_small(F.col("outcome_count"), min_cell_count).isNotNull()
    hidden = {c: F.when(shown, F.col(c)) for c in rated.columns if c.startswith("incidence_100000") or c == "outcome_count"}
    hidden["denom_count"] = hide_small(F.col("denom_count"), min_cell_count)
    return rated.withColumns(hidden)


def _value(kind: str, column: str, limit_digits: int) -> Column:
    if kind == "integer":
        return F.col(column).cast("string")
    if "95CI" in column:
        return as_text(F.round(F.col(column), limit_digits), limit_digits)
    return as_text(F.col(column))


def settings_rows(spark: SparkSession, settings: list[tuple[str, str | None]]) -> DataFrame:
    """The block that says what a result is."""
    rows = [
        (1, None, "overall", "overall", "overall", "overall", "settings", None, name, "character", value, "overall", "overall")
        for name, value in settings
    ]
    layout = ", ".join(f"{c} {'int' if c == 'result_id' else 'string'}" for c in schema.RESULT_COLUMNS)
    return spark.createDataFrame(rows, layout)


def to_summarised_result(monthly: DataFrame, start: date, end: date, min_cell_count: int = 5, limit_digits: int = 6) -> DataFrame:
    """Seven long rows per stratum, outcome and interval, and the settings block. Limits have `limit_digits` decimals.

    `monthly` has denom_id, outcome_name and the monthly counts.
    """
    rows = interval_rates(intervals(monthly, start, end, ["denom_id", "outcome_name"]), min_cell_count)
    lines = [
        F.struct(
            F.lit(variable).alias("variable_name"),
            F.lit(name).alias("estimate_name"),
            F.lit(kind).alias("estimate_type"),
            _value(kind, column, limit_digits).alias("estimate_value"),
        )
        for variable, name, kind, column in ESTIMATES
    ]
    dates = [F.date_format(c, "yyyy-MM-dd") for c in ("interval_start_date", "interval_end_date")]
    long = rows.select(
        F.lit(1).alias("result_id"),
        F.lit(None).cast("string").alias("cdm_name"),
        F.lit(INCIDENCE_GROUP).alias("group_name"),
        levels(F.concat(F.lit("denominator_cohort_"), F.col("denom_id")), F.col("outcome_name")).alias("group_level"),
        F.lit("overall").alias("strata_name"),
        F.lit("overall").alias("strata_level"),
        F.explode(F.array(*lines)).alias("l"),
        F.lit(INCIDENCE_ADDITIONAL).alias("additional_name"),
        levels(*dates, F.col("interval_name")).alias("additional_level"),
    )
    long = long.select(
        *schema.RESULT_COLUMNS[:6],
        "l.variable_name",
        F.lit(None).cast("string").alias("variable_level"),
        "l.estimate_name",
        "l.estimate_type",
        "l.estimate_value",
        "additional_name",
        "additional_level",
    )
    settings = [
        ("result_type", "incidence"),
        ("package_name", PACKAGE),
        ("package_version", VERSION),
        ("group", INCIDENCE_GROUP),
        ("strata", None),
        ("additional", INCIDENCE_ADDITIONAL),
        ("min_cell_count", str(min_cell_count)),
    ]
    return long.unionByName(settings_rows(monthly.sparkSession, settings))


def bind_rows(parts: list[DataFrame]) -> DataFrame:
    """Results of different shape in one frame; missing columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
