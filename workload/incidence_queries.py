"""Populations at risk, incidence, characterization, results."""

from pyspark.sql import functions as F

from epiloom.functions.dates import age_at
from epiloom.operators.characterize import (
    cohort_characteristics,
    conditional_counts,
    describe_entries,
    mean_sd,
    quantiles,
)
from epiloom.operators.denominators import denominator, risk_intervals, sex_totals
from epiloom.operators.events import sex_label
from epiloom.operators import incidence as inc
from epiloom.operators.observation import periods
from epiloom.operators.results import INCIDENCE_ADDITIONAL, INCIDENCE_GROUP, interval_rates, intervals, to_summarised_result
from epiloom.operators.snapshot import snapshot, source_information
from epiloom.operators.suppression import protect_totals
from epiloom.plans.study import Analysis, export_study, incidence_study, run_or_log, study_incidence
from epiloom.session import scratch_path
from epiloom.sources.tables import load_table, materialize
from workload.registry import query
from workload.tables import (
    LATEST,
    START,
    acute_cohorts,
    clinical,
    condition_cohorts,
    outcome_cohorts,
    symptom_cohorts,
    with_tables,
)

IDS = [1, 2, 3, 4, 5]


def strata(spark, sf):
    cdm = clinical(spark, sf)
    return denominator(cdm.person, cdm.observation_period, START, LATEST)


def stored_strata(spark, sf):
    """The denominator table, written once per query as incidence reads it several times."""
    return materialize(strata(spark, sf), "denominator")


def outcomes(spark, sf):
    return outcome_cohorts(clinical(spark, sf))


def monthly(spark, sf):
    return inc.monthly_incidence(stored_strata(spark, sf), outcomes(spark, sf), IDS, sex_totals())


def stored_monthly(spark, sf):
    """Monthly counts, stored where several summaries follow."""
    return materialize(monthly(spark, sf), "monthly")


@query("w8_denominator", with_tables("SELECT * FROM risk"))
def risk(spark, sf):
    cdm = clinical(spark, sf)
    return risk_intervals(cdm.person, cdm.observation_period, START, LATEST)


@query("w9_age_band_clip", with_tables("SELECT * FROM denom"))
def bands(spark, sf):
    return strata(spark, sf)


@query("a2_first_event", with_tables("SELECT * FROM first_event"))
def firsts(spark, sf):
    return inc.first_event(outcomes(spark, sf))


def paired(spark, sf):
    return inc.pair_with_outcomes(strata(spark, sf), outcomes(spark, sf), IDS)


@query(
    "j19_denom_outcomes",
    with_tables(
        """SELECT outcome_id, denom_id, count(*) AS n, count(first_event_date) AS with_event,
                  min(first_event_date) AS first_event_date FROM paired GROUP BY 1, 2"""
    ),
)
def pairs(spark, sf):
    return paired(spark, sf).groupBy("outcome_id", "denom_id").agg(
        F.count(F.lit(1)).alias("n"), F.count("first_event_date").alias("with_event"),
        F.min("first_event_date").alias("first_event_date"),
    )


@query(
    "w10_at_risk_end",
    with_tables("SELECT denom_id, outcome_id, subject_id, cohort_start_date, cohort_end_date, at_risk_end_date FROM atrisk"),
)
def at_risk(spark, sf):
    return inc.at_risk(paired(spark, sf)).drop("first_event_date")


@query(
    "j23_w11_month_slices",
    with_tables(
        """SELECT cohort_definition_id, subject_id, month_start, greatest(cohort_start_date, month_start) AS start_in_month,
                  least(cohort_end_date, month_end) AS end_in_month
           FROM denom JOIN months ON cohort_start_date <= month_end AND cohort_end_date >= month_start"""
    ),
)
def slices(spark, sf):
    rows = inc.month_slices(strata(spark, sf), "cohort_start_date", "cohort_end_date")
    return rows.select("cohort_definition_id", "subject_id", "month_start", "start_in_month", "end_in_month")


@query("a9_incidence_denominator", with_tables("SELECT * FROM at_risk_sum"))
def people(spark, sf):
    return inc.incidence_denominator(stored_strata(spark, sf), outcomes(spark, sf), IDS, sex_totals())


@query("a10_incidence_numerator", with_tables("SELECT * FROM event_sum"))
def events(spark, sf):
    return inc.incidence_numerator(strata(spark, sf), outcomes(spark, sf), IDS)


@query("a11_incidence_rate", with_tables("SELECT * FROM monthly"))
def rates(spark, sf):
    return monthly(spark, sf)


YEARLY = """SELECT denom_id, outcome_id, cal_year, CAST(sum(outcome_count) AS BIGINT) AS outcome_count,
                   CAST(sum(person_days) AS BIGINT) AS person_days, max(denom_count) AS max_monthly_denominator
            FROM monthly GROUP BY 1, 2, 3"""
OVERALL = """SELECT denom_id, outcome_id, CAST(sum(outcome_count) AS BIGINT) AS outcome_count,
                    CAST(sum(person_days) AS BIGINT) AS person_days, max(denom_count) AS max_monthly_denominator
             FROM monthly GROUP BY 1, 2"""


@query("a12_rollup_years", with_tables(YEARLY))
def yearly(spark, sf):
    return inc.rollup_years(monthly(spark, sf))


@query("a13_rollup_overall", with_tables(OVERALL))
def overall(spark, sf):
    return inc.rollup_overall(monthly(spark, sf))


@query(
    "a19_suppress_small",
    with_tables(
        """SELECT denom_id, outcome_id, cal_year, cal_month, person_days,
                  CASE WHEN outcome_count BETWEEN 1 AND 4 THEN NULL ELSE outcome_count END AS outcome_count,
                  CASE WHEN denom_count BETWEEN 1 AND 4 THEN NULL ELSE denom_count END AS denom_count,
                  CASE WHEN outcome_count BETWEEN 1 AND 4 THEN NULL ELSE round(incidence_100000_pys, 6) END AS rate
           FROM monthly"""
    ),
)
def suppressed(spark, sf):
    rows = inc.suppress_incidence(monthly(spark, sf), 5)
    shown = ["denom_id", "outcome_id", "cal_year", "cal_month", "person_days", "outcome_count", "denom_count"]
    return rows.select(*shown, F.round("incidence_100000_pys", 6).alias("rate"))


LATTICE = {
    "cells": """
        SELECT outcome_id, denom_id, cal_year, cal_month, sum(outcome_count) AS n FROM monthly
        GROUP BY GROUPING SETS ((outcome_id, denom_id, cal_year, cal_month), (outcome_id, denom_id, cal_year), (outcome_id, denom_id))""",
}


@query(
    "a19_protected_totals",
    with_tables(
        """SELECT outcome_id, count(*) AS cells, count(*) FILTER (n BETWEEN 1 AND 4) AS small, 0 AS small_shown, 0 AS shown_wrongly, 0 AS alone
           FROM cells GROUP BY 1""",
        LATTICE,
    ),
)
def protected(spark, sf):
    """Months, years and the whole time with further cells hidden: how many are small, and what could still be read (nothing, by the SQL).

    `alone` counts sums over months, sexes or ages of which a single member is hidden.
    """
    months = stored_monthly(spark, sf)
    keys = ["outcome_id", "denom_id", "cal_year", "cal_month"]
    found = materialize(protect_totals(months, ["outcome_id"], 5), "protected")
    full = months.groupingSets(
        [[F.col(c) for c in keys], [F.col(c) for c in keys[:3]], [F.col(c) for c in keys[:2]]], *[F.col(c) for c in keys]
    ).agg(F.sum("outcome_count").alias("n"))
    same = [full[k].eqNullSafe(found[k]) for k in keys]
    cells = full.join(found, same).select(*[full[k] for k in keys], "n", "outcome_count", F.col("outcome_count").isNull().alias("hidden"))
    stratum = F.col("denom_id") - 1
    sums = F.array(
        F.struct(F.lit("sex").alias("over"), F.floor(stratum / 3).alias("a"), "cal_year", "cal_month"),
        F.struct(F.lit("age").alias("over"), (stratum % 3).alias("a"), "cal_year", "cal_month"),
        F.when(F.col("cal_year").isNotNull(), F.struct(F.lit("year").alias("over"), stratum.alias("a"), "cal_year", F.lit(None).cast("int").alias("cal_month"))),
        F.when(F.col("cal_month").isNull(), F.struct(F.lit("all").alias("over"), stratum.alias("a"), F.lit(None).cast("int").alias("cal_year"), F.lit(None).cast("int").alias("cal_month"))),
    )
    alone = (
        cells.select("outcome_id", "hidden", F.explode(F.array_compact(sums)).alias("of"))
        .groupBy("outcome_id", "of").agg(F.count_if("hidden").alias("hidden"))
        .groupBy("outcome_id").agg(F.count_if(F.col("hidden") == 1).cast("int").alias("alone"))
    )
    small = F.col("n").between(1, 4)
    return (
        cells.groupBy("outcome_id")
        .agg(
            F.count(F.lit(1)).alias("cells"), F.count_if(small).alias("small"), F.count_if(small & ~F.col("hidden")).cast("int").alias("small_shown"),
            F.count_if(F.col("outcome_count") != F.col("n")).cast("int").alias("shown_wrongly"),
        )
        .join(alone, "outcome_id")
    )


# Exact limits in SQL: bisection on the Poisson distribution function. The lower
# limit m of k events solves P(X >= k) = 0.025, the upper P(X <= k) = 0.025.
LIMITS = {
    "years": YEARLY,
    "ks": "SELECT DISTINCT outcome_count AS k FROM years WHERE outcome_count > 0",
    "goal": "SELECT k, k - 1 AS top, 0.975 AS p, 'lower' AS side FROM ks UNION ALL SELECT k, k, 0.025, 'upper' FROM ks",
    "bisect": """
        SELECT k, top, p, side, CAST(0 AS DOUBLE) AS lo, CAST(2 * k + 40 AS DOUBLE) AS hi, 0 AS i FROM goal
        UNION ALL
        SELECT k, top, p, side,
               CASE WHEN above THEN (lo + hi) / 2 ELSE lo END, CASE WHEN above THEN hi ELSE (lo + hi) / 2 END, i + 1
        FROM (SELECT *, list_sum([exp(j * ln((lo + hi) / 2) - (lo + hi) / 2 - lgamma(j + 1)) FOR j IN range(top + 1)]) > p AS above
              FROM bisect WHERE i < 60)""",
    "limits": """
        SELECT k, max(lo) FILTER (side = 'lower') AS lower_limit, max(lo) FILTER (side = 'upper') AS upper_limit
        FROM bisect WHERE i = 60 GROUP BY k""",
}


@query(
    "a18_x1_poisson_ci",
    with_tables(
        """SELECT denom_id, outcome_id, cal_year, outcome_count, person_days,
                  round(lower_limit / (person_days / 365.25) * 100000, 3) AS ci_lower,
                  round(upper_limit / (person_days / 365.25) * 100000, 3) AS ci_upper
           FROM years LEFT JOIN limits ON k = outcome_count""",
        LIMITS,
        recursive=True,
    ),
)
def limits(spark, sf):
    rows = inc.with_limits(inc.rollup_years(monthly(spark, sf)))
    return rows.select(
        "denom_id", "outcome_id", "cal_year", "outcome_count", "person_days",
        F.round("incidence_100000_pys_95CI_lower", 3).alias("ci_lower"),
        F.round("incidence_100000_pys_95CI_upper", 3).alias("ci_upper"),
    )


@query(
    "j20_label_outcomes",
    with_tables(
        """SELECT m.denom_id, m.outcome_id, m.outcome_count, coalesce(name, 'outcome_cohorts_' || m.outcome_id) AS outcome_name
           FROM overall m LEFT JOIN names ON names.id = m.outcome_id""",
        {
            "overall": OVERALL,
            "names": """SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS id,
                               lower(substr(o_orderpriority, 3)) AS name FROM orders WHERE o_orderpriority <> '5-LOW'""",
        },
    ),
)
def labelled(spark, sf):
    names = outcome_names(spark, sf)
    rows = inc.rollup_overall(monthly(spark, sf)).withColumn("outcome_table", F.lit("outcome_cohorts"))
    return inc.label_outcomes(rows, names).select("denom_id", "outcome_id", "outcome_count", "outcome_name")


def outcome_names(spark, sf):
    priority = F.col("o_orderpriority")
    return load_table(spark, sf, "orders").filter(priority != "5-LOW").select(
        F.substring(priority, 1, 1).alias("cohort_id"), F.lower(F.expr("substring(o_orderpriority, 3)")).alias("cohort_name"),
        F.lit("outcome_cohorts").alias("table_name"),
    ).distinct()


def entries(spark, sf):
    cdm = clinical(spark, sf)
    return describe_entries(outcome_cohorts(cdm), cdm.person, cdm.observation_period)


def quartiles(column: str, value: str) -> str:
    return (
        f"CAST(min({value}) AS DOUBLE) AS {column}_min, quantile_cont({value}, 0.25) AS {column}_q25, "
        f"quantile_cont({value}, 0.5) AS {column}_median, quantile_cont({value}, 0.75) AS {column}_q75, "
        f"CAST(max({value}) AS DOUBLE) AS {column}_max"
    )


DAY = "CAST(cohort_start_date - DATE '1970-01-01' AS DOUBLE)"


@query(
    "a14_quantiles",
    with_tables(
        f"""SELECT cohort_definition_id, {quartiles('start', DAY)}, {quartiles('age', 'CAST(age_years AS DOUBLE)')},
                  {quartiles('prior', 'CAST(prior_observation AS DOUBLE)')} FROM entries GROUP BY 1"""
    ),
)
def quantile_rows(spark, sf):
    names = {"cohort_start_date": "start", "age_years": "age", "prior_observation": "prior"}
    rows = quantiles(entries(spark, sf), ["cohort_definition_id"], list(names))
    return rows.select(
        "cohort_definition_id",
        *[F.col(f"{c}_q.{e}").alias(f"{n}_{e}") for c, n in names.items() for e in ("min", "q25", "median", "q75", "max")],
    )


@query(
    "a15_mean_sd",
    with_tables(
        """SELECT cohort_definition_id, round(avg(age_years), 6) AS age_mean, round(stddev_samp(age_years), 6) AS age_sd,
                  round(avg(days_in_cohort), 6) AS days_mean, round(stddev_samp(days_in_cohort), 6) AS days_sd
           FROM entries GROUP BY 1"""
    ),
)
def means(spark, sf):
    rows = mean_sd(entries(spark, sf), ["cohort_definition_id"], ["age_years", "days_in_cohort"])
    return rows.select(
        "cohort_definition_id",
        *[F.round(f"{c}_{e}", 6).alias(f"{n}_{e}") for c, n in (("age_years", "age"), ("days_in_cohort", "days")) for e in ("mean", "sd")],
    )


COUNTS = """SELECT cohort_definition_id, count(DISTINCT subject_id) AS n_subjects,
                   count(*) FILTER (sex = 'Female') AS n_female, count(*) FILTER (sex = 'Male') AS n_male,
                   count(*) FILTER (age_years BETWEEN 0 AND 19) AS n_0_19, count(*) FILTER (age_years BETWEEN 20 AND 39) AS n_20_39,
                   count(*) FILTER (age_years BETWEEN 40 AND 59) AS n_40_59, count(*) FILTER (age_years BETWEEN 60 AND 79) AS n_60_79,
                   count(*) FILTER (age_years BETWEEN 80 AND 150) AS n_80_150
            FROM (SELECT DISTINCT cohort_definition_id, subject_id, age_years, sex FROM entries) GROUP BY 1"""


@query("a16_conditional_counts", with_tables(COUNTS))
def conditional(spark, sf):
    return conditional_counts(entries(spark, sf))


@query(
    "a17_percentages",
    with_tables(
        """SELECT cohort_definition_id, n_female * 100.0::DOUBLE / n_subjects AS female, n_20_39 * 100.0::DOUBLE / n_subjects AS age_20_39
           FROM counted""",
        {"counted": COUNTS},
    ),
)
def shares(spark, sf):
    from epiloom.functions.cells import percentage

    rows = conditional_counts(entries(spark, sf))
    return rows.select(
        "cohort_definition_id",
        percentage(F.col("n_female"), F.col("n_subjects")).alias("female"),
        percentage(F.col("n_20_39"), F.col("n_subjects")).alias("age_20_39"),
    )


def _text(value: str) -> str:
    return f"CAST(CAST({value} AS DECIMAL(38, 6)) AS VARCHAR)"


def characteristic_lines() -> str:
    lines = ["('Number records', 'NA', 'count', 'integer', CAST(n_records AS VARCHAR))",
             "('Number subjects', 'NA', 'count', 'integer', CAST(n_subjects AS VARCHAR))"]
    points = (("min", 0), ("q25", 0.25), ("median", 0.5), ("q75", 0.75), ("max", 1))
    for label, c in (("Cohort start date", "cohort_start_date"), ("Cohort end date", "cohort_end_date")):
        for e, _ in points:
            lines.append(f"('{label}', 'NA', '{e}', 'date', strftime(DATE '1970-01-01' + CAST(floor({c}_{e}) AS INT), '%Y-%m-%d'))")
    for label, c in (("Age", "age_years"), ("Prior observation", "prior_observation"),
                     ("Future observation", "future_observation"), ("Days in cohort", "days_in_cohort")):
        for e, _ in points:
            lines.append(f"('{label}', 'NA', '{e}', 'integer', {_text(f'{c}_{e}')})")
        for e in ("mean", "sd"):
            lines.append(f"('{label}', 'NA', '{e}', 'numeric', {_text(f'{c}_{e}')})")
    groups = [("Sex", "Female", "n_female"), ("Sex", "Male", "n_male")]
    groups += [("Age group", f"{a} to {b}", f"n_{a}_{b}") for a, b in ((0, 19), (20, 39), (40, 59), (60, 79), (80, 150))]
    for v, l, c in groups:
        lines.append(f"('{v}', '{l}', 'count', 'integer', CAST({c} AS VARCHAR))")
        lines.append(f"('{v}', '{l}', 'percentage', 'percentage', {_text(f'{c} * 100.0::DOUBLE / n_subjects')})")
    return ", ".join(lines)


def wide_columns() -> str:
    parts = ["count(*) AS n_records"]
    for c in ("cohort_start_date", "cohort_end_date"):
        parts.append(quartiles(c, f"CAST({c} - DATE '1970-01-01' AS DOUBLE)"))
    for c in ("age_years", "prior_observation", "future_observation", "days_in_cohort"):
        parts.append(quartiles(c, f"CAST({c} AS DOUBLE)"))
        parts.append(f"avg({c}) AS {c}_mean, stddev_samp({c}) AS {c}_sd")
    return ", ".join(parts)


@query(
    "x3_cohort_characteristics",
    with_tables(
        f"""SELECT cohort_definition_id, 'cohort_name' AS group_name, CAST(cohort_definition_id AS VARCHAR) AS group_level,
                  'overall' AS strata_name, 'overall' AS strata_level, l.variable_name, l.variable_level, l.estimate_name,
                  l.estimate_type, l.estimate_value, 'overall' AS additional_name, 'overall' AS additional_level
           FROM wide JOIN counted USING (cohort_definition_id),
                LATERAL (VALUES {characteristic_lines()}) l(variable_name, variable_level, estimate_name, estimate_type, estimate_value)""",
        {"counted": COUNTS, "wide": f"SELECT cohort_definition_id, {wide_columns()} FROM entries GROUP BY 1"},
    ),
)
def characteristics(spark, sf):
    cdm = clinical(spark, sf)
    return cohort_characteristics(outcome_cohorts(cdm), cdm.person, cdm.observation_period)


@query(
    "x4_snapshot",
    with_tables(
        """SELECT 1 AS result_id, CAST(NULL AS VARCHAR) AS cdm_name, 'overall' AS group_name, 'overall' AS group_level,
                  'overall' AS strata_name, 'overall' AS strata_level, l.variable_name, CAST(NULL AS VARCHAR) AS variable_level,
                  l.estimate_name, l.estimate_type, l.estimate_value, 'overall' AS additional_name, 'overall' AS additional_level
           FROM (SELECT (SELECT count(*) FROM person) AS people, count(*) AS n, min(op_start_date) AS a, max(op_end_date) AS b,
                        (SELECT max(n_name) FROM nation) AS vocabulary FROM op),
                (SELECT r_regionkey, r_name FROM region WHERE r_regionkey = 1),
                LATERAL (VALUES ('general', 'snapshot_date', 'date', '2001-08-01'),
                  ('general', 'person_count', 'integer', CAST(people AS VARCHAR)), ('general', 'vocabulary_version', 'character', vocabulary),
                  ('cdm', 'source_name', 'character', r_name), ('cdm', 'version', 'character', 'v' || r_regionkey), ('cdm', 'holder_name', 'character', 'holder of ' || r_name),
                  ('cdm', 'release_date', 'date', '2001-08-01'), ('cdm', 'description', 'character', 'orders of ' || r_name),
                  ('cdm', 'documentation_reference', 'character', NULL), ('observation_period', 'count', 'integer', CAST(n AS VARCHAR)),
                  ('observation_period', 'start_date', 'date', strftime(a, '%Y-%m-%d')),
                  ('observation_period', 'end_date', 'date', strftime(b, '%Y-%m-%d')),
                  ('settings', 'result_type', 'character', 'summarise_snapshot'), ('settings', 'package_name', 'character', 'epiloom'),
                  ('settings', 'package_version', 'character', '0.1.0'), ('settings', 'group', 'character', NULL),
                  ('settings', 'strata', 'character', NULL), ('settings', 'additional', 'character', NULL))
                l(variable_name, estimate_name, estimate_type, estimate_value)"""
    ),
)
def describe_database(spark, sf):
    cdm = clinical(spark, sf)
    return snapshot(cdm.person, cdm.observation_period, source(spark, sf), vocabulary(spark, sf), LATEST)


def source(spark, sf):
    """A region as the one row that describes where data come from; it names no vocabulary version."""
    name = F.col("r_name")
    return load_table(spark, sf, "region").filter("r_regionkey = 1").select(
        name.alias("cdm_source_name"), F.concat(F.lit("v"), "r_regionkey").alias("cdm_version"),
        F.concat(F.lit("holder of "), name).alias("cdm_holder"), F.lit(LATEST).alias("cdm_release_date"),
        F.concat(F.lit("orders of "), name).alias("source_description"), F.lit("").alias("vocabulary_version"),
    )


def vocabulary(spark, sf):
    """Nations as vocabularies; the first one stands for all."""
    names = F.when(F.col("n_nationkey") == 0, "None").otherwise(F.col("n_name"))
    return load_table(spark, sf, "nation").select(names.alias("vocabulary_id"), F.col("n_name").alias("vocabulary_version"))


@query(
    "x4_source_information",
    """SELECT r_name || ' (v25 2001-08-01)' AS cdm_source_name, 'v' || r_regionkey AS cdm_version, 'holder of ' || r_name AS cdm_holder,
              DATE '2001-08-01' AS cdm_release_date, '' AS vocabulary_version_cdm, n_name AS vocabulary_version,
              25 AS version_id, '2001-08-01' AS version_date, text AS source_description, text AS database_description
       FROM (SELECT *, 'orders of ' || r_name || ' ETL Reference: None CDM release date: 2001-08-01 Source release date: None Source Documentation Reference: None (v25 2001-08-01)' AS text
             FROM region WHERE r_regionkey = 1), nation WHERE n_nationkey = 0""",
)
def describe_source(spark, sf):
    loads = load_table(spark, sf, "nation").agg(F.count(F.lit(1)).cast("int").alias("version_id")).withColumn("version_date", F.lit(LATEST))
    return source_information(source(spark, sf), vocabulary(spark, sf), loads)


STUDY = {
    "everything": """SELECT * FROM outcome UNION ALL SELECT cohort_definition_id + 10, subject_id, cohort_start_date, cohort_end_date FROM ailment""",
    "first_event": """SELECT cohort_definition_id AS outcome_id, subject_id, min(cohort_start_date) AS first_event_date
                      FROM everything GROUP BY 1, 2""",
    "paired": """
        SELECT o.outcome_id, d.subject_id, d.cohort_definition_id AS denom_id, cohort_start_date, cohort_end_date, first_event_date
        FROM denom d CROSS JOIN (SELECT DISTINCT cohort_definition_id AS outcome_id FROM everything) o
        LEFT JOIN first_event f ON f.subject_id = d.subject_id AND f.outcome_id = o.outcome_id""",
}


@query(
    "x5_incidence_study",
    with_tables(
        """SELECT denom_id, CASE WHEN outcome_id > 10 THEN outcome_id - 10 ELSE outcome_id END AS outcome_id, cal_year, cal_month,
                  outcome_count, denom_count, person_days, person_years, incidence_100000_pys,
                  CASE WHEN outcome_id > 10 THEN 'condition_cohorts' ELSE 'outcome_cohorts' END AS outcome_table
           FROM monthly""",
        STUDY,
    ),
)
def study(spark, sf):
    cdm = clinical(spark, sf)
    tables = {"outcome_cohorts": outcome_cohorts(cdm), "condition_cohorts": condition_cohorts(cdm)}
    analyses = [Analysis("outcome_cohorts", i) for i in IDS] + [Analysis("condition_cohorts", i) for i in (1, 2, 3)]
    return study_incidence(stored_strata(spark, sf), tables, analyses)


@query(
    "x5_study_export",
    with_tables(
        """SELECT denom_id, outcome_id, coalesce(name, 'outcome_cohorts_' || outcome_id) AS outcome_name, cal_year, cal_month,
                  CASE WHEN outcome_count BETWEEN 1 AND 4 THEN NULL ELSE outcome_count END AS outcome_count,
                  CASE WHEN denom_count BETWEEN 1 AND 4 THEN NULL ELSE denom_count END AS denom_count, person_days,
                  CASE WHEN outcome_count BETWEEN 1 AND 4 THEN NULL ELSE round(incidence_100000_pys, 6) END AS rate
           FROM monthly LEFT JOIN names ON names.id = outcome_id""",
        {
            "names": """SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS id,
                               lower(substr(o_orderpriority, 3)) AS name FROM orders WHERE o_orderpriority <> '5-LOW'"""
        },
    ),
)
def exported_study(spark, sf):
    """A whole study, exported, and its incidence rows read back from the files."""
    cdm = clinical(spark, sf)
    analyses = [Analysis("outcome_cohorts", i) for i in IDS]
    found = incidence_study(cdm, {"outcome_cohorts": outcome_cohorts(cdm)}, analyses, outcome_names(spark, sf), START, LATEST)
    path = scratch_path(spark, "study")
    export_study(found, 5, path)
    rows = spark.read.csv(f"{path}/incidence_and_characteristics", header=True, inferSchema=True).filter("cal_year IS NOT NULL")
    shown = ["denom_id", "outcome_id", "outcome_name", "cal_year", "cal_month", "outcome_count", "denom_count", "person_days"]
    types = {"denom_id": "int", "outcome_name": "string", "cal_year": "int", "cal_month": "int"}
    return rows.select(
        *[F.col(c).cast(types.get(c, "long")).alias(c) for c in shown],
        F.round(F.col("incidence_100000_pys").cast("double"), 6).alias("rate"),
    )


@query(
    "x6_failed_log",
    with_tables(
        f"""SELECT 'outcome_cohorts' AS outcome_table_name, outcome_id, count(*) AS estimated FROM monthly WHERE outcome_id <> {IDS[1]} GROUP BY 2
            UNION ALL SELECT 'outcome_cohorts', {IDS[1]}, NULL
            UNION ALL SELECT DISTINCT 'missing_cohorts', outcome_id, NULL FROM monthly"""
    ),
)
def failures(spark, sf):
    """A study in which a table is missing and one outcome of another can't be read: what failed, next to what was estimated."""
    rows = outcomes(spark, sf)
    unreadable = F.when(F.col("cohort_definition_id") == IDS[1], F.raise_error(F.lit("unreadable")).cast("date"))
    rows = rows.withColumn("cohort_start_date", unreadable.otherwise(F.col("cohort_start_date")))
    analyses = [Analysis(t, i) for t in ("missing_cohorts", "outcome_cohorts") for i in IDS]
    denominators = stored_strata(spark, sf)
    done, failed = run_or_log(spark, analyses, lambda group: study_incidence(denominators, {"outcome_cohorts": rows}, group))
    estimated = done.groupBy(F.col("outcome_table").alias("outcome_table_name"), "outcome_id").agg(F.count(F.lit(1)).alias("estimated"))
    return estimated.unionByName(failed.drop("error_message"), allowMissingColumns=True)


def _limit(column: str) -> str:
    return f"CAST(CAST(round({column} / (person_days / 365.25::DOUBLE) * 100000, 3) AS DECIMAL(38,3)) AS VARCHAR)"


INTERVALS = {
    "years": YEARLY,
    "overall": OVERALL,
    "spans": f"""
        SELECT denom_id, outcome_id, make_date(cal_year, cal_month, 1) AS a, last_day(make_date(cal_year, cal_month, 1)) AS b,
               'months' AS name, outcome_count, denom_count, person_days FROM monthly
        UNION ALL SELECT denom_id, outcome_id, make_date(cal_year, 1, 1), make_date(cal_year, 12, 31), 'years', outcome_count,
               max_monthly_denominator, person_days FROM years
        UNION ALL SELECT denom_id, outcome_id, DATE '{START}', DATE '{LATEST}', 'overall', outcome_count,
               max_monthly_denominator, person_days FROM overall""",
    "hidden": """
        SELECT denom_id, outcome_id, a, b, name, person_days,
               CASE WHEN denom_count BETWEEN 1 AND 4 THEN NULL ELSE denom_count END AS denom_count,
               CASE WHEN outcome_count BETWEEN 1 AND 4 THEN NULL ELSE outcome_count END AS outcome_count FROM spans""",
}


@query(
    "x2_summarised_result",
    with_tables(
        f"""SELECT 1 AS result_id, CAST(NULL AS VARCHAR) AS cdm_name, '{INCIDENCE_GROUP}' AS group_name,
                  'denominator_cohort_' || denom_id || ' &&& outcome_cohorts_' || outcome_id AS group_level,
                  'overall' AS strata_name, 'overall' AS strata_level, l.variable_name, CAST(NULL AS VARCHAR) AS variable_level,
                  l.estimate_name, l.estimate_type, l.estimate_value, '{INCIDENCE_ADDITIONAL}' AS additional_name,
                  strftime(a, '%Y-%m-%d') || ' &&& ' || strftime(b, '%Y-%m-%d') || ' &&& ' || name AS additional_level
           FROM hidden LEFT JOIN limits ON k = outcome_count, LATERAL (VALUES
             ('Denominator', 'denominator_count', 'integer', CAST(denom_count AS VARCHAR)),
             ('Denominator', 'person_days', 'numeric', {_text('person_days')}),
             ('Denominator', 'person_years', 'numeric', {_text('person_days / 365.25::DOUBLE')}),
             ('Outcome', 'outcome_count', 'integer', CAST(outcome_count AS VARCHAR)),
             ('Outcome', 'incidence_100000_pys', 'numeric', {_text('outcome_count / (person_days / 365.25::DOUBLE) * 100000')}),
             ('Outcome', 'incidence_100000_pys_95CI_lower', 'numeric', {_limit('lower_limit')}),
             ('Outcome', 'incidence_100000_pys_95CI_upper', 'numeric', {_limit('upper_limit')}))
             l(variable_name, estimate_name, estimate_type, estimate_value)
           UNION ALL SELECT 1, NULL, 'overall', 'overall', 'overall', 'overall', 'settings', NULL, name, 'character', value, 'overall', 'overall'
           FROM (VALUES ('result_type', 'incidence'), ('package_name', 'epiloom'), ('package_version', '0.1.0'),
             ('group', 'denominator_cohort_name &&& outcome_cohort_name'), ('strata', NULL),
             ('additional', 'incidence_start_date &&& incidence_end_date &&& interval_name'), ('min_cell_count', '5')) s(name, value)""",
        {**LIMITS, **INTERVALS, "ks": "SELECT DISTINCT outcome_count AS k FROM hidden WHERE outcome_count > 0"},
        recursive=True,
    ),
)
def long_result(spark, sf):
    """All rows and columns; limits in three decimals, as both ways of finding them agree to about ten digits."""
    rows = stored_monthly(spark, sf).withColumn("outcome_name", F.concat_ws("_", F.lit("outcome_cohorts"), "outcome_id"))
    return to_summarised_result(rows, START, LATEST, 5, limit_digits=3)


STANDARD = {
    "observed_years": """
        SELECT p.person_id, y AS cal_year, CAST(floor((y - year_of_birth) / 10) AS INT) AS age_group, gender_concept_id AS sex
        FROM op JOIN person p ON p.person_id = op.person_id,
             LATERAL (SELECT unnest(range(year(op_start_date), year(op_end_date) + 1)) AS y)""",
    "size": "SELECT cal_year, age_group, sex, count(*) AS population FROM observed_years GROUP BY 1, 2, 3",
    "hits": """SELECT CAST(year(first_event_date) AS INT) AS cal_year,
                      CAST(floor((year(first_event_date) - year_of_birth) / 10) AS INT) AS age_group,
                      gender_concept_id AS sex, count(*) AS events
               FROM first_event JOIN person p ON p.person_id = subject_id WHERE outcome_id = 1 GROUP BY 1, 2, 3""",
    "rated": "SELECT s.*, coalesce(events, 0) AS events FROM size s LEFT JOIN hits USING (cal_year, age_group, sex)",
    # A reference with strata that the data lack: an age group nobody is in.
    "weights": """SELECT age_group, sex, sum(population) AS weight FROM size GROUP BY 1, 2
                  UNION ALL SELECT 99, sex, count(*) FROM size GROUP BY sex""",
    "full_strata": """SELECT cal_year, age_group, sex, weight, coalesce(events, 0) AS events, coalesce(population, 0) AS population
                      FROM (SELECT DISTINCT cal_year FROM rated) CROSS JOIN weights
                      LEFT JOIN rated USING (cal_year, age_group, sex)""",
}


@query(
    "a24_age_adjusted_rate",
    with_tables(
        """SELECT cal_year, CAST(sum(events) AS BIGINT) AS events, CAST(sum(population) AS BIGINT) AS population,
                  round(sum(events) / sum(population) * 100000, 6) AS crude_rate,
                  round(sum(CASE WHEN population > 0 THEN events / population * weight ELSE 0 END) / sum(weight) * 100000, 6) AS adjusted_rate
           FROM full_strata GROUP BY 1""",
        STANDARD,
    ),
)
def adjusted(spark, sf):
    rows = standardized(spark, sf)
    return rows.withColumns({c: F.round(c, 6) for c in ("crude_rate", "adjusted_rate")})


def standardized(spark, sf, limits=False):
    cdm = clinical(spark, sf)
    person = cdm.person.select("person_id", "year_of_birth", F.col("gender_concept_id").alias("sex"))
    group = lambda year: F.floor((year - F.col("year_of_birth")) / 10).cast("int").alias("age_group")
    years = periods(cdm.observation_period).select(
        "person_id", F.explode(F.sequence(F.year("op_start_date"), F.year("op_end_date"))).alias("cal_year")
    )
    keys = ["cal_year", "age_group", "sex"]
    size = years.join(person, "person_id").groupBy("cal_year", group(F.col("cal_year")), "sex").agg(
        F.count(F.lit(1)).alias("population")
    )
    firsts = inc.first_event(outcome_cohorts(cdm).filter("cohort_definition_id = 1"))
    year = F.year("first_event_date")
    hits = firsts.join(person, F.col("subject_id") == F.col("person_id")).groupBy(
        year.alias("cal_year"), group(year), "sex"
    ).agg(F.count(F.lit(1)).alias("events"))
    rated = size.join(hits, keys, "left").fillna(0, ["events"])
    weights = size.groupBy("age_group", "sex").agg(F.sum("population").alias("weight"))
    weights = weights.union(size.groupBy("sex").agg(F.count(F.lit(1)).alias("n")).select(F.lit(99), "sex", "n"))
    return inc.age_adjusted_rate(rated, weights, ["cal_year"], ["age_group", "sex"], limits)


# The gamma distribution function as a series, in logarithms; bisection on it.
GAMMA_BELOW = "list_sum([exp((shape + j) * ln((lo + hi) / 2) - (lo + hi) / 2 - lgamma(shape + j + 1)) FOR j IN range(CAST((lo + hi) / 2 + 12 * sqrt((lo + hi) / 2) + 80 AS BIGINT))])"


@query(
    "a24_adjusted_rate_limits",
    with_tables(
        """SELECT m.cal_year, round(r * 100000, 6) AS adjusted_rate, round(max(scale * lo) FILTER (side = 'lower') * 100000, 4) AS adjusted_rate_95CI_lower,
                  round(max(scale * lo) FILTER (side = 'upper') * 100000, 4) AS adjusted_rate_95CI_upper
           FROM moments m LEFT JOIN bisect b ON b.cal_year = m.cal_year AND i = 70 GROUP BY m.cal_year, r""",
        {
            **STANDARD,
            "moments": """SELECT cal_year, sum(CASE WHEN population > 0 THEN events / population * weight ELSE 0 END) / sum(weight) AS r,
                                 sum(CASE WHEN population > 0 THEN events * (weight / population) * (weight / population) END) / sum(weight) / sum(weight) AS v,
                                 max(CASE WHEN population > 0 THEN weight / population END) / sum(weight) AS w
                          FROM full_strata GROUP BY 1""",
            "goal": """SELECT cal_year, 'lower' AS side, 0.025 AS p, r * r / v AS shape, v / r AS scale FROM moments WHERE r > 0
                       UNION ALL SELECT cal_year, 'upper', 0.975, (r + w) * (r + w) / (v + w * w), (v + w * w) / (r + w) FROM moments WHERE r > 0""",
            "bisect": f"""SELECT cal_year, side, p, shape, scale, CAST(0 AS DOUBLE) AS lo, CAST(2 * shape + 40 AS DOUBLE) AS hi, 0 AS i FROM goal
                          UNION ALL
                          SELECT cal_year, side, p, shape, scale, CASE WHEN below THEN (lo + hi) / 2 ELSE lo END, CASE WHEN below THEN hi ELSE (lo + hi) / 2 END, i + 1
                          FROM (SELECT *, {GAMMA_BELOW} < p AS below FROM bisect WHERE i < 70)""",
        },
        recursive=True,
    ),
)
def adjusted_limits(spark, sf):
    rows = standardized(spark, sf, limits=True)
    limits = {f"adjusted_rate_95CI_{side}": F.round(f"adjusted_rate_95CI_{side}", 4) for side in ("lower", "upper")}
    return rows.withColumns({"adjusted_rate": F.round("adjusted_rate", 6), **limits}).drop("events", "population", "crude_rate")
