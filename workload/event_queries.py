"""Sources, events, filters, codesets."""

from datetime import date

from pyspark.sql import functions as F

from epiloom import schema
from epiloom.functions.dates import birth_date
from epiloom.functions.names import camel, levels
from epiloom.operators.codesets import expand_codesets, match_codeset, match_codeset_in, stored_codesets
from epiloom.operators.counts import cohort_counts
from epiloom.operators.events import (
    compare,
    domain_events,
    filter_age,
    filter_date,
    first_ever,
    longer_than,
    sex_label,
)
from epiloom.operators.observation import (
    attach_observation,
    in_observation,
    latest_data_date,
    observation_with_death,
    prior_observation,
    study_window,
)
from epiloom.operators.population import first_only
from epiloom.session import scratch_path
from epiloom.sources import export, tables
from workload.registry import query
from workload.tables import LATEST, PRIORITY, SETS, clinical, outcome_cohorts, with_tables


@query("s1_load_table", "SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders")
def load_table(spark, sf):
    orders = tables.load_table(spark, sf, "orders")
    return orders.select("o_orderkey", "o_custkey", "o_totalprice", F.col("o_orderdate").cast("date").alias("o_orderdate"))


@query(
    "s2_read_settings",
    """SELECT CAST(1 AS BIGINT) AS denominator_id, 'all_population' AS denominator_name,
              'all_population' AS denominator_table_name, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS outcome_id,
              o_orderpriority AS outcome_name, 'outcome_cohorts' AS outcome_table_name, CAST(NULL AS VARCHAR) AS time_at_risk
       FROM (SELECT DISTINCT o_orderpriority FROM orders)""",
)
def read_settings(spark, sf):
    outcomes = tables.load_table(spark, sf, "orders").select("o_orderpriority").distinct()
    path = scratch_path(spark, "settings")
    outcomes.select(
        F.lit(1).alias("denominator_id"), F.lit("all_population").alias("denominator_name"),
        F.lit("all_population").alias("denominator_table_name"),
        F.substring("o_orderpriority", 1, 1).alias("outcome_id"), F.col("o_orderpriority").alias("outcome_name"),
        F.lit("outcome_cohorts").alias("outcome_table_name"), F.lit("NA").alias("time_at_risk"),
    ).write.csv(path, header=True)
    return tables.read_settings(spark, path, schema.ANALYSES)


@query(
    "s3_replace_cohort",
    with_tables(
        """SELECT cohort_definition_id, subject_id, cohort_start_date, cohort_end_date FROM outcome WHERE cohort_definition_id NOT IN (1, 2)
           UNION ALL
           SELECT cohort_definition_id, subject_id, min(cohort_start_date), min(cohort_end_date)
           FROM outcome WHERE cohort_definition_id = 1 GROUP BY 1, 2"""
    ),
)
def replace_cohort(spark, sf):
    rows = outcome_cohorts(clinical(spark, sf))
    path = scratch_path(spark, "cohorts")
    """Two cohorts are made anew: 1 with its first rows, 2 without any."""
    tables.replace_cohort(rows, [r[0] for r in rows.select("cohort_definition_id").distinct().collect()], path)
    again = first_only(rows.filter("cohort_definition_id = 1"))
    tables.replace_cohort(again, [1, 2], path)
    return tables.read_cohorts(spark, path)


@query(
    "s4_materialize",
    with_tables(
        """SELECT cohort_definition_id, count(*) AS number_records, count(DISTINCT subject_id) AS number_subjects
           FROM outcome GROUP BY 1"""
    ),
)
def materialize(spark, sf):
    return cohort_counts(tables.materialize(outcome_cohorts(clinical(spark, sf)), "outcome"))


@query(
    "s5_export_results",
    with_tables(
        """SELECT c_nationkey AS nation, CASE WHEN n BETWEEN 1 AND 4 THEN NULL ELSE n END AS urgent_count
           FROM (SELECT c_nationkey, count(o_orderkey) FILTER (o_orderpriority = '1-URGENT' AND c_acctbal < 0) AS n
                 FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1)"""
    ),
)
def export_results(spark, sf):
    customer = tables.load_table(spark, sf, "customer")
    orders = tables.load_table(spark, sf, "orders")
    counts = (
        customer.join(orders, F.col("o_custkey") == F.col("c_custkey"), "left")
        .groupBy(F.col("c_nationkey").alias("nation"))
        .agg(F.count(F.when((F.col("o_orderpriority") == "1-URGENT") & (F.col("c_acctbal") < 0), 1)).alias("urgent_count"))
    )
    path = scratch_path(spark, "export")
    export.export_results(counts, 5, path)
    return spark.read.csv(path, header=True, schema="nation int, urgent_count bigint")


@query("s6_latest_data_date", with_tables("SELECT max(op_end_date) AS max_end_date FROM op"))
def latest_date(spark, sf):
    return latest_data_date(clinical(spark, sf).observation_period)


@query(
    "s7_cohort_exists",
    with_tables(
        """SELECT cohort_definition_id, count(*) AS number_records, true AS present, false AS absent
           FROM outcome GROUP BY 1"""
    ),
)
def cohort_exists(spark, sf):
    rows = outcome_cohorts(clinical(spark, sf))
    rows.createOrReplaceTempView("outcome_cohorts")
    return rows.groupBy("cohort_definition_id").agg(
        F.count(F.lit(1)).alias("number_records"),
        F.lit(tables.cohort_exists(spark, "outcome_cohorts")).alias("present"),
        F.lit(tables.cohort_exists(spark, "no_such_cohorts")).alias("absent"),
    )


for _number, _domain in (
    (1, "condition"), (2, "drug"), (3, "procedure"), (4, "measurement"), (5, "visit"),
    (6, "death"), (8, "observation_period"), (9, "observation"),
):
    _where = {
        "observation_period": " WHERE start_date <= DATE '1996-01-01' AND end_date >= DATE '1996-01-01'",
    }.get(_domain, "")

    @query(f"f{_number}_events_{_domain}", with_tables(f"SELECT * FROM e_{_domain}{_where}"))
    def events(spark, sf, domain=_domain):
        rows = domain_events(clinical(spark, sf), domain)
        if domain == "observation_period":
            day = date(1996, 1, 1)
            rows = filter_date(filter_date(rows, "lte", day), "gte", day, column="end_date")
        return rows


@query("f7_events_drug_era", with_tables("SELECT * FROM e_drug_era WHERE end_date - start_date > 30"))
def drug_eras(spark, sf):
    return longer_than(domain_events(clinical(spark, sf), "drug_era"), 30)


@query(
    "f10_filter_age",
    with_tables(
        """SELECT e.*, year(start_date) - year_of_birth >= 35 AS at_least_35
           FROM e_condition e JOIN person p ON p.person_id = e.person_id
           WHERE year(start_date) - year_of_birth >= 35
           UNION ALL
           SELECT e.*, false FROM e_condition e JOIN person p ON p.person_id = e.person_id
           WHERE year(start_date) - year_of_birth < 18"""
    ),
)
def age(spark, sf):
    cdm = clinical(spark, sf)
    rows = domain_events(cdm, "condition")
    grown = filter_age(rows, cdm.person, "gte", 35).withColumn("at_least_35", F.lit(True))
    return grown.union(filter_age(rows, cdm.person, "lt", 18).withColumn("at_least_35", F.lit(False)))


@query(
    "f11_filter_date",
    with_tables(
        """SELECT event_id, start_date, start_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31' AS bt,
                  start_date < DATE '1997-03-01' AS lt, start_date <= DATE '1997-03-01' AS lte,
                  start_date > DATE '1997-03-01' AS gt, start_date >= DATE '1997-03-01' AS gte
           FROM e_condition WHERE start_date >= DATE '1996-01-01'"""
    ),
)
def dates(spark, sf):
    rows = filter_date(domain_events(clinical(spark, sf), "condition"), "gte", date(1996, 1, 1))
    start, day = F.col("start_date"), F.lit(date(1997, 3, 1))
    return rows.select(
        "event_id",
        "start_date",
        compare(start, "bt", F.lit(date(1996, 1, 1)), F.lit(date(1998, 12, 31))).alias("bt"),
        *[compare(start, op, day).alias(op) for op in ("lt", "lte", "gt", "gte")],
    )


@query(
    "f12_age_at_period_start",
    with_tables(
        """SELECT e.* FROM e_observation_period e JOIN person p ON p.person_id = e.person_id
           WHERE year(start_date) - year_of_birth < 18"""
    ),
)
def age_at_period_start(spark, sf):
    cdm = clinical(spark, sf)
    return filter_age(domain_events(cdm, "observation_period"), cdm.person, "lt", 18)


@query(
    "f13_in_observation",
    with_tables(
        """SELECT person_id AS subject_id, event_id, start_date AS cohort_start_date FROM e_procedure e
           WHERE EXISTS (SELECT 1 FROM op WHERE op.person_id = e.person_id AND e.start_date BETWEEN op_start_date AND op_end_date)"""
    ),
)
def observed(spark, sf):
    cdm = clinical(spark, sf)
    rows = domain_events(cdm, "procedure").select(
        F.col("person_id").alias("subject_id"), "event_id", F.col("start_date").alias("cohort_start_date")
    )
    return in_observation(rows, cdm.observation_period)


@query(
    "f14_prior_observation",
    with_tables(
        """SELECT o.*, CAST(cohort_start_date - op_start_date AS INT) AS prior_observation
           FROM outcome o JOIN op ON op.person_id = o.subject_id AND cohort_start_date BETWEEN op_start_date AND op_end_date
           WHERE cohort_start_date - op_start_date >= 365"""
    ),
)
def prior(spark, sf):
    cdm = clinical(spark, sf)
    return prior_observation(outcome_cohorts(cdm), cdm.observation_period).filter("prior_observation >= 365")


@query(
    "f15_study_window",
    with_tables(
        f"SELECT * FROM outcome WHERE cohort_start_date > DATE '1996-01-01' AND cohort_start_date < DATE '{LATEST}' - 365"
    ),
)
def window(spark, sf):
    return study_window(outcome_cohorts(clinical(spark, sf)), date(1996, 1, 1), LATEST)


@query(
    "f16_sex_label",
    with_tables(
        "SELECT person_id, CASE gender_concept_id WHEN 8532 THEN 'Female' WHEN 8507 THEN 'Male' ELSE 'Other/Unknown' END AS sex FROM person"
    ),
)
def sex(spark, sf):
    return clinical(spark, sf).person.select("person_id", sex_label(F.col("gender_concept_id")).alias("sex"))


def codesets(cdm):
    return stored_codesets(SETS, cdm.concept, cdm.concept_ancestor)


@query("j1_codeset_expand", with_tables("SELECT CAST(codeset_id AS INT) AS codeset_id, concept_id FROM codesets"))
def codeset_expand(spark, sf):
    cdm = clinical(spark, sf)
    return expand_codesets(SETS, cdm.concept, cdm.concept_ancestor)


MATCHED = with_tables(
    "SELECT e.* FROM e_procedure e JOIN codesets c ON c.concept_id = e.target_concept_id AND c.codeset_id = 1"
)


@query("j2_match_codeset", MATCHED)
def matched(spark, sf):
    cdm = clinical(spark, sf)
    return match_codeset(domain_events(cdm, "procedure"), codesets(cdm), 1)


@query("j3_match_codeset_in", MATCHED)
def matched_in(spark, sf):
    cdm = clinical(spark, sf)
    return match_codeset_in(domain_events(cdm, "procedure"), codesets(cdm), 1)


@query(
    "j4_attach_observation",
    with_tables(
        """SELECT e.*, op_start_date, op_end_date FROM e_drug e JOIN op ON op.person_id = e.person_id
           WHERE op_start_date + 365 <= start_date AND start_date + 30 <= op_end_date"""
    ),
)
def observation(spark, sf):
    cdm = clinical(spark, sf)
    return attach_observation(domain_events(cdm, "drug"), cdm.observation_period, 365, 30)


@query(
    "j17_observation_with_death",
    with_tables(
        """SELECT op.person_id AS subject_id, op_start_date AS observation_period_start_date,
                  op_end_date AS observation_period_end_date, death_date,
                  CASE WHEN death_date IS NULL THEN 0 ELSE 1 END AS death
           FROM op LEFT JOIN death d ON d.person_id = op.person_id"""
    ),
)
def with_death(spark, sf):
    cdm = clinical(spark, sf)
    return observation_with_death(cdm.observation_period, cdm.death)


@query(
    "w4_first_ever_occurrence",
    with_tables(
        """SELECT * EXCLUDE (n) FROM (
             SELECT *, row_number() OVER (PARTITION BY person_id
                      ORDER BY start_date, event_id, end_date, target_concept_id, visit_occurrence_id) AS n FROM e_drug)
           WHERE n = 1 AND start_date > DATE '1995-02-01'"""
    ),
)
def first_occurrence(spark, sf):
    return filter_date(first_ever(domain_events(clinical(spark, sf), "drug")), "gt", date(1995, 2, 1))


@query(
    "c1_c2_date_functions",
    with_tables(
        """SELECT event_id, start_date + 30 AS plus_30, CAST(end_date - start_date AS INT) AS days,
                  CAST(year(start_date) AS INT) AS y, make_date(2012, 1, 1) AS fixed,
                  CAST(start_date + INTERVAL 12 MONTH AS DATE) AS plus_year, CAST(date_trunc('month', start_date) AS DATE) AS month_start,
                  last_day(start_date) AS month_end, CAST(month(start_date) AS INT) AS m,
                  CAST(date_diff('month', start_date, start_date + 400) + 1 AS INT) AS months_met
           FROM e_condition"""
    ),
)
def date_functions(spark, sf):
    from epiloom.functions.dates import month_grid, month_start

    start = F.col("start_date")
    return domain_events(clinical(spark, sf), "condition").select(
        "event_id",
        F.date_add(start, 30).alias("plus_30"),
        F.datediff("end_date", start).alias("days"),
        F.year(start).alias("y"),
        F.make_date(F.lit(2012), F.lit(1), F.lit(1)).alias("fixed"),
        F.add_months(start, 12).alias("plus_year"),
        month_start(start).alias("month_start"),
        F.last_day(start).alias("month_end"),
        F.month(start).alias("m"),
        F.size(month_grid(start, F.date_add(start, 400))).alias("months_met"),
    )


@query(
    "c3_c4_birth_date",
    with_tables(
        """SELECT person_id, make_date(year_of_birth, coalesce(nullif(month_of_birth, 0), 1), coalesce(nullif(day_of_birth, 0), 1)) AS dob
           FROM person"""
    ),
)
def birth_dates(spark, sf):
    return clinical(spark, sf).person.select(
        "person_id", birth_date(F.col("year_of_birth"), F.col("month_of_birth"), F.col("day_of_birth")).alias("dob")
    )


@query(
    "c5_c6_c7_c8_formats",
    with_tables(
        f"""SELECT event_id, strftime(start_date, '%Y-%m-%d') || ' &&& ' || strftime(end_date, '%Y-%m-%d') AS level,
                  lpad(CAST(month(start_date) AS VARCHAR), 2, '0') AS padded,
                  CAST(power(2, target_concept_id - {PRIORITY}) AS BIGINT) AS bit,
                  greatest(start_date, DATE '1997-01-01') AS later, least(start_date, DATE '1997-01-01') AS earlier,
                  CAST(event_id % 123 AS BIGINT) AS remainder, 'AcuteCohorts' AS folder
           FROM e_condition"""
    ),
)
def formats(spark, sf):
    start, day = F.col("start_date"), F.lit(date(1997, 1, 1))
    text = [F.date_format(c, "yyyy-MM-dd") for c in ("start_date", "end_date")]
    return domain_events(clinical(spark, sf), "condition").select(
        "event_id",
        levels(*text).alias("level"),
        F.lpad(F.month(start).cast("string"), 2, "0").alias("padded"),
        F.expr(f"shiftleft(1L, cast(target_concept_id - {PRIORITY} as int))").alias("bit"),
        F.greatest(start, day).alias("later"),
        F.least(start, day).alias("earlier"),
        (F.col("event_id") % 123).alias("remainder"),
        F.lit(camel("acute_cohorts")).alias("folder"),
    )
