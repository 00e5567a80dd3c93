"""Cohorts against cohorts, populations, counts, set operations."""

from datetime import date

from pyspark.sql import functions as F

from epiloom.functions.cells import suppress_small
from epiloom.operators.counts import cohort_counts, counts_with_zero
from epiloom.operators.events import domain_events, first_rows
from epiloom.operators.followup import (
    event_washout,
    intersect_date,
    intersect_days,
    intersect_flag,
    k_of_n_levels,
    outcome_after_index,
    outcome_at_risk,
    shifted_union,
    symptom_counts,
)
from epiloom.operators.population import (
    anchor_start,
    first_only,
    observation_as_cohort,
    population_features,
    sample_n,
)
from epiloom.operators.results import bind_rows
from epiloom.operators.snapshot import person_count, period_summary
from epiloom.plans import post_infection as post
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

RULES = post.EntryRules(study_start=START, latest=LATEST)

POST = {
    "infection": "SELECT * FROM acute WHERE cohort_definition_id = 1",
    "flu": "SELECT * FROM acute WHERE cohort_definition_id = 2",
    "i_previous": """SELECT subject_id, cohort_start_date,
                            CAST(max(t) - cohort_start_date AS INT) AS days_since_previous
                     FROM (SELECT i.subject_id, i.cohort_start_date, p.cohort_start_date AS t FROM infection i
                           LEFT JOIN infection p ON p.subject_id = i.subject_id AND p.cohort_start_date < i.cohort_start_date)
                     GROUP BY subject_id, cohort_start_date""",
    "i_flu": """SELECT subject_id, cohort_start_date, CAST(max(t) - cohort_start_date AS INT) AS days_since_influenza
                FROM (SELECT i.subject_id, i.cohort_start_date, f.cohort_start_date AS t FROM infection i
                      LEFT JOIN flu f ON f.subject_id = i.subject_id
                       AND f.cohort_start_date BETWEEN i.cohort_start_date - 90 AND i.cohort_start_date - 1)
                GROUP BY subject_id, cohort_start_date""",
    "i_next": """SELECT subject_id, cohort_start_date, min(t) AS next_date
                 FROM (SELECT i.subject_id, i.cohort_start_date, f.cohort_start_date AS t FROM infection i
                       LEFT JOIN infection f ON f.subject_id = i.subject_id
                        AND f.cohort_start_date BETWEEN i.cohort_start_date + 1 AND i.cohort_start_date + 365)
                 GROUP BY subject_id, cohort_start_date""",
    "known": """SELECT i.*, days_since_previous, days_since_influenza, next_date, op_start_date, op_end_date, death_date,
                       least(op_end_date, death_date, next_date) AS follow_up_end
                FROM infection i JOIN i_previous USING (subject_id, cohort_start_date)
                JOIN i_flu USING (subject_id, cohort_start_date) JOIN i_next USING (subject_id, cohort_start_date)
                LEFT JOIN op ON op.person_id = subject_id AND cohort_start_date BETWEEN op_start_date AND op_end_date
                LEFT JOIN death d ON d.person_id = subject_id""",
    "step": f"""SELECT *, CAST(CASE
                  WHEN NOT (days_since_previous IS NULL OR days_since_previous < -42) THEN 0
                  WHEN op_end_date IS NULL THEN 1
                  WHEN cohort_start_date - op_start_date < 365 THEN 2
                  WHEN days_since_influenza IS NOT NULL THEN 3
                  WHEN NOT (cohort_start_date > DATE '{START}' AND cohort_start_date < DATE '{LATEST}' - 365) THEN 4
                  WHEN follow_up_end - cohort_start_date < 120 THEN 5 ELSE 6 END AS INT) AS passed FROM known""",
    "kept": """SELECT CAST(1 AS BIGINT) AS cohort_definition_id, subject_id, cohort_start_date, follow_up_end AS cohort_end_date
               FROM step WHERE passed = 6""",
    "symptom_after": """
        SELECT DISTINCT s.cohort_definition_id, s.subject_id, s.cohort_start_date, s.cohort_end_date
        FROM symptom s JOIN kept k ON k.subject_id = s.subject_id
         AND s.cohort_start_date - k.cohort_start_date BETWEEN 91 AND 365
        WHERE NOT EXISTS (SELECT 1 FROM symptom b WHERE b.subject_id = s.subject_id
                AND b.cohort_definition_id = s.cohort_definition_id AND b.cohort_start_date <= k.cohort_start_date - 1
                AND b.cohort_end_date >= k.cohort_start_date - 180)""",
    "ailment_after": """
        SELECT DISTINCT s.cohort_definition_id, s.subject_id, s.cohort_start_date, s.cohort_end_date
        FROM ailment s JOIN kept k ON k.subject_id = s.subject_id
         AND s.cohort_start_date - k.cohort_start_date BETWEEN 91 AND 365
        WHERE NOT EXISTS (SELECT 1 FROM ailment b WHERE b.subject_id = s.subject_id
                AND b.cohort_definition_id = s.cohort_definition_id AND b.cohort_start_date <= k.cohort_start_date - 1
                AND b.cohort_end_date >= k.cohort_start_date - 180)""",
}


def k_of_n_sql(source: str, shift: int) -> str:
    return f"""
        SELECT CAST(k + {shift} AS BIGINT) AS cohort_definition_id, subject_id, cohort_start_date, cohort_end_date FROM (
          SELECT *, row_number() OVER (PARTITION BY subject_id ORDER BY cohort_start_date, cohort_end_date) AS rn,
                 count(*) OVER (PARTITION BY subject_id) AS n FROM {source})
        JOIN (VALUES (1), (2), (3)) t(k) ON n >= k WHERE rn = 1"""


def known_infections(spark, sf):
    cdm = clinical(spark, sf)
    return post.infections(acute_cohorts(cdm), cdm.observation_period, cdm.death, RULES)


def infected(cdm):
    return acute_cohorts(cdm).filter("cohort_definition_id = 1")


@query(
    "j14_intersect_days",
    with_tables(
        """SELECT i.*, days_since_previous, days_since_influenza FROM infection i
           JOIN i_previous USING (subject_id, cohort_start_date) JOIN i_flu USING (subject_id, cohort_start_date)""",
        POST,
    ),
)
def days_between(spark, sf):
    cdm = clinical(spark, sf)
    rows = infected(cdm)
    flu = acute_cohorts(cdm).filter("cohort_definition_id = 2")
    known = intersect_days(rows, rows, None, -1, "last", "days_since_previous")
    return intersect_days(known, flu, -90, -1, "last", "days_since_influenza")


@query(
    "j15_intersect_date",
    with_tables("SELECT i.*, next_date FROM infection i JOIN i_next USING (subject_id, cohort_start_date)", POST),
)
def next_date(spark, sf):
    rows = infected(clinical(spark, sf))
    return intersect_date(rows, rows, 1, 365, "first", "next_date")


@query(
    "j16_intersect_flag",
    with_tables(
        """SELECT s.*, CAST(EXISTS (SELECT 1 FROM ailment b WHERE b.subject_id = s.subject_id
                    AND b.cohort_definition_id = s.cohort_definition_id AND b.cohort_start_date <= s.cohort_start_date - 1
                    AND b.cohort_end_date >= s.cohort_start_date - 180) AS INT) AS meets,
                  CAST(EXISTS (SELECT 1 FROM ailment b WHERE b.subject_id = s.subject_id
                    AND b.cohort_definition_id = s.cohort_definition_id
                    AND b.cohort_start_date BETWEEN s.cohort_start_date - 180 AND s.cohort_start_date - 1) AS INT) AS starts
           FROM symptom s"""
    ),
)
def flag(spark, sf):
    cdm = clinical(spark, sf)
    keys = ["cohort_definition_id", "subject_id"]
    rows, target = symptom_cohorts(cdm), condition_cohorts(cdm)
    met = intersect_flag(rows, target, keys, -180, -1, "meets")
    return intersect_flag(met, target, keys, -180, -1, "starts", overlap=False)


@query("j18_outcome_after_index", with_tables("SELECT * FROM symptom_after", POST))
def after_index(spark, sf):
    kept = post.kept_infections(known_infections(spark, sf), RULES)
    return outcome_after_index(kept, symptom_cohorts(clinical(spark, sf)))


@query(
    "j21_right_join_zero_fill",
    with_tables(
        """SELECT o.cohort_definition_id, count(d.subject_id) AS number_records, count(DISTINCT d.subject_id) AS number_subjects
           FROM (SELECT DISTINCT cohort_definition_id FROM outcome) o
           LEFT JOIN acute d ON d.cohort_definition_id = o.cohort_definition_id GROUP BY 1"""
    ),
)
def zero_fill(spark, sf):
    cdm = clinical(spark, sf)
    return counts_with_zero(acute_cohorts(cdm), outcome_cohorts(cdm).select("cohort_definition_id").distinct())


@query(
    "a1_cohort_counts",
    with_tables(
        """SELECT cohort_definition_id, count(*) AS number_records, count(DISTINCT subject_id) AS number_subjects
           FROM denom GROUP BY 1"""
    ),
)
def counts(spark, sf):
    from workload.incidence_queries import strata

    return cohort_counts(strata(spark, sf))


@query(
    "a19_final_counts",
    with_tables(
        """SELECT cohort_definition_id, CASE WHEN r BETWEEN 1 AND 4 THEN NULL ELSE r END AS number_records,
                  CASE WHEN s BETWEEN 1 AND 4 THEN NULL ELSE s END AS number_subjects
           FROM (SELECT cohort_definition_id, count(*) AS r, count(DISTINCT subject_id) AS s
                 FROM (SELECT c_nationkey AS cohort_definition_id, c_custkey AS subject_id FROM customer WHERE c_acctbal < 0) GROUP BY 1)"""
    ),
)
def final_counts(spark, sf):
    death = clinical(spark, sf).death.select(
        F.col("cause_concept_id").cast("int").alias("cohort_definition_id"), F.col("person_id").alias("subject_id")
    )
    return suppress_small(cohort_counts(death), ["number_records", "number_subjects"], 5)


@query("a20_symptom_counts", with_tables("SELECT count(DISTINCT cohort_definition_id) AS n_cohorts FROM symptom"))
def n_symptoms(spark, sf):
    return symptom_counts(symptom_cohorts(clinical(spark, sf)))


@query(
    "a21_attrition",
    with_tables(
        """SELECT reason_id, reason, number_records, number_subjects,
                  coalesce(lag(number_records) OVER (ORDER BY reason_id) - number_records, 0) AS excluded_records,
                  coalesce(lag(number_subjects) OVER (ORDER BY reason_id) - number_subjects, 0) AS excluded_subjects
           FROM (SELECT reason_id, reason, count(s.subject_id) AS number_records, count(DISTINCT s.subject_id) AS number_subjects
                 FROM (VALUES (1, 'Initial events'), (2, 'Event washout'), (3, 'In observation at cohort entry'),
                              (4, '365 days of prior history'), (5, 'Historical influenza'), (6, 'Entry in the study window'),
                              (7, '>=120 days of follow-up')) r(reason_id, reason)
                 LEFT JOIN step s ON s.passed >= reason_id - 1 GROUP BY 1, 2)""",
        POST,
    ),
)
def attrition_steps(spark, sf):
    return post.entry_attrition(known_infections(spark, sf), RULES)


@query(
    "a22_censoring_reasons",
    with_tables(
        """SELECT CASE WHEN follow_up_end = death_date THEN 'death'
                       WHEN follow_up_end = op_end_date THEN 'end of data collection or exit from database'
                       WHEN follow_up_end = next_date THEN 'next covid infection' END AS reason_censoring, count(*) AS n
           FROM step WHERE passed = 5 GROUP BY 1""",
        POST,
    ),
)
def reasons(spark, sf):
    return post.censoring_reasons(known_infections(spark, sf), RULES)


@query(
    "a23_person_count_period_summary",
    with_tables(
        """SELECT (SELECT count(*) FROM person) AS person_count, count(*) AS op_count, min(op_start_date) AS op_start_date,
                  max(op_end_date) AS op_end_date FROM op"""
    ),
)
def summary(spark, sf):
    cdm = clinical(spark, sf)
    both = bind_rows([person_count(cdm.person), period_summary(cdm.observation_period)])
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


@query(
    "a25_outcome_at_risk_window",
    with_tables(
        """SELECT subject_id, cohort_start_date, time_at_risk, outcome_count FROM (
             SELECT t.subject_id, t.cohort_start_date,
                    CAST(least(t.cohort_start_date + 730, op_end_date) - t.cohort_start_date AS INT) AS time_at_risk,
                    count(*) FILTER (o.cohort_start_date BETWEEN t.cohort_start_date AND least(t.cohort_start_date + 730, op_end_date)) AS outcome_count,
                    count(*) FILTER (o.cohort_start_date < t.cohort_start_date) AS before
             FROM (SELECT subject_id, min(cohort_start_date) AS cohort_start_date FROM infection GROUP BY 1) t
             JOIN op ON op.person_id = t.subject_id AND t.cohort_start_date BETWEEN op_start_date AND op_end_date
             LEFT JOIN symptom o ON o.subject_id = t.subject_id AND o.cohort_definition_id = 1
             GROUP BY 1, 2, 3, op_end_date)
           WHERE before = 0 AND (time_at_risk >= 729 OR outcome_count > 0)""",
        POST,
    ),
)
def at_risk_window(spark, sf):
    cdm = clinical(spark, sf)
    return outcome_at_risk(
        infected(cdm), symptom_cohorts(cdm).filter("cohort_definition_id = 1"), cdm.observation_period
    )


@query("w12_k_of_n", with_tables(k_of_n_sql("symptom_after", 0), POST))
def k_of_n(spark, sf):
    kept = post.kept_infections(known_infections(spark, sf), RULES)
    after = outcome_after_index(kept, symptom_cohorts(clinical(spark, sf)))
    return k_of_n_levels(after, {1: 1, 2: 2, 3: 3})


@query("w13_censor_followup", with_tables("SELECT * FROM kept", POST))
def followup(spark, sf):
    return post.kept_infections(known_infections(spark, sf), RULES)


@query(
    "w14_event_washout",
    with_tables(
        """SELECT i.* FROM infection i JOIN i_previous USING (subject_id, cohort_start_date)
           WHERE days_since_previous IS NULL OR days_since_previous < -42""",
        POST,
    ),
)
def washout(spark, sf):
    rows = infected(clinical(spark, sf))
    return event_washout(rows, rows, 42)


SAMPLED = """SELECT * FROM outcome ORDER BY
    ((subject_id * month(cohort_start_date)) % 123) * ((year(cohort_start_date) * day(cohort_start_date)) % 123),
    subject_id, cohort_start_date, cohort_end_date, cohort_definition_id LIMIT 500"""


@query("w15_sample_n", with_tables(
    f"SELECT subject_id, cohort_start_date, cohort_end_date FROM ({SAMPLED})"))
def sample(spark, sf):
    rows = sample_n(outcome_cohorts(clinical(spark, sf)), 500)
    return rows.select("subject_id", "cohort_start_date", "cohort_end_date")


@query(
    "w16_first_only",
    with_tables(
        """SELECT subject_id, cohort_definition_id, min(cohort_start_date) AS cohort_start_date, min(cohort_end_date) AS cohort_end_date
           FROM outcome GROUP BY 1, 2"""
    ),
)
def first(spark, sf):
    return first_only(outcome_cohorts(clinical(spark, sf)))


@query(
    "w17_population_features",
    with_tables(
        f"""SELECT row_number() OVER (ORDER BY subject_id, cohort_start_date, cohort_end_date, cohort_definition_id) AS row_id, subject_id,
                  cohort_definition_id, cohort_start_date, cohort_end_date,
                  CAST(cohort_start_date - op_start_date AS INT) AS days_from_obs_start,
                  CAST(least(cohort_end_date, DATE '{LATEST}') - cohort_start_date AS INT) AS days_to_cohort_end,
                  CAST(least(op_end_date, DATE '{LATEST}') - cohort_start_date AS INT) AS days_to_obs_end,
                  CAST(year(cohort_start_date) - year_of_birth AS INT) AS age_year, gender_concept_id AS gender
           FROM (SELECT subject_id, cohort_definition_id, min(cohort_start_date) AS cohort_start_date,
                        min(cohort_end_date) AS cohort_end_date FROM acute GROUP BY 1, 2)
           JOIN op ON op.person_id = subject_id AND cohort_start_date BETWEEN op_start_date AND op_end_date
           JOIN person p ON p.person_id = subject_id
           WHERE cohort_start_date >= DATE '{START}' AND cohort_start_date < DATE '{LATEST}'
             AND cohort_start_date - op_start_date >= 30"""
    ),
)
def features(spark, sf):
    cdm = clinical(spark, sf)
    return population_features(acute_cohorts(cdm), cdm, START, LATEST, first=True, washout=30)


@query(
    "w18_observation_as_cohort",
    with_tables(
        f"""SELECT CAST(0 AS BIGINT) AS cohort_definition_id, person_id AS subject_id,
                  greatest(op_start_date, DATE '{START}') AS cohort_start_date, least(op_end_date, DATE '{LATEST}') AS cohort_end_date
           FROM op WHERE op_start_date <= DATE '{LATEST}'"""
    ),
)
def as_cohort(spark, sf):
    return observation_as_cohort(clinical(spark, sf).observation_period, 0, START, LATEST)


@query(
    "w19_anchor_start",
    with_tables(
        """SELECT cohort_definition_id, subject_id, greatest(cohort_start_date, DATE '1997-01-01') AS cohort_start_date,
                  cohort_end_date FROM outcome"""
    ),
)
def anchored(spark, sf):
    return anchor_start(outcome_cohorts(clinical(spark, sf)), date(1997, 1, 1))


@query(
    "t1_t2_t3_sorted_rows",
    with_tables("SELECT * FROM outcome ORDER BY cohort_definition_id, subject_id, cohort_start_date"),
)
def ordered(spark, sf):
    return outcome_cohorts(clinical(spark, sf)).orderBy("cohort_definition_id", "subject_id", "cohort_start_date")


@query(
    "t4_top_one_per_person",
    with_tables(
        """SELECT person_id, event_id, start_date FROM (
             SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY start_date DESC, event_id DESC) AS n FROM e_visit) WHERE n = 1"""
    ),
)
def latest_visit(spark, sf):
    visits = domain_events(clinical(spark, sf), "visit").withColumns(
        {"_day": -F.unix_date("start_date"), "_id": -F.col("event_id")}
    )
    return first_rows(visits, ["person_id"], ["_day", "_id"]).select("person_id", "event_id", "start_date")


@query(
    "u1_u5_u6_set_operations",
    with_tables(
        """(SELECT DISTINCT subject_id, cohort_start_date FROM acute UNION SELECT subject_id, cohort_start_date FROM symptom)
           EXCEPT SELECT subject_id, cohort_start_date FROM ailment WHERE cohort_definition_id = 1"""
    ),
)
def set_operations(spark, sf):
    cdm = clinical(spark, sf)
    columns = ["subject_id", "cohort_start_date"]
    some = acute_cohorts(cdm).select(*columns).union(symptom_cohorts(cdm).select(*columns)).distinct()
    return some.join(condition_cohorts(cdm).filter("cohort_definition_id = 1"), columns, "left_anti")


@query(
    "u3_overlap_cohorts",
    with_tables(
        f"{k_of_n_sql('symptom_after', 0)} UNION ALL {k_of_n_sql('ailment_after', 3)}", POST
    ),
)
def overlap(spark, sf):
    cdm = clinical(spark, sf)
    kept = post.kept_infections(known_infections(spark, sf), RULES)
    return post.overlap_cohorts(kept, symptom_cohorts(cdm), condition_cohorts(cdm))


@query(
    "u3_final_counts",
    with_tables(
        """SELECT cohort_table, CAST(id AS BIGINT) AS cohort_definition_id, cohort_name,
                  CASE WHEN count(subject_id) BETWEEN 1 AND 4 THEN NULL ELSE count(subject_id) END AS number_records,
                  CASE WHEN count(DISTINCT subject_id) BETWEEN 1 AND 4 THEN NULL ELSE count(DISTINCT subject_id) END AS number_subjects
           FROM cohort_names n LEFT JOIN (
               SELECT 'acute_cohorts' AS t, cohort_definition_id, subject_id FROM acute
               UNION ALL SELECT 'overlap_cohorts', cohort_definition_id, subject_id FROM overlap_rows) c
             ON c.t = n.cohort_table AND c.cohort_definition_id = n.id GROUP BY 1, 2, 3""",
        {
            **POST,
            "overlap_rows": f"{k_of_n_sql('symptom_after', 0)} UNION ALL {k_of_n_sql('ailment_after', 3)}",
            "cohort_names": "SELECT * FROM (VALUES "
            + ", ".join(f"('overlap_cohorts', {i}, '{n}')" for i, n in post.COHORT_NAMES.items())
            + ", ('acute_cohorts', 1, 'infection'), ('acute_cohorts', 2, 'influenza'), ('acute_cohorts', 99, 'nobody')) v(cohort_table, id, cohort_name)",
        },
    ),
)
def final_counts(spark, sf):
    """The end of the infection study: named cohorts of all tables with their numbers, small ones hidden."""
    cdm = clinical(spark, sf)
    kept = post.kept_infections(known_infections(spark, sf), RULES)
    tables = {"acute_cohorts": acute_cohorts(cdm), "overlap_cohorts": post.overlap_cohorts(kept, symptom_cohorts(cdm), condition_cohorts(cdm))}
    names = {"acute_cohorts": {1: "infection", 2: "influenza", 99: "nobody"}, "overlap_cohorts": post.COHORT_NAMES}
    return post.final_counts(tables, names, 5)


@query(
    "u4_bind_rows",
    with_tables(
        """SELECT cohort_definition_id, count(*) AS number_records, CAST(NULL AS DATE) AS last_start FROM acute GROUP BY 1
           UNION ALL SELECT cohort_definition_id, NULL, max(cohort_start_date) FROM symptom GROUP BY 1"""
    ),
)
def bind(spark, sf):
    cdm = clinical(spark, sf)
    a = acute_cohorts(cdm).groupBy("cohort_definition_id").agg(F.count(F.lit(1)).alias("number_records"))
    b = symptom_cohorts(cdm).groupBy("cohort_definition_id").agg(F.max("cohort_start_date").alias("last_start"))
    return bind_rows([a, b])


@query(
    "u7_shifted_union",
    with_tables(
        """SELECT * FROM acute UNION ALL
           SELECT cohort_definition_id + 5, subject_id, cohort_start_date, cohort_end_date FROM ailment"""
    ),
)
def shifted(spark, sf):
    cdm = clinical(spark, sf)
    return shifted_union(acute_cohorts(cdm), condition_cohorts(cdm), 5)
