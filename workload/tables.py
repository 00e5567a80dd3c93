"""The test tables seen as a clinical database, in Spark and in SQL.

Customers are persons, orders conditions and visits, order lines procedures,
drugs, measurements and observations, parts concepts. Concept ids of different
kinds live in ranges of their own.
"""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epiloom.operators.codesets import ConceptSet
from epiloom.session import tuned
from epiloom.sources.tables import Cdm, load_table

BRAND = 10**12
SIZE = 2 * 10**12
STATUS = 3 * 10**12
PRIORITY = 4 * 10**12

START = date(1996, 1, 1)
LATEST = date(2001, 8, 1)

# Codesets 0-2 are on parts, 10-14 on order priorities, 20 on order status.
SETS = [
    ConceptSet(0, concepts=(1, 2, 3), descendants_of=(BRAND + 3, BRAND + 4)),
    ConceptSet(1, descendants_of=(BRAND + 7,), excluded_descendants_of=(SIZE + 10,)),
    ConceptSet(2, concepts=(BRAND + 9,), descendants_of=(BRAND + 9, SIZE + 20), excluded=(9, 19, 29)),
    *[ConceptSet(10 + i, concepts=(PRIORITY + 1 + i,)) for i in range(5)],
    ConceptSet(20, concepts=(STATUS + 1, STATUS + 2)),
]


_PLANS: dict[tuple[str, str], Cdm] = {}


def clinical(spark: SparkSession, sf_dir: str) -> Cdm:
    """The unexecuted tables for a folder, described once per application."""
    tuned(spark)
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _PLANS:
        _PLANS[key] = _clinical(spark, sf_dir)
    return _PLANS[key]


def _clinical(spark: SparkSession, sf_dir: str) -> Cdm:
    customer = load_table(spark, sf_dir, "customer")
    orders = load_table(spark, sf_dir, "orders").withColumn("day", F.col("o_orderdate").cast("date"))
    lineitem = load_table(spark, sf_dir, "lineitem")
    part = load_table(spark, sf_dir, "part")
    key = F.col("c_custkey")
    person = customer.select(
        key.alias("person_id"),
        F.when(key % 2 == 0, 8507).otherwise(8532).alias("gender_concept_id"),
        (key % 80 + 1920).cast("int").alias("year_of_birth"),
        (key % 13).cast("int").alias("month_of_birth"),
        (key % 29).cast("int").alias("day_of_birth"),
    )
    span = orders.groupBy(F.col("o_custkey").alias("person_id")).agg(F.min("day").alias("a"), F.max("day").alias("b"))
    observation_period = span.select(
        F.col("person_id").alias("observation_period_id"),
        "person_id",
        F.col("a").alias("observation_period_start_date"),
        F.col("b").alias("observation_period_end_date"),
        F.lit(32817).alias("period_type_concept_id"),
    )
    priority = F.substring("o_orderpriority", 1, 1).cast("long") + PRIORITY
    status = F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "P", 2).otherwise(3) + F.lit(STATUS)
    condition = orders.select(
        F.col("o_orderkey").alias("condition_occurrence_id"),
        F.col("o_custkey").alias("person_id"),
        priority.alias("condition_concept_id"),
        F.col("day").alias("condition_start_date"),
        F.when(F.col("o_orderkey") % 3 != 0, F.date_add("day", 7)).alias("condition_end_date"),
        F.col("o_orderkey").alias("visit_occurrence_id"),
    )
    line = lineitem.join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("o_custkey").alias("person_id"),
        F.col("l_shipdate").cast("date").alias("day"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_orderkey").alias("visit_occurrence_id"),
        "l_partkey",
        "l_suppkey",
        F.col("l_linenumber").cast("long").alias("l_linenumber"),
    )

    def dated(prefix: str, concept: str) -> DataFrame:
        return line.select(
            F.col("id").alias(f"{prefix}_id"), "person_id", F.col(concept).alias(f"{prefix.split('_')[0]}_concept_id"),
            F.col("day").alias(f"{prefix.split('_')[0]}_date"), "visit_occurrence_id",
        )

    later = F.expr("date_add(day, quantity)")
    drug_exposure = line.select(
        F.col("id").alias("drug_exposure_id"), "person_id", F.col("l_partkey").alias("drug_concept_id"),
        F.col("day").alias("drug_exposure_start_date"),
        F.when(F.col("l_linenumber") != 1, later).alias("drug_exposure_end_date"), "visit_occurrence_id",
    )
    drug_era = line.select(
        F.col("id").alias("drug_era_id"), "person_id", F.col("l_partkey").alias("drug_concept_id"),
        F.col("day").alias("drug_era_start_date"), later.alias("drug_era_end_date"),
    )
    shipped = lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max(F.col("l_shipdate").cast("date")).alias("last")
    )
    visit = orders.join(shipped, "o_orderkey", "left").select(
        F.col("o_orderkey").alias("visit_occurrence_id"),
        F.col("o_custkey").alias("person_id"),
        status.alias("visit_concept_id"),
        F.col("day").alias("visit_start_date"),
        F.greatest("day", "last").alias("visit_end_date"),
    )
    death = (
        orders.join(customer.filter("c_acctbal < 0"), F.col("o_custkey") == key)
        .groupBy(F.col("o_custkey").alias("person_id"), F.col("c_nationkey").cast("long").alias("cause_concept_id"))
        .agg(F.max("day").alias("death_date"))
    )
    brand = F.regexp_extract("p_brand", r"(\d+)$", 1).cast("long") + BRAND
    size = F.col("p_size").cast("long") + SIZE
    valid = F.lit(None).cast("string").alias("invalid_reason")
    concept = part.select(
        F.col("p_partkey").alias("concept_id"), F.when(F.col("p_size") == 50, "D").alias("invalid_reason")
    )
    groups = part.select(F.explode(F.array(brand, size)).alias("concept_id"))
    kinds = orders.select(F.explode(F.array(priority, status)).alias("concept_id"))
    for rows in (groups, kinds):
        concept = concept.union(rows.distinct().select("concept_id", valid))
    to = F.col("p_partkey").alias("descendant_concept_id")
    concept_ancestor = (
        part.select(brand.alias("ancestor_concept_id"), to)
        .union(part.select(size.alias("ancestor_concept_id"), to))
        .union(part.select(F.col("p_partkey").alias("ancestor_concept_id"), to))
    )
    return Cdm(
        {
            "person": person,
            "observation_period": observation_period,
            "condition_occurrence": condition,
            "procedure_occurrence": dated("procedure_occurrence", "l_partkey"),
            "measurement": dated("measurement", "l_suppkey"),
            "observation": dated("observation", "l_linenumber"),
            "drug_exposure": drug_exposure,
            "drug_era": drug_era,
            "visit_occurrence": visit,
            "death": death,
            "concept": concept,
            "concept_ancestor": concept_ancestor,
        }
    )


def outcome_cohorts(cdm: Cdm) -> DataFrame:
    """Every order as a cohort row of its priority (1 to 5)."""
    start = F.col("condition_start_date")
    return cdm.condition_occurrence.select(
        (F.col("condition_concept_id") - PRIORITY).alias("cohort_definition_id"),
        F.col("person_id").alias("subject_id"),
        start.alias("cohort_start_date"),
        F.coalesce("condition_end_date", F.date_add(start, 1)).alias("cohort_end_date"),
    )


def acute_cohorts(cdm: Cdm) -> DataFrame:
    """Priorities 1 and 2: the infection and influenza of the follow-up study."""
    return outcome_cohorts(cdm).filter("cohort_definition_id <= 2")


def symptom_cohorts(cdm: Cdm) -> DataFrame:
    """Priorities 3 to 5 as symptom cohorts 1 to 3."""
    rows = outcome_cohorts(cdm).filter("cohort_definition_id > 2")
    return rows.withColumn("cohort_definition_id", F.col("cohort_definition_id") - 2)


def condition_cohorts(cdm: Cdm) -> DataFrame:
    """Order status as condition cohorts 1 to 3, lasting as long as the visit."""
    return cdm.visit_occurrence.select(
        (F.col("visit_concept_id") - STATUS).alias("cohort_definition_id"),
        F.col("person_id").alias("subject_id"),
        F.col("visit_start_date").alias("cohort_start_date"),
        F.col("visit_end_date").alias("cohort_end_date"),
    )


def _expansion(s: ConceptSet) -> str:
    def union(concepts: tuple[int, ...], above: tuple[int, ...]) -> str:
        sides = []
        if concepts:
            sides.append(f"SELECT concept_id FROM concept WHERE concept_id IN ({', '.join(map(str, concepts))})")
        if above:
            sides.append(
                "SELECT c.concept_id FROM concept c JOIN concept_ancestor a ON a.descendant_concept_id = c.concept_id "
                f"WHERE a.ancestor_concept_id IN ({', '.join(map(str, above))}) AND c.invalid_reason IS NULL"
            )
        return " UNION ".join(sides)

    inner = union(s.concepts, s.descendants_of)
    if s.excluded or s.excluded_descendants_of:
        inner = f"({inner}) EXCEPT ({union(s.excluded, s.excluded_descendants_of)})"
    return f"SELECT {s.codeset_id} AS codeset_id, concept_id FROM ({inner})"


# The same tables in SQL, each by name; `with_tables` adds those a query names.
SQL: dict[str, str] = {
    "person": """
        SELECT c_custkey AS person_id, CASE WHEN c_custkey % 2 = 0 THEN 8507 ELSE 8532 END AS gender_concept_id,
               CAST(1920 + c_custkey % 80 AS INT) AS year_of_birth, CAST(c_custkey % 13 AS INT) AS month_of_birth,
               CAST(c_custkey % 29 AS INT) AS day_of_birth
        FROM customer""",
    "observation_period": """
        SELECT o_custkey AS observation_period_id, o_custkey AS person_id,
               CAST(min(o_orderdate) AS DATE) AS observation_period_start_date,
               CAST(max(o_orderdate) AS DATE) AS observation_period_end_date, 32817 AS period_type_concept_id
        FROM orders GROUP BY o_custkey""",
    "condition_occurrence": f"""
        SELECT o_orderkey AS condition_occurrence_id, o_custkey AS person_id,
               {PRIORITY} + CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS condition_concept_id,
               CAST(o_orderdate AS DATE) AS condition_start_date,
               CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderdate AS DATE) + 7 END AS condition_end_date,
               o_orderkey AS visit_occurrence_id
        FROM orders""",
    "line": """
        SELECT l_orderkey * 10 + l_linenumber AS id, o_custkey AS person_id, CAST(l_shipdate AS DATE) AS day,
               CAST(l_quantity AS INT) AS quantity, l_orderkey AS visit_occurrence_id, l_partkey, l_suppkey,
               CAST(l_linenumber AS BIGINT) AS l_linenumber
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "visit_occurrence": f"""
        SELECT o_orderkey AS visit_occurrence_id, o_custkey AS person_id,
               {STATUS} + CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'P' THEN 2 ELSE 3 END AS visit_concept_id,
               CAST(o_orderdate AS DATE) AS visit_start_date,
               greatest(CAST(o_orderdate AS DATE), coalesce(last, CAST(o_orderdate AS DATE))) AS visit_end_date
        FROM orders LEFT JOIN (SELECT l_orderkey, CAST(max(l_shipdate) AS DATE) AS last FROM lineitem GROUP BY 1)
          ON l_orderkey = o_orderkey""",
    "death": """
        SELECT o_custkey AS person_id, CAST(c_nationkey AS BIGINT) AS cause_concept_id,
               CAST(max(o_orderdate) AS DATE) AS death_date
        FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal < 0 GROUP BY 1, 2""",
    "concept": f"""
        SELECT p_partkey AS concept_id, CASE WHEN p_size = 50 THEN 'D' END AS invalid_reason FROM part
        UNION ALL SELECT DISTINCT {BRAND} + CAST(regexp_extract(p_brand, '(\\d+)$', 1) AS BIGINT), NULL FROM part
        UNION ALL SELECT DISTINCT {SIZE} + CAST(p_size AS BIGINT), NULL FROM part
        UNION ALL SELECT DISTINCT condition_concept_id, NULL FROM condition_occurrence
        UNION ALL SELECT DISTINCT visit_concept_id, NULL FROM visit_occurrence""",
    "concept_ancestor": f"""
        SELECT {BRAND} + CAST(regexp_extract(p_brand, '(\\d+)$', 1) AS BIGINT) AS ancestor_concept_id,
               p_partkey AS descendant_concept_id FROM part
        UNION ALL SELECT {SIZE} + CAST(p_size AS BIGINT), p_partkey FROM part
        UNION ALL SELECT p_partkey, p_partkey FROM part""",
    "codesets": " UNION ALL ".join(_expansion(s) for s in SETS),
    "e_condition": """
        SELECT person_id, condition_occurrence_id AS event_id, condition_start_date AS start_date,
               coalesce(condition_end_date, condition_start_date + 1) AS end_date,
               condition_concept_id AS target_concept_id, visit_occurrence_id
        FROM condition_occurrence""",
    "e_procedure": """
        SELECT person_id, id AS event_id, day AS start_date, day + 1 AS end_date,
               l_partkey AS target_concept_id, visit_occurrence_id FROM line""",
    "e_measurement": """
        SELECT person_id, id AS event_id, day AS start_date, day + 1 AS end_date,
               l_suppkey AS target_concept_id, visit_occurrence_id FROM line""",
    "e_observation": """
        SELECT person_id, id AS event_id, day AS start_date, day + 1 AS end_date,
               l_linenumber AS target_concept_id, visit_occurrence_id FROM line""",
    "e_drug": """
        SELECT person_id, id AS event_id, day AS start_date,
               CASE WHEN l_linenumber = 1 THEN day + 1 ELSE day + quantity END AS end_date,
               l_partkey AS target_concept_id, visit_occurrence_id FROM line""",
    "e_drug_era": """
        SELECT person_id, id AS event_id, day AS start_date, day + quantity AS end_date,
               l_partkey AS target_concept_id, CAST(NULL AS BIGINT) AS visit_occurrence_id FROM line""",
    "e_visit": """
        SELECT person_id, visit_occurrence_id AS event_id, visit_start_date AS start_date, visit_end_date AS end_date,
               visit_concept_id AS target_concept_id, visit_occurrence_id FROM visit_occurrence""",
    "e_death": """
        SELECT person_id, person_id AS event_id, death_date AS start_date, death_date + 1 AS end_date,
               cause_concept_id AS target_concept_id, CAST(NULL AS BIGINT) AS visit_occurrence_id FROM death""",
    "e_observation_period": """
        SELECT person_id, observation_period_id AS event_id, observation_period_start_date AS start_date,
               observation_period_end_date AS end_date, CAST(period_type_concept_id AS BIGINT) AS target_concept_id,
               CAST(NULL AS BIGINT) AS visit_occurrence_id FROM observation_period""",
    "op": """
        SELECT person_id, observation_period_start_date AS op_start_date, observation_period_end_date AS op_end_date
        FROM observation_period""",
    "urgent": """
        SELECT e.* FROM e_condition e JOIN codesets c ON c.concept_id = e.target_concept_id AND c.codeset_id = 10""",
    "indexed": """
        SELECT e.*, op_start_date, op_end_date FROM urgent e JOIN op ON op.person_id = e.person_id
        WHERE e.start_date BETWEEN op_start_date AND op_end_date""",
    "outcome": f"""
        SELECT condition_concept_id - {PRIORITY} AS cohort_definition_id, person_id AS subject_id,
               condition_start_date AS cohort_start_date,
               coalesce(condition_end_date, condition_start_date + 1) AS cohort_end_date
        FROM condition_occurrence""",
    "acute": "SELECT * FROM outcome WHERE cohort_definition_id <= 2",
    "symptom": """
        SELECT cohort_definition_id - 2 AS cohort_definition_id, subject_id, cohort_start_date, cohort_end_date
        FROM outcome WHERE cohort_definition_id > 2""",
    "ailment": f"""
        SELECT visit_concept_id - {STATUS} AS cohort_definition_id, person_id AS subject_id,
               visit_start_date AS cohort_start_date, visit_end_date AS cohort_end_date
        FROM visit_occurrence""",
    "risk": f"""
        SELECT DISTINCT p.person_id, gender_concept_id,
               make_date(year_of_birth, coalesce(nullif(month_of_birth, 0), 1), coalesce(nullif(day_of_birth, 0), 1)) AS dob,
               greatest(op_start_date + 365, DATE '{START}') AS risk_start_date,
               least(op_end_date, DATE '{LATEST}') AS risk_end_date
        FROM person p JOIN op ON op.person_id = p.person_id
        WHERE op_end_date >= DATE '{START}' AND op_start_date <= DATE '{LATEST}'
          AND greatest(op_start_date + 365, DATE '{START}') <= least(op_end_date, DATE '{LATEST}')""",
    "bands": "SELECT * FROM (VALUES (0, 0, 18), (1, 19, 39), (2, 40, 65), (3, 66, 150), (4, 0, 150)) t(b, low, high)",
    "sexes": "SELECT * FROM (VALUES (1, 8507), (2, 8532), (3, 8507), (3, 8532)) t(s, gender)",
    "denom": """
        SELECT CAST(b * 3 + s AS BIGINT) AS cohort_definition_id, person_id AS subject_id, cohort_start_date, cohort_end_date
        FROM (
          SELECT b, s, person_id,
                 CASE WHEN b = 4 THEN risk_start_date
                      ELSE greatest(CAST(dob + to_months(CAST(12 * low AS INT)) AS DATE), risk_start_date) END AS cohort_start_date,
                 least(CAST(dob + to_months(CAST(12 * (high + 1) AS INT)) AS DATE) - 1, risk_end_date) AS cohort_end_date
          FROM risk JOIN sexes ON gender = gender_concept_id CROSS JOIN bands)
        WHERE cohort_start_date <= cohort_end_date""",
    "first_event": """
        SELECT cohort_definition_id AS outcome_id, subject_id, min(cohort_start_date) AS first_event_date
        FROM outcome GROUP BY 1, 2""",
    "paired": """
        SELECT o.outcome_id, d.subject_id, d.cohort_definition_id AS denom_id, cohort_start_date, cohort_end_date, first_event_date
        FROM denom d CROSS JOIN (SELECT DISTINCT cohort_definition_id AS outcome_id FROM outcome) o
        LEFT JOIN first_event f ON f.subject_id = d.subject_id AND f.outcome_id = o.outcome_id""",
    "atrisk": """
        SELECT *, CASE WHEN first_event_date BETWEEN cohort_start_date AND cohort_end_date THEN first_event_date
                       ELSE cohort_end_date END AS at_risk_end_date
        FROM paired WHERE first_event_date IS NULL OR first_event_date >= cohort_start_date""",
    "months": f"""
        SELECT CAST(m AS DATE) AS month_start, last_day(CAST(m AS DATE)) AS month_end
        FROM range(TIMESTAMP '1990-01-01', TIMESTAMP '2003-01-01', INTERVAL 1 MONTH) t(m)""",
    "slices": """
        SELECT a.*, month_start, greatest(cohort_start_date, month_start) AS start_in_month,
               least(at_risk_end_date, month_end) AS end_in_month
        FROM atrisk a JOIN months ON cohort_start_date <= month_end AND at_risk_end_date >= month_start""",
    "at_risk_sum": """
        SELECT denom_id, outcome_id, CAST(year(month_start) AS INT) AS cal_year, CAST(month(month_start) AS INT) AS cal_month,
               count(DISTINCT subject_id) AS denom_count,
               CAST(sum(end_in_month - start_in_month + 1) AS BIGINT) AS person_days
        FROM slices GROUP BY 1, 2, 3, 4""",
    "event_sum": """
        SELECT denom_id, outcome_id, CAST(year(first_event_date) AS INT) AS cal_year,
               CAST(month(first_event_date) AS INT) AS cal_month, count(*) AS outcome_count
        FROM paired WHERE first_event_date BETWEEN cohort_start_date AND cohort_end_date GROUP BY 1, 2, 3, 4""",
    "monthly": """
        SELECT d.denom_id, d.outcome_id, d.cal_year, d.cal_month, coalesce(outcome_count, 0) AS outcome_count,
               denom_count, person_days, person_days / 365.25 AS person_years,
               coalesce(outcome_count, 0) / (person_days / 365.25) * 100000 AS incidence_100000_pys
        FROM at_risk_sum d LEFT JOIN event_sum e USING (denom_id, outcome_id, cal_year, cal_month)""",
    "entries": """
        SELECT c.cohort_definition_id, c.subject_id, c.cohort_start_date, c.cohort_end_date,
               CAST(c.cohort_end_date - c.cohort_start_date + 1 AS INT) AS days_in_cohort,
               CAST(year(c.cohort_start_date) - year_of_birth AS INT) AS age_years,
               CASE gender_concept_id WHEN 8532 THEN 'Female' WHEN 8507 THEN 'Male' ELSE 'Other/Unknown' END AS sex,
               CAST(c.cohort_start_date - op_start_date AS INT) AS prior_observation,
               CAST(op_end_date - c.cohort_start_date AS INT) AS future_observation
        FROM outcome c JOIN person p ON p.person_id = c.subject_id
        LEFT JOIN op ON op.person_id = c.subject_id AND c.cohort_start_date BETWEEN op_start_date AND op_end_date""",
}


def with_tables(body: str, extra: dict[str, str] | None = None, recursive: bool = False) -> str:
    """The query with the tables above that it names, directly or not."""
    known = {**SQL, **(extra or {})}
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in known:
            if name not in needed and re.search(rf"\b{name}\b", text) and known[name] is not text:
                visit(known[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    tables = ",\n".join(f"{n} AS ({known[n]})" for n in needed)
    if not tables:
        return body
    return f"WITH {'RECURSIVE ' if recursive else ''}{tables}\n{body}"
