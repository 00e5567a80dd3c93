"""Criteria, limits, inclusion, exits, eras, whole cohorts."""

from dataclasses import replace
from functools import reduce

from pyspark.sql import functions as F

from epiloom.operators.criteria import (
    Comparison,
    Correlated,
    Demographic,
    EventQuery,
    Group,
    Window,
    add_groups,
    filter_group,
    nested,
    query_events,
)
from epiloom.operators.eras import era_collapse, exit_at_observation_end, exit_fixed_offset
from epiloom.operators.events import domain_events, first_rows
from epiloom.operators.inclusion import (
    all_rules_met,
    best_events,
    inclusion_result,
    inclusion_rows,
    inclusion_stats,
    mask_from_rows,
    rule_mask,
    summary_stats,
)
from epiloom.operators.observation import attach_observation
from epiloom.operators.ranges import DayRange, count_in_ranges
from epiloom.plans.cohort_sets import build_cohorts
from epiloom.plans.cohorts import (
    CohortSpec,
    DateOffset,
    STATISTICS,
    build_cohort,
    build_with_statistics,
    limited,
    masked_events,
    primary_events,
    qualified_events,
    same_day_death_cohort,
)
from epiloom.sources.tables import load_table
from workload.event_queries import codesets
from workload.registry import query
from workload.tables import SETS, SQL, clinical, with_tables

URGENT = EventQuery("condition", codeset_id=10)
INSIDE = "a.person_id = i.person_id AND a.start_date BETWEEN i.op_start_date AND i.op_end_date"
ORDER = "start_date, event_id, end_date, target_concept_id, visit_occurrence_id"


def indexed(cdm):
    """All urgent orders inside observation, the index events of most queries."""
    return attach_observation(query_events(cdm, codesets(cdm), URGENT), cdm.observation_period)


def counted(table: str, on: str, name: str = "n", columns: str = "i.person_id, i.event_id, i.start_date") -> str:
    return (
        f"SELECT {columns}, count(a.event_id) AS {name} FROM indexed i LEFT JOIN {table} a ON {on} GROUP BY {columns}"
    )


def by_group(spark, sf, group):
    cdm = clinical(spark, sf)
    return filter_group(cdm, codesets(cdm), indexed(cdm), group).select("person_id", "event_id", "start_date")


TWICE = Correlated(EventQuery("measurement"), "at_least", 2, Window(5, 90))
NO_VISIT = Correlated(EventQuery("visit", codeset_id=20), "exactly", 0, Window(-30, -1))
NO_DRUG_BEFORE = Correlated(EventQuery("drug", codeset_id=0), "exactly", 0, Window(None, -30), ignore_observation=True)
LATER = Correlated(URGENT, "at_least", 1, Window(30, None))
ADULT = Demographic(Comparison("gte", 18))

TWICE_SQL = counted("e_measurement", f"{INSIDE} AND a.start_date BETWEEN i.start_date + 5 AND i.start_date + 90")
VISITS = "SELECT e.* FROM e_visit e JOIN codesets c ON c.concept_id = e.target_concept_id AND c.codeset_id = 20"
DRUGS0 = "SELECT e.* FROM e_drug e JOIN codesets c ON c.concept_id = e.target_concept_id AND c.codeset_id = 0"
EXTRA = {
    "visit20": VISITS,
    "drug0": DRUGS0,
    "n_twice": TWICE_SQL,
    "n_visit": counted("visit20", f"{INSIDE} AND a.start_date BETWEEN i.start_date - 30 AND i.start_date - 1"),
    "n_drug": counted("drug0", "a.person_id = i.person_id AND a.start_date <= i.start_date - 30"),
    "n_later": counted("urgent", f"{INSIDE} AND a.start_date >= i.start_date + 30"),
    "judged": """
        SELECT i.person_id, i.event_id, i.start_date, i.end_date, i.op_start_date, i.op_end_date,
               t.n >= 2 AS twice, v.n = 0 AS no_visit, d.n = 0 AS no_drug, l.n >= 1 AS later,
               year(i.start_date) - year_of_birth >= 18 AS adult
        FROM indexed i JOIN n_twice t USING (event_id) JOIN n_visit v USING (event_id) JOIN n_drug d USING (event_id)
        JOIN n_later l USING (event_id) JOIN person p ON p.person_id = i.person_id""",
}


@query("j5_correlated_at_least", with_tables("SELECT person_id, event_id, start_date FROM n_twice WHERE n >= 2", EXTRA))
def at_least(spark, sf):
    return by_group(spark, sf, Group("ALL", (TWICE,)))


@query("j6_correlated_absent", with_tables("SELECT person_id, event_id, start_date FROM n_visit WHERE n = 0", EXTRA))
def absent(spark, sf):
    return by_group(spark, sf, Group("ALL", (NO_VISIT,)))


@query(
    "j7_window_anchors",
    with_tables(
        """SELECT i.person_id, i.event_id, i.start_date,
                  count(*) FILTER (a.start_date BETWEEN i.op_start_date AND i.op_end_date AND a.start_date >= i.start_date + 30) AS to_period_end,
                  count(*) FILTER (a.start_date BETWEEN i.op_start_date AND i.start_date) AS from_period_start,
                  count(*) FILTER (a.start_date <= i.start_date) AS ever_before,
                  count(*) FILTER (a.start_date BETWEEN i.start_date - 30 AND i.start_date + 30) AS around,
                  count(*) FILTER (a.start_date >= i.end_date) AS after_end
           FROM indexed i LEFT JOIN e_procedure a ON a.person_id = i.person_id GROUP BY 1, 2, 3"""
    ),
)
def anchors(spark, sf):
    cdm = clinical(spark, sf)
    start, end = F.col("start_date"), F.col("end_date")
    events = domain_events(cdm, "procedure")
    ranges = [
        DayRange("to_period_end", events, F.greatest(F.date_add(start, 30), F.col("op_start_date")), F.col("op_end_date")),
        DayRange("from_period_start", events, F.col("op_start_date"), start),
        DayRange("ever_before", events, None, start),
        DayRange("around", events, F.date_add(start, -30), F.date_add(start, 30)),
        DayRange("after_end", events, end, None),
    ]
    rows = count_in_ranges(
        indexed(cdm), ["person_id"], ["start_date", "end_date", "op_start_date", "op_end_date"], ranges
    )
    return rows.select("person_id", "event_id", "start_date", *[r.name for r in ranges])


@query(
    "j8_end_window",
    with_tables(
        """SELECT i.person_id, i.event_id, i.start_date FROM indexed i JOIN visit20 a ON a.person_id = i.person_id
           WHERE a.start_date BETWEEN i.op_start_date AND i.start_date AND a.end_date BETWEEN i.start_date AND i.op_end_date
           GROUP BY 1, 2, 3""",
        EXTRA,
    ),
)
def end_window(spark, sf):
    visit = Correlated(
        EventQuery("visit", codeset_id=20), "at_least", 1, Window(None, 0), end_window=Window(0, None)
    )
    return by_group(spark, sf, Group("ALL", (visit,)))


@query(
    "j8_end_window_general",
    with_tables(
        """SELECT i.person_id, i.event_id, i.start_date,
                  count(a.event_id) FILTER (a.start_date BETWEEN i.start_date - 400 AND i.start_date + 200
                                            AND a.end_date BETWEEN i.start_date + 10 AND i.start_date + 300) AS both_bounded,
                  count(a.event_id) FILTER (a.start_date <= i.start_date AND a.end_date >= i.start_date + 20) AS open_sides,
                  count(a.event_id) FILTER (a.end_date <= i.start_date) AS ended,
                  count(a.event_id) FILTER (a.start_date >= i.start_date AND a.end_date <= i.end_date + 60) AS from_missing_ends
           FROM indexed i LEFT JOIN visit20 a ON a.person_id = i.person_id GROUP BY i.person_id, i.event_id, i.start_date, i.end_date""",
        {**EXTRA, "indexed": "SELECT * REPLACE (CASE WHEN event_id % 2 = 0 THEN end_date END AS end_date) FROM all_indexed", "all_indexed": SQL["indexed"]},
    ),
)
def general_end_window(spark, sf):
    """Ranges of start days and of end days that are independent of each other, also from anchors without an end."""
    cdm = clinical(spark, sf)
    start, end = F.col("start_date"), F.col("end_date")
    events = query_events(cdm, codesets(cdm), EventQuery("visit", codeset_id=20))
    index = indexed(cdm).withColumn("end_date", F.when(F.col("event_id") % 2 == 0, end))
    ranges = [
        DayRange("both_bounded", events, F.date_add(start, -400), F.date_add(start, 200), F.date_add(start, 10), F.date_add(start, 300)),
        DayRange("open_sides", events, None, start, F.date_add(start, 20), None),
        DayRange("ended", events, None, None, None, start),
        DayRange("from_missing_ends", events, start, None, None, F.date_add(end, 60)),
    ]
    rows = count_in_ranges(index, ["person_id"], ["start_date", "end_date"], ranges)
    return rows.select("person_id", "event_id", "start_date", *[r.name for r in ranges])


@query("j9_ignore_observation", with_tables("SELECT person_id, event_id, start_date FROM n_drug WHERE n = 0", EXTRA))
def ignoring(spark, sf):
    return by_group(spark, sf, Group("ALL", (NO_DRUG_BEFORE,)))


NESTED = Group(
    "ALL",
    (TWICE, Correlated(EventQuery("drug", codeset_id=2), "at_least", 1, Window(0, None))),
)
PROCEDURES = {
    "proc": """SELECT e.*, op_start_date, op_end_date FROM e_procedure e
               JOIN codesets c ON c.concept_id = e.target_concept_id AND c.codeset_id = 1
               JOIN op ON op.person_id = e.person_id AND e.start_date BETWEEN op_start_date AND op_end_date""",
    "drug2": "SELECT e.* FROM e_drug e JOIN codesets c ON c.concept_id = e.target_concept_id AND c.codeset_id = 2",
    "proc_met": """
        SELECT DISTINCT m.person_id, m.event_id FROM (
          SELECT i.person_id, i.event_id, i.start_date FROM proc i JOIN e_measurement a
            ON a.person_id = i.person_id AND a.start_date BETWEEN i.op_start_date AND i.op_end_date
           AND a.start_date BETWEEN i.start_date + 5 AND i.start_date + 90
          GROUP BY i.person_id, i.event_id, i.start_date, i.end_date, i.target_concept_id
          HAVING count(DISTINCT (a.event_id, a.target_concept_id)) >= 2) m
        JOIN proc i USING (person_id, event_id, start_date) JOIN drug2 a ON a.person_id = i.person_id
         AND a.start_date BETWEEN i.start_date AND i.op_end_date""",
}


@query(
    "j10_correlated_nested",
    with_tables(
        """SELECT e.* FROM e_procedure e JOIN codesets c ON c.concept_id = e.target_concept_id AND c.codeset_id = 1
           WHERE EXISTS (SELECT 1 FROM proc_met p WHERE p.person_id = e.person_id AND p.event_id = e.event_id)""",
        PROCEDURES,
    ),
)
def nested_events(spark, sf):
    cdm = clinical(spark, sf)
    sets = codesets(cdm)
    return nested(cdm, sets, query_events(cdm, sets, EventQuery("procedure", codeset_id=1)), NESTED)


MEMBERS = (TWICE, NO_VISIT, NO_DRUG_BEFORE, LATER)


@query(
    "j11_criteria_group",
    with_tables(
        """SELECT person_id, event_id, twice AND no_visit AND no_drug AND later AS met_all,
                  twice OR no_visit OR no_drug OR later AS met_any,
                  CAST(twice AS INT) + CAST(no_visit AS INT) + CAST(no_drug AS INT) + CAST(later AS INT) >= 3 AS met_three,
                  twice AND (no_drug OR later) AS met_inner
           FROM judged""",
        EXTRA,
    ),
)
def groups(spark, sf):
    cdm = clinical(spark, sf)
    judged = add_groups(
        cdm,
        codesets(cdm),
        indexed(cdm),
        {
            "met_all": Group("ALL", MEMBERS),
            "met_any": Group("ANY", MEMBERS),
            "met_three": Group("AT_LEAST", MEMBERS, 3),
            "met_inner": Group("ALL", (TWICE, Group("ANY", (NO_DRUG_BEFORE, LATER)))),
        },
    )
    return judged.select("person_id", "event_id", "met_all", "met_any", "met_three", "met_inner")


@query(
    "j12_at_most_zero",
    with_tables("SELECT person_id, event_id, start_date FROM judged WHERE NOT twice AND NOT later", EXTRA),
)
def at_most_zero(spark, sf):
    return by_group(spark, sf, Group("AT_MOST", (TWICE, LATER), 0))


@query("j13_demographic", with_tables("SELECT person_id, event_id, start_date FROM judged WHERE adult AND later", EXTRA))
def demographic(spark, sf):
    return by_group(spark, sf, Group("ALL", (ADULT, LATER)))


def numbered(source: str) -> str:
    return f"SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY {ORDER}) AS n FROM {source}"


FIRST = CohortSpec(1, (URGENT, EventQuery("condition", codeset_id=11)), tuple(SETS), prior_days=365)
FIRST_SQL = {
    "two_kinds": """
        SELECT e.*, op_start_date, op_end_date FROM e_condition e
        JOIN codesets c ON c.concept_id = e.target_concept_id AND c.codeset_id IN (10, 11)
        JOIN op ON op.person_id = e.person_id AND op_start_date + 365 <= start_date AND start_date <= op_end_date""",
    "first_two": f"SELECT * EXCLUDE (n) FROM ({numbered('two_kinds')}) WHERE n = 1",
}
PICK = "person_id, event_id, start_date, end_date, op_start_date, op_end_date"


@query("w1_primary_limit", with_tables(f"SELECT {PICK} FROM first_two", FIRST_SQL))
def primary(spark, sf):
    cdm = clinical(spark, sf)
    return primary_events(cdm, codesets(cdm), FIRST).select(*PICK.split(", "))


@query("u2_union_all_domains", with_tables(f"SELECT {PICK} FROM two_kinds", FIRST_SQL))
def all_primary(spark, sf):
    cdm = clinical(spark, sf)
    spec = CohortSpec(1, FIRST.primary, FIRST.concept_sets, 365, primary_limit="All")
    return primary_events(cdm, codesets(cdm), spec).select(*PICK.split(", "))


SPEC = CohortSpec(
    7,
    (URGENT,),
    tuple(SETS),
    primary_limit="All",
    additional=Group("ALL", (ADULT,)),
    qualified_limit="All",
    rules=(Group("ALL", (TWICE,)), Group("ALL", (NO_VISIT,)), Group("ALL", (NO_DRUG_BEFORE,))),
    expression_limit="First",
)
SPEC_SQL = {
    **EXTRA,
    "masked": """
        SELECT person_id, event_id, start_date, end_date, op_start_date, op_end_date,
               CAST(twice AS BIGINT) + 2 * CAST(no_visit AS BIGINT) + 4 * CAST(no_drug AS BIGINT) AS inclusion_rule_mask
        FROM judged WHERE adult""",
    "included": """
        SELECT * EXCLUDE (n) FROM (
          SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY start_date, event_id) AS n
          FROM masked WHERE inclusion_rule_mask = 7) WHERE n = 1""",
    "best": """
        SELECT * EXCLUDE (n) FROM (
          SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY -bit_count(inclusion_rule_mask),
                 CASE WHEN inclusion_rule_mask & 1 = 1 OR inclusion_rule_mask = 0 THEN 0
                      WHEN inclusion_rule_mask & 2 = 2 THEN 1 ELSE 2 END, start_date, event_id) AS n
          FROM masked) WHERE n = 1""",
    "result": """
        SELECT inclusion_rule_mask, count(*) AS person_count, 0 AS mode_id FROM masked GROUP BY 1
        UNION ALL SELECT inclusion_rule_mask, count(*), 1 FROM best GROUP BY 1""",
}


@query(
    "w2_qualified_limit",
    with_tables(
        """SELECT person_id, event_id, start_date FROM (
             SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY start_date, event_id) AS n
             FROM judged WHERE adult AND later) WHERE n = 1""",
        EXTRA,
    ),
)
def qualified(spark, sf):
    cdm = clinical(spark, sf)
    spec = CohortSpec(7, (URGENT,), tuple(SETS), primary_limit="All", additional=Group("ALL", (ADULT, LATER)))
    return qualified_events(cdm, codesets(cdm), spec).select("person_id", "event_id", "start_date")


def masked(spark, sf):
    cdm = clinical(spark, sf)
    return masked_events(cdm, codesets(cdm), SPEC)


@query("w3_expression_limit", with_tables("SELECT person_id, event_id, start_date, op_end_date FROM included", SPEC_SQL))
def expression(spark, sf):
    kept = limited(all_rules_met(masked(spark, sf), 3), "First")
    return kept.select("person_id", "event_id", "start_date", "op_end_date")


@query("a3_inclusion_mask", with_tables("SELECT person_id, event_id, inclusion_rule_mask FROM masked", SPEC_SQL))
def mask(spark, sf):
    """From boolean columns to (rule, event) rows and back to masks."""
    rows = masked(spark, sf).select("person_id", "event_id", "inclusion_rule_mask")
    met = inclusion_rows(rows, ["person_id", "event_id"], 3)
    return mask_from_rows(rows.drop("inclusion_rule_mask"), met, ["person_id", "event_id"])


@query("a4_inclusion_filter", with_tables("SELECT person_id, event_id FROM masked WHERE inclusion_rule_mask = 7", SPEC_SQL))
def inclusion_filter(spark, sf):
    return all_rules_met(masked(spark, sf), 3).select("person_id", "event_id")


def results(spark, sf):
    rows = masked(spark, sf)
    return inclusion_result(rows, 0).unionByName(inclusion_result(rows, 1))


@query("a5_inclusion_result", with_tables("SELECT * FROM result", SPEC_SQL))
def result(spark, sf):
    return results(spark, sf)


@query(
    "a6_inclusion_stats",
    with_tables(
        """SELECT mode_id, rule_sequence,
                  CAST(sum(CASE WHEN inclusion_rule_mask & bit > 0 THEN person_count ELSE 0 END) AS BIGINT) AS person_count,
                  CAST(sum(CASE WHEN inclusion_rule_mask = 7 - bit THEN person_count ELSE 0 END) AS BIGINT) AS gain_count,
                  CAST(sum(person_count) AS BIGINT) AS person_total
           FROM result, (VALUES (0, 1), (1, 2), (2, 4)) r(rule_sequence, bit) GROUP BY 1, 2""",
        SPEC_SQL,
    ),
)
def stats(spark, sf):
    return inclusion_stats(results(spark, sf), 3)


@query(
    "a7_summary_stats",
    with_tables(
        """SELECT mode_id, CAST(sum(person_count) AS BIGINT) AS base_count,
                  CAST(sum(CASE WHEN inclusion_rule_mask = 7 THEN person_count ELSE 0 END) AS BIGINT) AS final_count
           FROM result GROUP BY 1""",
        SPEC_SQL,
    ),
)
def summary(spark, sf):
    return summary_stats(results(spark, sf), 3)


@query("a8_best_event", with_tables("SELECT person_id, event_id, inclusion_rule_mask FROM best", SPEC_SQL))
def best(spark, sf):
    return best_events(masked(spark, sf)).select("person_id", "event_id", "inclusion_rule_mask")


@query(
    "j22_best_match_join",
    with_tables("SELECT i.event_id, i.person_id, i.start_date, i.end_date FROM masked i JOIN best USING (event_id)", SPEC_SQL),
)
def best_match(spark, sf):
    return best_events(masked(spark, sf)).select("event_id", "person_id", "start_date", "end_date")


@query(
    "w5_exit_at_observation_end",
    with_tables("SELECT person_id, event_id, start_date, op_end_date AS end_date FROM indexed"),
)
def observation_exit(spark, sf):
    rows = exit_at_observation_end(indexed(clinical(spark, sf)))
    return rows.select("person_id", "event_id", "start_date", "end_date")


@query(
    "w6_exit_fixed_offset",
    with_tables(
        """SELECT person_id, event_id, start_date, start_date + 7 AS end_date, least(start_date + 1, op_end_date) AS capped,
                  end_date + 7 AS from_end FROM indexed"""
    ),
)
def offset_exit(spark, sf):
    rows = indexed(clinical(spark, sf)).withColumn("stored", F.col("end_date"))
    plain = exit_fixed_offset(rows, 7)
    capped = exit_fixed_offset(plain.withColumn("kept", F.col("end_date")), 1, cap=True).withColumn("capped", F.col("end_date"))
    from_end = exit_fixed_offset(capped, 7, "stored").withColumn("from_end", F.col("end_date"))
    return from_end.select("person_id", "event_id", "start_date", F.col("kept").alias("end_date"), "capped", "from_end")


def islands(source: str, keys: str, pad: int) -> str:
    return f"""
        SELECT {keys}, min(start_date) AS start_date, max(end_date) AS end_date FROM (
          SELECT *, sum(opens) OVER (PARTITION BY {keys} ORDER BY start_date, end_date RANGE UNBOUNDED PRECEDING) AS era FROM (
            SELECT *, CASE WHEN start_date <= max(end_date + {pad}) OVER (PARTITION BY {keys} ORDER BY start_date, end_date
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS opens
            FROM {source}))
        GROUP BY {keys}, era"""


for _pad in (0, 1, 180):

    @query(f"w7_era_collapse_pad_{_pad}", with_tables(islands("e_drug_era", "person_id", _pad)))
    def collapse(spark, sf, pad=_pad):
        return era_collapse(domain_events(clinical(spark, sf), "drug_era"), ["person_id"], pad=pad)


@query(
    "w7_era_collapse_events",
    with_tables(
        "SELECT * FROM eras",
        {
            "spells": """SELECT user_id AS person_id, event_type, CAST(ts AS DATE) AS start_date,
                                CAST(ts AS DATE) + CAST(floor(value / 200) AS INT) AS end_date FROM events""",
            "eras": islands("spells", "person_id, event_type", 1),
        },
    ),
)
def collapse_events(spark, sf):
    day = F.col("ts").cast("date")
    spells = load_table(spark, sf, "events").select(
        F.col("user_id").alias("person_id"), "event_type", day.alias("start_date"),
        F.date_add(day, F.floor(F.col("value") / 200).cast("int")).alias("end_date"),
    )
    return era_collapse(spells, ["person_id", "event_type"], pad=1)


@query(
    "w20_same_day_cohort",
    with_tables(
        """SELECT CAST(9 AS BIGINT) AS cohort_definition_id, d.person_id AS subject_id,
                  min(death_date) AS cohort_start_date, min(death_date) AS cohort_end_date
           FROM death d JOIN op ON op.person_id = d.person_id AND death_date BETWEEN op_start_date AND op_end_date GROUP BY d.person_id"""
    ),
)
def same_day(spark, sf):
    return same_day_death_cohort(clinical(spark, sf), 9)


@query(
    "cohort_with_rules",
    with_tables(
        """SELECT CAST(7 AS BIGINT) AS cohort_definition_id, person_id AS subject_id, start_date AS cohort_start_date,
                  op_end_date AS cohort_end_date FROM included""",
        SPEC_SQL,
    ),
)
def cohort_with_rules(spark, sf):
    return build_cohort(clinical(spark, sf), SPEC)


_NAMED = {
    "names": "SELECT * FROM (VALUES (0, 'treated', 'twice'), (1, 'seen', NULL), (2, NULL, NULL)) n(rule_sequence, name, description)",
    "modes": "SELECT * FROM (VALUES (0), (1)) m(mode_id)",
}
_EMPTY = "CAST(NULL AS BIGINT)"


@query(
    "generation_statistics",
    with_tables(
        f"""SELECT 'cohort_inclusion' AS table_name, CAST(7 AS BIGINT) AS cohort_definition_id, rule_sequence, name, description, CAST(NULL AS INT) AS mode_id,
                  {_EMPTY} AS inclusion_rule_mask, {_EMPTY} AS person_count, {_EMPTY} AS gain_count, {_EMPTY} AS person_total, {_EMPTY} AS base_count, {_EMPTY} AS final_count
           FROM names
           UNION ALL SELECT 'cohort_inclusion_result', 7, NULL, NULL, NULL, mode_id, inclusion_rule_mask, person_count, NULL, NULL, NULL, NULL FROM result
           UNION ALL SELECT 'cohort_inclusion_stats', 7, rule_sequence, NULL, NULL, mode_id, NULL,
                  CAST(sum(CASE WHEN inclusion_rule_mask & (1 << rule_sequence) > 0 THEN person_count ELSE 0 END) AS BIGINT),
                  CAST(sum(CASE WHEN inclusion_rule_mask = 7 - (1 << rule_sequence) THEN person_count ELSE 0 END) AS BIGINT),
                  CAST(sum(person_count) AS BIGINT), NULL, NULL
                  FROM result, names GROUP BY rule_sequence, mode_id
           UNION ALL SELECT 'cohort_summary_stats', 7, NULL, NULL, NULL, mode_id, NULL, NULL, NULL, NULL, CAST(sum(person_count) AS BIGINT),
                  CAST(sum(CASE WHEN inclusion_rule_mask = 7 THEN person_count ELSE 0 END) AS BIGINT) FROM result GROUP BY mode_id""",
        {**SPEC_SQL, **_NAMED},
    ),
)
def generation_statistics(spark, sf):
    """The four tables on the inclusion rules of a cohort, one below the other."""
    spec = replace(SPEC, rule_names=(("treated", "twice"), ("seen", None), (None, None)))
    tables = build_with_statistics(clinical(spark, sf), spec)
    rows = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [tables[name].withColumn("table_name", F.lit(name)) for name in STATISTICS],
    )
    return rows


VISIT_COHORT = CohortSpec(
    8,
    (EventQuery("visit", codeset_id=20),),
    tuple(SETS),
    prior_days=365,
    primary_limit="All",
    qualified_limit="All",
    expression_limit="All",
    exit=DateOffset(30, cap=True),
    era_pad=180,
)


@query(
    "cohort_all_events_padded",
    with_tables(
        """SELECT CAST(8 AS BIGINT) AS cohort_definition_id, person_id AS subject_id, start_date AS cohort_start_date,
                  end_date AS cohort_end_date FROM eras""",
        {
            **EXTRA,
            "stays": """SELECT v.person_id, v.start_date, least(v.start_date + 30, op_end_date) AS end_date
                        FROM visit20 v JOIN op ON op.person_id = v.person_id
                        WHERE op_start_date + 365 <= v.start_date AND v.start_date <= op_end_date""",
            "eras": islands("stays", "person_id", 180),
        },
    ),
)
def cohort_padded(spark, sf):
    return build_cohort(clinical(spark, sf), VISIT_COHORT)


NEWLY = CohortSpec(
    6, (URGENT,), tuple(SETS), prior_days=365, rules=(Group("ALL", (
        Correlated(EventQuery("death"), "at_least", 1, Window(0, 365)),)),),
)


@query(
    "cohort_death_within_year",
    with_tables(
        """SELECT CAST(6 AS BIGINT) AS cohort_definition_id, i.person_id AS subject_id, i.start_date AS cohort_start_date,
                  op_end_date AS cohort_end_date
           FROM (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY start_date, event_id) AS n
                 FROM indexed WHERE op_start_date + 365 <= start_date) i
           JOIN death d ON d.person_id = i.person_id AND death_date BETWEEN i.start_date AND i.start_date + 365
            AND death_date BETWEEN op_start_date AND op_end_date
           WHERE n = 1"""
    ),
)
def cohort_death(spark, sf):
    return build_cohort(clinical(spark, sf), NEWLY)


URGENT_COHORT = CohortSpec(1, (URGENT,), tuple(SETS), prior_days=365)
FIRST_URGENT = """
    SELECT CAST(1 AS BIGINT) AS cohort_definition_id, person_id AS subject_id, min(start_date) AS cohort_start_date,
           any_value(op_end_date) AS cohort_end_date
    FROM indexed WHERE op_start_date + 365 <= start_date GROUP BY person_id"""


@query("first_urgent_order", with_tables(FIRST_URGENT))
def first_urgent(spark, sf):
    """The flagship: first urgent order per customer after a year of observation."""
    return build_cohort(clinical(spark, sf), URGENT_COHORT)


UNSEEN = Group("ALL", (Correlated(EventQuery("death"), "at_most", 0, Window(0, 365)),))
SEVERAL = [
    URGENT_COHORT,
    CohortSpec(2, (URGENT,), tuple(SETS)),
    CohortSpec(3, (URGENT,), tuple(SETS), prior_days=180, post_days=90),
    replace(VISIT_COHORT, cohort_id=4, primary=(URGENT,), era_pad=0),
    replace(VISIT_COHORT, cohort_id=5, primary=(URGENT,), era_pad=90),
    NEWLY,
    SPEC,
    VISIT_COHORT,
    replace(VISIT_COHORT, cohort_id=9, prior_days=0, era_pad=30),
    CohortSpec(10, (URGENT,), tuple(SETS), rules=(UNSEEN,), primary_limit="All", qualified_limit="All", expression_limit="All", era_pad=30),
]


def _stays(kind: str, prior: int) -> str:
    return f"""SELECT v.person_id, v.start_date, least(v.start_date + 30, op.op_end_date) AS end_date
               FROM {kind} v JOIN op ON op.person_id = v.person_id
               WHERE op.op_start_date + {prior} <= v.start_date AND v.start_date <= op.op_end_date"""


def _first_urgent(cohort_id: int, prior: int, post: int = 0) -> str:
    return f"""SELECT CAST({cohort_id} AS BIGINT) AS cohort_definition_id, person_id AS subject_id, min(start_date) AS cohort_start_date,
                      any_value(op_end_date) AS cohort_end_date
               FROM indexed WHERE op_start_date + {prior} <= start_date AND start_date + {post} <= op_end_date GROUP BY person_id"""


def _of_eras(cohort_id: int, table: str) -> str:
    return f"SELECT CAST({cohort_id} AS BIGINT), person_id, start_date, end_date FROM {table}"


@query(
    "cohort_set_in_one_pass",
    with_tables(
        " UNION ALL ".join(
            [
                _first_urgent(1, 365),
                _first_urgent(2, 0),
                _first_urgent(3, 180, 90),
                *[_of_eras(i, f"eras_{i}") for i in (4, 5, 8, 9, 10)],
                """SELECT 6, i.person_id, i.start_date, i.op_end_date
                   FROM (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY start_date, event_id) AS n
                         FROM indexed WHERE op_start_date + 365 <= start_date) i
                   JOIN death d ON d.person_id = i.person_id AND death_date BETWEEN i.start_date AND i.start_date + 365
                    AND death_date BETWEEN op_start_date AND op_end_date
                   WHERE n = 1""",
                "SELECT 7, person_id, start_date, op_end_date FROM included",
            ]
        ),
        {
            **SPEC_SQL,
            "stays_urgent": _stays("indexed", 365),
            "stays_visit": _stays("visit20", 365),
            "stays_visit_any": _stays("visit20", 0),
            "alive": """SELECT person_id, start_date, op_end_date AS end_date FROM indexed i WHERE NOT EXISTS (
                        SELECT 1 FROM death d WHERE d.person_id = i.person_id AND death_date BETWEEN i.start_date AND i.start_date + 365
                        AND death_date BETWEEN op_start_date AND op_end_date)""",
            "eras_4": islands("stays_urgent", "person_id", 0),
            "eras_5": islands("stays_urgent", "person_id", 90),
            "eras_8": islands("stays_visit", "person_id", 180),
            "eras_9": islands("stays_visit_any", "person_id", 30),
            "eras_10": islands("alive", "person_id", 30),
        },
    ),
)
def cohort_set(spark, sf):
    """Ten definitions at once."""
    return build_cohorts(clinical(spark, sf), SEVERAL)
