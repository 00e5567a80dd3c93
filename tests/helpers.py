"""Small frames for tests."""

from datetime import date, timedelta

from epiloom.sources.tables import Cdm

DAY0 = date(2000, 1, 1)


def day(n: int) -> date:
    return DAY0 + timedelta(n)


def cohort(spark, rows):
    """Rows of (cohort id, subject, start day, end day)."""
    return spark.createDataFrame(
        [(c, s, day(a), day(b)) for c, s, a, b in rows],
        "cohort_definition_id bigint, subject_id bigint, cohort_start_date date, cohort_end_date date",
    )


def intervals(spark, rows):
    """Rows of (person, start day, end day)."""
    return spark.createDataFrame([(p, day(a), day(b)) for p, a, b in rows], "person_id bigint, start_date date, end_date date")


def cdm(spark, persons=(), periods=(), conditions=(), drugs=(), visits=(), deaths=(), concepts=(), ancestors=()):
    """A small database.

    persons: (id, sex, year, month, day of birth); periods: (person, start, end);
    conditions, drugs: (id, person, concept, start, end or None);
    visits: (id, person, concept, start, end); deaths: (person, day).
    """

    def at(n):
        return None if n is None else day(n)

    return Cdm(
        {
            "person": spark.createDataFrame(
                list(persons), "person_id bigint, gender_concept_id int, year_of_birth int, month_of_birth int, day_of_birth int"
            ),
            "observation_period": spark.createDataFrame(
                [(i, p, at(a), at(b), 1) for i, (p, a, b) in enumerate(periods)],
                "observation_period_id bigint, person_id bigint, observation_period_start_date date, "
                "observation_period_end_date date, period_type_concept_id int",
            ),
            "condition_occurrence": spark.createDataFrame(
                [(i, p, c, at(a), at(b), None) for i, p, c, a, b in conditions],
                "condition_occurrence_id bigint, person_id bigint, condition_concept_id bigint, condition_start_date date, "
                "condition_end_date date, visit_occurrence_id bigint",
            ),
            "drug_exposure": spark.createDataFrame(
                [(i, p, c, at(a), at(b), None) for i, p, c, a, b in drugs],
                "drug_exposure_id bigint, person_id bigint, drug_concept_id bigint, drug_exposure_start_date date, "
                "drug_exposure_end_date date, visit_occurrence_id bigint",
            ),
            "visit_occurrence": spark.createDataFrame(
                [(i, p, c, at(a), at(b)) for i, p, c, a, b in visits],
                "visit_occurrence_id bigint, person_id bigint, visit_concept_id bigint, visit_start_date date, visit_end_date date",
            ),
            "death": spark.createDataFrame(
                [(p, at(d), None) for p, d in deaths], "person_id bigint, death_date date, cause_concept_id bigint"
            ),
            "concept": spark.createDataFrame(list(concepts), "concept_id bigint, invalid_reason string"),
            "concept_ancestor": spark.createDataFrame(
                list(ancestors), "ancestor_concept_id bigint, descendant_concept_id bigint"
            ),
        }
    )


def rows(df, *columns):
    """Sorted tuples of some columns, dates as day numbers from DAY0."""

    def plain(v):
        return (v - DAY0).days if isinstance(v, date) else v

    return sorted((tuple(plain(r[c]) for c in (columns or df.columns)) for r in df.collect()), key=lambda t: [(v is not None, v) for v in t])
