"""Cohort entries against other cohorts: washout, nearest events, follow-up, overlap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epiloom.operators.events import first_rows
from epiloom.operators.observation import periods
from epiloom.operators.ranges import DayRange, Nearest, count_in_ranges, counts_of_anchors, nearest_in_ranges
from epiloom.sources.tables import materialize

COHORT_KEY = ["cohort_definition_id", "subject_id"]


def intersect_dates(cohort: DataFrame, questions: list[Nearest]) -> DataFrame:
    """Dates of the first or last target starts in windows around the entry, or null."""
    found = nearest_in_ranges(cohort, ["subject_id"], "cohort_start_date", questions)
    return found.select(*cohort.columns, *[q.name for q in questions])


def target_start(name: str, target: DataFrame, lower: int | None, upper: int | None, which: str) -> Nearest:
    """The question for the start of a cohort table's rows."""
    return Nearest(name, target, "cohort_start_date", lower, upper, which)


def intersect_date(cohort: DataFrame, target: DataFrame, lower: int | None, upper: int | None, which: str, name: str) -> DataFrame:
    """Date of the first or last target start in a window, or null."""
    return intersect_dates(cohort, [target_start(name, target, lower, upper, which)])


def intersect_days(cohort: DataFrame, target: DataFrame, lower: int | None, upper: int | None, which: str, name: str) -> DataFrame:
    """Signed days from entry to the first or last target start in a window, or null."""
    found = intersect_date(cohort, target, lower, upper, which, name)
    return found.withColumn(name, F.datediff(name, "cohort_start_date"))


def _around(target: DataFrame, lower: int, upper: int, overlap: bool) -> DayRange:
    entry = "cohort_start_date"
    return DayRange(
        "_n", target, F.date_add(entry, lower), F.date_add(entry, upper),
        overlap=overlap, start="cohort_start_date", end="cohort_end_date",
    )


def intersect_flag(cohort: DataFrame, target: DataFrame, keys: list[str], lower: int, upper: int, name: str, overlap: bool = True) -> DataFrame:
    """1 if a target of the same keys meets the window around the entry, else 0.

    With `overlap` a target counts if any of its days falls into the window,
    otherwise only if its start does.
    """
    counted = count_in_ranges(cohort, keys, ["cohort_start_date"], [_around(target, lower, upper, overlap)])
    return counted.select(*cohort.columns, (F.col("_n") > 0).cast("int").alias(name))


def event_washout(cohort: DataFrame, target: DataFrame, days: int) -> DataFrame:
    """Entries without a target start in the `days` days before."""
    gap = intersect_days(cohort, target, None, -1, "last", "_previous")
    return gap.filter(F.col("_previous").isNull() | (F.col("_previous") < -days)).drop("_previous")


def follow_up_end(obs_end: Column, death: Column, next_event: Column) -> Column:
    """First of end of observation, death and next event."""
    return F.least(obs_end, death, next_event)


def censor_reason(end: Column, obs_end: Column, death: Column, next_event: Column) -> Column:
    # The texts of the reasons.
    return (
        F.when(end == death, "death")
        .when(end == obs_end, "end of data collection or exit from database")
        .when(end == next_event, "next covid infection")
    )


def outcome_after_index(index: DataFrame, outcomes: DataFrame, after: int = 91, until: int = 365, clear_days: int | None = 180) -> DataFrame:
    """Distinct outcomes that start `after`..`until` days after an index entry.

    An index entry counts for an outcome cohort only if the subject has nothing
    of that cohort in the `clear_days` days before the entry. Outcomes keep
    their cohort id, so all symptom cohorts are handled at once.
    """
    entries = index.select("subject_id", "cohort_start_date").distinct()
    # Read three times below; stored, so that what makes the outcomes runs once.
    rows = materialize(outcomes.select(*COHORT_KEY, "cohort_start_date", "cohort_end_date").distinct(), "outcomes")
    kinds = rows.select(*COHORT_KEY).distinct()
    asked = entries.join(kinds, "subject_id")
    if clear_days is not None:
        before = _around(rows, -clear_days, -1, True)
        asked = counts_of_anchors(asked, COHORT_KEY, ["cohort_start_date"], [before]).filter("_n = 0")
    clear = asked.select(*COHORT_KEY, F.col("cohort_start_date").alias("start_date"))
    window = DayRange("_n", clear, F.date_sub("cohort_start_date", until), F.date_sub("cohort_start_date", after))
    return count_in_ranges(rows, COHORT_KEY, ["cohort_start_date"], [window]).filter("_n > 0").select(rows.columns)


def k_of_n(symptoms: DataFrame, k: int, cohort_id: int) -> DataFrame:
    """First row of every subject with at least `k` rows."""
    return k_of_n_levels(symptoms, {k: cohort_id})


def k_of_n_levels(symptoms: DataFrame, levels: dict[int, int]) -> DataFrame:
    """`k_of_n` for several k at once; `levels` maps k to the new cohort id.

    Counts and first rows are aggregates, so no subject's rows are gathered.
    """
    enough = F.array_compact(
        F.array(*[F.when(F.col("n") >= k, F.lit(i).cast("long")) for k, i in levels.items()])
    )
    return (
        symptoms.groupBy("subject_id")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("cohort_start_date", "cohort_end_date")).alias("first"))
        .select(
            F.explode(enough).alias("cohort_definition_id"), "subject_id",
            "first.cohort_start_date", "first.cohort_end_date",
        )
    )


def symptom_counts(symptoms: DataFrame) -> DataFrame:
    """Number of different symptom cohorts in a table."""
    return symptoms.agg(F.countDistinct("cohort_definition_id").alias("n_cohorts"))


def shifted_union(cohort: DataFrame, other: DataFrame, shift: int) -> DataFrame:
    """Two cohort tables in one, the ids of the second moved up by `shift`."""
    moved = other.withColumn("cohort_definition_id", F.col("cohort_definition_id") + shift)
    return cohort.unionByName(moved)


def outcome_at_risk(
    target: DataFrame,
    outcome: DataFrame,
    observation_period: DataFrame,
    risk_start: int = 0,
    risk_end: int = 730,
    drop_prior_outcome: bool = True,
    require_time_at_risk: bool = True,
    keep_all_outcomes: bool = True,
) -> DataFrame:
    """First exposure per subject with the outcomes in its risk window.

    Subjects with the outcome before entry are dropped. The whole window must be
    observed, except (`keep_all_outcomes`) for subjects with the outcome in it.
    """
    first = first_rows(target, ["subject_id"], ["cohort_start_date", "cohort_end_date"])
    seen = first.join(periods(observation_period, "subject_id"), "subject_id").filter(
        F.col("cohort_start_date").between(F.col("op_start_date"), F.col("op_end_date"))
    )
    last = F.least(F.date_add("cohort_start_date", risk_end), F.col("op_end_date"))
    events = outcome.select("subject_id", F.col("cohort_start_date").alias("start_date"))
    counted = count_in_ranges(
        seen,
        ["subject_id"],
        ["cohort_start_date", "op_end_date"],
        [
            DayRange("outcome_count", events, F.date_add("cohort_start_date", risk_start), last),
            DayRange("_prior", events, None, F.date_sub("cohort_start_date", 1)),
        ],
    )
    days = F.datediff(last, F.date_add("cohort_start_date", risk_start))
    result = counted.withColumn("time_at_risk", days)
    if drop_prior_outcome:
        result = result.filter("_prior = 0")
    if require_time_at_risk:
        enough = F.col("time_at_risk") >= max(risk_end - risk_start - 1, 0)
        result = result.filter(enough | (F.col("outcome_count") > 0) if keep_all_outcomes else enough)
    return result.select("subject_id", "cohort_start_date", "time_at_risk", "outcome_count")
