"""Everything else: cells, limits, follow-up, counts, populations, sources."""

import random
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from epiloom import schema
from epiloom.functions.cells import as_text, count_columns, suppress_small
from epiloom.functions.dates import birth_date
from epiloom.functions.names import camel
from epiloom.functions.ordinals import number_rows
from epiloom.functions.poisson import gamma_quantile
from epiloom.operators.characterize import cohort_characteristics
from epiloom.operators.counts import attrition, cohort_counts, counts_with_zero
from epiloom.operators.followup import (
    event_washout,
    intersect_flag,
    k_of_n,
    k_of_n_levels,
    outcome_after_index,
    outcome_at_risk,
)
from epiloom.operators.incidence import label_outcomes
from epiloom.operators.observation import attach_observation, require_latest_date, study_window
from epiloom.operators.population import population_features, sample_n
from epiloom.operators.snapshot import snapshot, source_information
from epiloom.plans import post_infection as post
from epiloom.session import scratch_dir
from epiloom.sources import export, tables, versions
from helpers import cdm, cohort, day, rows


def test_suppression_at_five(spark):
    df = spark.createDataFrame([(i, v, v) for i, v in enumerate([0, 1, 4, 5, None])], "i int, n_count int, other int")
    assert count_columns(df) == ["n_count"]
    found = rows(suppress_small(df, ["n_count"], 5))
    assert [r[1] for r in found] == [0, None, None, 5, None] and [r[2] for r in found] == [0, 1, 4, 5, None]


def test_export_hides_small_counts(spark, tmp_path):
    df = spark.createDataFrame([(1, 3), (2, 8)], "id int, Outcome_Count int")
    export.export_results(df, 5, str(tmp_path / "x"))
    assert rows(spark.read.csv(str(tmp_path / "x"), header=True)) == [("1", None), ("2", "8")]


def test_plain_numbers(spark):
    df = spark.createDataFrame([(1.0e9,), (1.0e-5,), (0.5,)], "v double").select(as_text(F.col("v")).alias("t"))
    assert rows(df) == [("0.000010",), ("0.500000",), ("1000000000.000000",)]


@pytest.mark.parametrize(
    "k, lower, upper",
    [(1, 0.0253178, 5.5716434), (2, 0.2422093, 7.2246877), (5, 1.6234864, 11.6683321), (10, 4.7953887, 18.3903560), (100, 81.3639913, 121.6267938)],
)
def test_poisson_limits_match_printed_tables(k, lower, upper):
    assert gamma_quantile(0.025, np.array([k]))[0] == pytest.approx(lower, abs=1e-6)
    assert gamma_quantile(0.975, np.array([k + 1]))[0] == pytest.approx(upper, abs=1e-6)


def test_birth_dates(spark):
    df = spark.createDataFrame([(1980, 2, 29), (1981, 0, 0), (1982, None, 31), (1981, 2, 30)], "y int, m int, d int")
    found = [r[0] for r in df.select(birth_date(F.col("y"), F.col("m"), F.col("d"))).collect()]
    assert found == [date(1980, 2, 29), date(1981, 1, 1), date(1982, 1, 31), date(1981, 2, 28)]
    assert camel("acute_cohorts_extra") == "AcuteCohortsExtra"


def test_washout_42_and_43_days(spark):
    entries = cohort(spark, [(1, 1, 0, 0), (1, 1, 42, 42), (1, 1, 85, 85), (1, 2, 0, 0)])
    assert rows(event_washout(entries, entries, 42), "subject_id", "cohort_start_date") == [(1, 0), (1, 85), (2, 0)]


def test_outcomes_91_to_365_days_after(spark):
    index = cohort(spark, [(1, s, 0, 500) for s in range(1, 7)] + [(1, 4, -400, 0)])
    outcomes = cohort(
        spark,
        [(3, 1, 90, 99), (3, 1, 91, 99), (3, 2, 365, 366), (3, 2, 366, 367), (3, 3, 100, 101), (3, 3, -1, -1),
         (3, 4, 100, 101), (3, 4, -181, -181), (3, 5, 100, 100), (3, 5, -300, -180), (3, 5, 100, 100), (4, 5, 120, 121)],
    )
    found = rows(outcome_after_index(index, outcomes), "cohort_definition_id", "subject_id", "cohort_start_date")
    # 4: the earlier entry's outcome at -181 lies 219 days after it and is kept too
    assert found == [(3, 1, 91), (3, 2, 365), (3, 4, -181), (3, 4, 100), (4, 5, 120)]


def test_flag_by_overlap_or_start(spark):
    entries = cohort(spark, [(1, 1, 200, 201)])
    target = cohort(spark, [(1, 1, 0, 25)])
    for overlap, expected in ((True, 1), (False, 0)):
        flag = intersect_flag(entries, target, ["subject_id"], -180, -1, "flag", overlap)
        assert rows(flag, "flag") == [(expected,)]


def test_k_of_n(spark):
    rows_in = cohort(spark, [(1, 1, 5, 6), (2, 1, 3, 4), (3, 1, 9, 9), (1, 2, 1, 1), (1, 3, 4, 4), (1, 3, 2, 3)])
    assert rows(k_of_n(rows_in, 2, 2)) == [(2, 1, 3, 4), (2, 3, 2, 3)]
    levels = rows(k_of_n_levels(rows_in, {1: 4, 2: 5, 3: 6}), "cohort_definition_id", "subject_id")
    assert levels == [(4, 1), (4, 2), (4, 3), (5, 1), (5, 3), (6, 1)]


def test_outcome_at_risk(spark):
    c = cdm(spark, periods=[(i, 0, 1000) for i in (1, 2, 3)] + [(4, 0, 200), (5, 0, 200)])
    target = cohort(spark, [(1, i, 100, 100) for i in range(1, 6)] + [(1, 1, 50, 50)])
    outcome = cohort(spark, [(2, 1, 50, 50), (2, 1, 780, 780), (2, 1, 781, 781), (2, 2, 99, 99), (2, 5, 150, 150)])
    found = rows(outcome_at_risk(target, outcome, c.observation_period))
    assert found == [(1, 50, 730, 2), (3, 100, 730, 0), (5, 100, 100, 1)]


def test_attrition_counts_rows_and_subjects(spark):
    df = spark.createDataFrame([(1, 1, True), (1, 2, False), (2, 3, True), (3, 0, None)], "subject_id int, a int, b boolean")
    found = attrition(df, "all", [("a", F.col("a") > 0), ("b", F.col("b"))])
    assert rows(found) == [(1, "all", 4, 3, 0, 0), (2, "a", 3, 2, 1, 1), (3, "b", 2, 2, 1, 0)]


def test_counts(spark):
    df = cohort(spark, [(1, 1, 0, 1), (1, 1, 5, 6), (1, 2, 0, 1), (2, 1, 0, 1)])
    assert rows(cohort_counts(df)) == [(1, 3, 2), (2, 1, 1)]
    ids = spark.createDataFrame([(1,), (2,), (3,)], "cohort_definition_id bigint")
    assert rows(counts_with_zero(df, ids)) == [(1, 3, 2), (2, 1, 1), (3, 0, 0)]


def test_row_numbers_with_a_hot_and_a_huge_key(spark):
    rnd = random.Random(0)
    keys = [7] * 300 + [rnd.randint(-(2**62), 2**62) for _ in range(50)] + [rnd.randint(0, 2**23) for _ in range(50)]
    data = [(k, day(rnd.randint(0, 40)), i) for i, k in enumerate(keys)]
    df = spark.createDataFrame(data, "subject_id bigint, d date, i int")
    found = sorted(tuple(r) for r in number_rows(df, "subject_id", "d", ["i"], "row_id").collect())
    assert found == [(n + 1, *row) for n, row in enumerate(sorted(data))]


def test_row_numbers_split_one_key_and_day(spark):
    data = [(7, day(3), i // 3) for i in range(4000)] + [(k, day(1), 0) for k in range(20)] + [(9, None, 1)]
    df = spark.createDataFrame(random.Random(1).sample(data, len(data)), "subject_id bigint, d date, i int")
    found = sorted(tuple(r) for r in number_rows(df, "subject_id", "d", ["i"], "row_id").collect())
    assert found == [(n + 1, *row) for n, row in enumerate(sorted(data, key=lambda r: (r[0], r[1] is not None, r[1] or day(0), r[2])))]
    plan = number_rows(df, "subject_id", "d", ["i"], "row_id")._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "row_number" in line]
    assert windows and all("_range" in line for line in windows)  # not by key and day


def test_population_and_sample(spark):
    c = cdm(spark, [(1, 8507, 1950, 1, 1), (2, 8532, 1960, 1, 1)], periods=[(1, 0, 500), (2, 300, 900)])
    entries = cohort(spark, [(1, 1, 100, 900), (1, 1, 50, 60), (1, 2, 310, 320), (1, 2, 200, 210)])
    found = population_features(entries, c, day(20), day(400), washout=20)
    assert rows(found, "row_id", "subject_id", "days_from_obs_start", "days_to_cohort_end", "days_to_obs_end") == [
        (1, 1, 50, 10, 350), (2, 1, 100, 300, 300)
    ]
    twins = cohort(spark, [(5, 1, 100, 110), (4, 1, 100, 110), (3, 1, 100, 120)])
    assert rows(population_features(twins, c), "row_id", "cohort_definition_id") == [(1, 4), (2, 5), (3, 3)]
    once = population_features(entries, c, first=True)
    assert rows(once, "subject_id", "days_to_cohort_end", "age_year") == [(1, 10, 50)]
    assert sample_n(entries, 3).count() == 3


def post_tables(spark):
    acute = cohort(
        spark,
        [(1, 1, 400, 401), (1, 1, 430, 431), (1, 2, 400, 401), (2, 2, 350, 351), (1, 3, 400, 401), (1, 3, 500, 501),
         (1, 4, 400, 401), (1, 5, 364, 370), (1, 6, 400, 405), (1, 7, 2000, 2001)],
    )
    c = cdm(spark, periods=[(i, 0, 1500) for i in range(1, 7)], deaths=[(4, 450), (6, 800)])
    return acute, c


def test_infections(spark):
    acute, c = post_tables(spark)
    rules = post.EntryRules(day(10), day(1200))
    known = post.infections(acute, c.observation_period, c.death, rules)
    kept = rows(post.kept_infections(known, rules))
    # 1: second washed out and first ends at the second; 2: influenza; 3: second entry only; 4: death;
    # 5: one day short; 6: dies later; 7: not observed
    assert kept == [(1, 3, 500, 1500), (1, 6, 400, 800)]
    steps = rows(post.entry_attrition(known, rules), "reason_id", "number_records", "number_subjects")
    assert steps == [(1, 9, 7), (2, 8, 7), (3, 7, 6), (4, 6, 5), (5, 5, 4), (6, 5, 4), (7, 2, 2)]
    assert rows(post.censoring_reasons(known, rules)) == [("death", 1), ("next covid infection", 2)]
    symptoms = cohort(spark, [(1, 3, 600, 610), (2, 3, 620, 630), (1, 6, 500, 501), (1, 6, 350, 351)])
    conditions = cohort(spark, [(1, 6, 600, 610)])
    six = rows(post.overlap_cohorts(post.kept_infections(known, rules), symptoms, conditions))
    assert six == [(1, 3, 600, 610), (2, 3, 600, 610), (4, 6, 600, 610)]


def test_study_window_is_open(spark):
    entries = cohort(spark, [(1, i, d, d) for i, d in enumerate([0, 1, 634, 635])])
    assert rows(study_window(entries, day(0), day(1000)), "cohort_start_date") == [(1,), (634,)]


def test_latest_date(spark):
    c = cdm(spark, periods=[(1, 0, 10), (2, 0, 30)])
    assert require_latest_date(c.observation_period) == day(30)
    with pytest.raises(ValueError):
        require_latest_date(c.observation_period.filter("person_id > 9"))


def test_characteristics(spark):
    c = cdm(spark, [(1, 8507, 1980, 1, 1), (2, 8532, 1960, 1, 1)], periods=[(1, -10, 100)])
    entries = cohort(spark, [(1, 1, 0, 9), (1, 1, 1, 1), (1, 2, 3, 3)])
    found = cohort_characteristics(entries, c.person, c.observation_period)
    value = {(r.variable_name, r.variable_level, r.estimate_name): r.estimate_value for r in found.collect()}
    assert value["Number records", "NA", "count"] == "3" and value["Number subjects", "NA", "count"] == "2"
    assert value["Cohort start date", "NA", "median"] == "2000-01-02"
    assert value["Age", "NA", "q25"] == "20.000000" and value["Age", "NA", "q75"] == "30.000000"
    assert value["Prior observation", "NA", "mean"] == "10.500000"
    assert value["Sex", "Male", "percentage"] == "50.000000"
    assert value["Age group", "40 to 59", "count"] == "1"
    hidden = cohort_characteristics(entries, c.person, c.observation_period, 5).filter("estimate_name = 'count'")
    assert {r.estimate_value for r in hidden.collect()} == {None, "0"}


def test_snapshot_falls_back_to_vocabulary(spark):
    c = cdm(spark, [(1, 8507, 1980, 1, 1)], periods=[(1, 0, 9)])
    source = spark.createDataFrame([("db", "5.4", "")], "cdm_source_name string, cdm_version string, vocabulary_version string")
    vocabulary = spark.createDataFrame([("None", "v5 2024"), ("X", "v1")], "vocabulary_id string, vocabulary_version string")
    found = snapshot(c.person, c.observation_period, source, vocabulary, day(0))
    value = {(r.variable_name, r.estimate_name): r.estimate_value for r in found.collect()}
    assert value["general", "vocabulary_version"] == "v5 2024" and value["cdm", "source_name"] == "db"
    assert value["observation_period", "end_date"] == "2000-01-10" and value["general", "snapshot_date"] == "2000-01-01"
    version = spark.createDataFrame([(3, day(1))], "version_id int, version_date date")
    full = spark.createDataFrame([("db", "A text", "5.4", "v0")], "cdm_source_name string, source_description string, cdm_version string, vocabulary_version string")
    row = source_information(full, vocabulary, version).first()
    assert row.cdm_source_name == "db (v3 2000-01-02)" and row.vocabulary_version_cdm == "v0"
    assert row.database_description.startswith("A text ETL Reference: None") and row.vocabulary_version == "v5 2024"


def test_a_description_of_several_rows_is_refused(spark):
    c = cdm(spark, [(1, 8507, 1980, 1, 1)], periods=[(1, 0, 9)])
    source = spark.createDataFrame([("a", "1"), ("b", "1")], "cdm_source_name string, cdm_version string")
    with pytest.raises(Exception, match="more than one row"):
        snapshot(c.person, c.observation_period, source, None, day(0)).collect()
    assert snapshot(c.person, c.observation_period, source.limit(0), None, day(0)).count() == 18


def test_replacing_one_cohort_keeps_the_others(spark, tmp_path):
    path = str(tmp_path / "cohorts")
    tables.replace_cohort(cohort(spark, [(1, 1, 0, 1), (2, 1, 0, 1), (3, 1, 0, 1)]), [1, 2, 3], path)
    tables.replace_cohort(cohort(spark, [(2, 9, 5, 6)]), [2, 3], path)
    tables.replace_cohort(cohort(spark, [(2, 9, 5, 6)]), [2], path)
    assert rows(tables.read_cohorts(spark, path)) == [(1, 1, 0, 1), (2, 9, 5, 6)]
    with pytest.raises(Exception, match="not replaced"):
        tables.replace_cohort(cohort(spark, [(2, 9, 5, 6)]), [1], path)
    tables.replace_cohort(cohort(spark, []), [1, 2], path)
    assert rows(tables.read_cohorts(spark, path)) == []
    assert tables.cohort_exists(spark, path) and not tables.cohort_exists(spark, path + "x")


def _stop(*_):
    raise RuntimeError("the driver is lost")


def test_readers_see_all_of_a_replacement_or_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "cohorts")
    first = [(1, 1, 0, 1), (2, 1, 0, 1), (3, 1, 0, 1)]
    tables.replace_cohort(cohort(spark, first), [1, 2, 3], path)
    reader = tables.read_cohorts(spark, path)
    files, new = versions.file_system, cohort(spark, [(2, 9, 5, 6), (2, 8, 5, 6)])

    def no_rename(spark, path):
        system, target = files(spark, path)
        return type("Lost", (), {"rename": _stop, "__getattr__": lambda _, name: getattr(system, name)})(), target

    with monkeypatch.context() as m:  # rows written, no manifest
        m.setattr(versions, "commit", _stop)
        with pytest.raises(RuntimeError, match="lost"):
            tables.replace_cohort(new, [2, 3], path)
    assert rows(tables.read_cohorts(spark, path)) == first and versions.versions(spark, path) == [1]
    with monkeypatch.context() as m:  # manifest written, not renamed
        m.setattr(versions, "file_system", no_rename)
        with pytest.raises(RuntimeError, match="lost"):
            tables.replace_cohort(new, [2, 3], path)
    assert rows(tables.read_cohorts(spark, path)) == first and versions.versions(spark, path) == [1]
    tables.replace_cohort(new, [2, 3], path)
    after = [(1, 1, 0, 1), (2, 8, 5, 6), (2, 9, 5, 6)]
    assert rows(tables.read_cohorts(spark, path)) == after and rows(reader) == first
    with pytest.raises(versions.ConcurrentReplacement):
        versions.commit(spark, path, 2, {})
    assert rows(versions.read_ids(spark, path, schema.COHORT, 1)) == first
    versions.clear_versions(spark, path)
    left = sorted(p.name for p in tmp_path.glob("cohorts/run=*/cohort_definition_id=*"))
    assert left == ["cohort_definition_id=1", "cohort_definition_id=2"] and versions.versions(spark, path) == [2]
    assert rows(tables.read_cohorts(spark, path)) == after
    with pytest.raises(ValueError, match="latest"):
        versions.clear_versions(spark, path, 0)


def test_folders_without_versions_are_taken_over(spark, tmp_path):
    path = str(tmp_path / "cohorts")
    cohort(spark, [(1, 1, 0, 1), (2, 1, 0, 1)]).write.partitionBy("cohort_definition_id").parquet(path)
    assert rows(tables.read_cohorts(spark, path)) == [(1, 1, 0, 1), (2, 1, 0, 1)]
    tables.replace_cohort(cohort(spark, [(2, 9, 5, 6)]), [2], path)
    assert rows(tables.read_cohorts(spark, path)) == [(1, 1, 0, 1), (2, 9, 5, 6)]
    versions.clear_versions(spark, path)
    assert rows(tables.read_cohorts(spark, path)) == [(1, 1, 0, 1), (2, 9, 5, 6)]
    only = tables.read_cohorts(spark, path).where("cohort_definition_id = 2")
    assert "PartitionFilters: [isnotnull(cohort_definition_id" in only._jdf.queryExecution().toString()


def test_stored_tables_lie_in_the_shared_folder(spark):
    df = tables.materialize(cohort(spark, [(1, 1, 0, 1)]), "t")
    assert all(scratch_dir(spark).split(":")[-1] in f for f in df.inputFiles())
    assert rows(df) == [(1, 1, 0, 1)]


def test_cohort_list_names_outcomes(spark, tmp_path):
    path = tmp_path / "list.csv"
    path.write_text("anId,aName,cohortId,cohortName,table_name,root\n7,x,1,asthma,chronic,dir\n8,y,2,NA,chronic,dir\n")
    labels = tables.read_settings(spark, str(path), schema.COHORT_LIST)
    rates = spark.createDataFrame([(1, "chronic"), (2, "chronic")], "outcome_id long, outcome_table string")
    assert rows(label_outcomes(rates, labels), "outcome_id", "outcome_name") == [(1, "asthma"), (2, "chronic_2")]


class _Session:
    """A session without a checkpoint folder."""

    def __init__(self, master):
        self.sparkContext = self
        self.conf = self
        self.master = master
        self.applicationId = f"app {master}"

    def get(self, key, default):
        return default

    def getCheckpointDir(self):
        return None


def test_a_cluster_needs_a_shared_folder():
    assert scratch_dir(_Session("local[4]")) == scratch_dir(_Session("local[4]"))
    for master in ("yarn", "local-cluster[3,2,1024]", "spark://host:7077"):
        with pytest.raises(ValueError):
            scratch_dir(_Session(master))


def test_a_hot_person_is_split(spark):
    """One person with most events: adaptive execution splits that partition."""
    c = cdm(spark, periods=[(i, 0, 3000) for i in range(200)])
    person = F.when(F.col("id") % 3 < 2, F.lit(0)).otherwise(F.col("id") % 200)
    events = spark.range(120_000).select(
        person.alias("person_id"), F.col("id").alias("event_id"),
        F.date_add(F.lit(day(0)), (F.col("id") % 2500).cast("int")).alias("start_date"),
    )
    before = {k: spark.conf.get(k, None) for k in (
        "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
        "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.forceOptimizeSkewedJoin")}
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100KB")
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "100KB")
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        found = attach_observation(events, c.observation_period).groupBy("person_id").count()
        assert found.agg(F.sum("count")).first()[0] == 120_000
        found.collect()
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)
