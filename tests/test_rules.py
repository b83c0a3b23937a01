import random

import pytest
from pyspark.sql import functions as F

from vitalgrain.operators import rules
from vitalgrain.operators.rules import ROW_ID


def frame(spark, rows, schema):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"{ROW_ID} long, {schema}")


def test_sex_conflict(spark):
    found = rules.SexConsistency().check(frame(spark, [(1, "M"), (1, "F"), (2, "F")], "patient_id long, sex string")).collect()
    assert [(r.severity, r.affected_rows, r.affected_groups) for r in found] == [("ERROR", 2, 1)]


def test_sex_consistent(spark):
    found = rules.SexConsistency().check(frame(spark, [(1, "M"), (1, "M"), (2, "F"), (2, None), (None, "M"), (None, "F")], "patient_id long, sex string")).first()
    assert (found.severity, found.affected_rows) == ("OK", 0)


def test_missing_columns(spark):
    df = frame(spark, [(1,)], "x int")
    for rule in (rules.SexConsistency(), rules.AgePlausibility()):
        r = rule.check(df).first()
        assert r.severity == "WARNING" and r.affected_rows is None


def test_age(spark):
    df = frame(spark, [(-1,), (25,), (200,), (0,), (120,), (None,)], "age long")
    assert (rules.AgePlausibility().check(df).first().severity, rules.AgePlausibility().check(df).first().affected_rows) == ("WARNING", 2)
    assert [r.row_id for r in rules.AgePlausibility().violations(df).orderBy(ROW_ID).collect()] == [0, 2]
    with pytest.raises(TypeError, match="age"):
        rules.AgePlausibility().check(frame(spark, [("x",)], "age string"))


def test_coherence(spark):
    rows = [(11, "301", "0"), (12, "301", "0"), (11, "300", "0"), (11, "x", "0"), (11, "400d", "9"), (65, "0", "2.1"), (64, "0", "2.1"), (65, "0", "2.0"), (None, "900", "9"), (11, "inf", None)]
    df = frame(spark, rows, "age long, glucose string, creatinine string")
    assert sorted(r.row_id for r in rules.AgeLabCoherence().violations(df).collect()) == [0, 5, 9]
    assert rules.AgeLabCoherence().check(df).first().affected_rows == 3
    zero = rules.AgeLabCoherence().check(frame(spark, [(1,)], "age long")).first()
    assert (zero.severity, zero.affected_rows) == ("WARNING", 0)


def test_spikes(spark):
    inf = float("inf")
    rows = [
        (1, "2020-01-01", 100.0), (1, "2020-01-02", 150.0), (1, "2020-01-03", 226.0),  # exactly 50 %, then more
        (2, "a", 0.0), (2, "b", 10.0),  # after zero
        (3, "a", 10.0), (3, "b", None), (3, "c", 100.0),  # a gap breaks both pairs
        (4, "a", -10.0), (4, "b", 10.0),  # a negative reading before
        (5, "a", inf), (5, "b", inf), (6, "a", 1.0), (6, "b", inf),
        (None, "a", 1.0), (None, "b", 100.0),
        (7, None, 100.0), (7, "a", 10.0),  # no time comes last: 10, then 100
        (8, "a", 1.0), (8, "a", 5.0),  # equal times go by row
    ]
    df = frame(spark, rows, "patient_id long, timestamp string, systolic_bp double")
    assert sorted(r.row_id for r in rules.VitalSpikes().violations(df).collect()) == [2, 9, 13, 16, 19]
    without_time = rules.VitalSpikes().violations(df.drop("timestamp"))
    assert {17, 19} <= {r.row_id for r in without_time.collect()} and 16 not in {r.row_id for r in without_time.collect()}


def test_spikes_count_a_row_once(spark):
    df = frame(spark, [(1, "1", 1.0), (1, "9", 9.0)], "patient_id long, systolic_bp string, spo2 double")
    assert rules.VitalSpikes().check(df).first().affected_rows == 1
    assert rules.VitalSpikes().check(df.drop("patient_id")).first().affected_rows == 0


def test_missing_thresholds(spark):
    df = spark.createDataFrame([(None if i == 0 else 1, None if i < 5 else 1, None if i < 6 else 1) for i in range(10)], "patient_id int, other int, more int")
    rows = rules.MissingThresholds().details(df).collect()
    assert [(r.column_name, r.missing_pct, r.threshold_pct, r.exceeds) for r in rows] == [("patient_id", 10, 0, True), ("other", 50, 50, False), ("more", 60, 50, True)]
    assert rules.MissingThresholds({"more": 60.0}, otherwise=5.0).check(df).first().affected_rows == 2


def test_half_even(spark):
    df = spark.createDataFrame([(None if i == 0 else 1,) for i in range(800)], "x int")
    assert rules.MissingThresholds().details(df).first().missing_pct == 0.12


def test_runner(spark):
    class Mine:
        name = "mine"

        def check(self, df):
            return rules.finding(df.agg(F.count(F.lit(1)).alias("n")), self.name, "OK", "counted", F.col("n"))

    assert isinstance(Mine(), rules.Rule)
    df = frame(spark, [(1, "M"), (1, "F"), (2, "F")], "patient_id long, sex string")
    found = rules.RuleRunner([rules.SexConsistency(), Mine()]).run(df).collect()
    assert [(r.ordinal, r.rule, r.severity, r.affected_rows) for r in found] == [(0, "patient_sex_consistency", "ERROR", 2), (1, "mine", "OK", 3)]
    assert rules.RuleRunner([]).run(df).count() == 0


def test_first_violations(spark):
    df = frame(spark, [(200,)] * 30, "age long")
    rows = rules.first_violations(rules.AgePlausibility().violations(df), 20).collect()
    assert [r.row_id for r in rows] == list(range(20))


def readings(seed, patients, rows, hot):
    rng = random.Random(seed)
    out = []
    for _ in range(rows):
        patient = 0 if rng.random() < hot else rng.choice([None, *range(1, patients)])
        sign = lambda: rng.choice([None, 0.0, 10.0, 16.0, -4.0, float("nan"), 25.0])
        out.append((patient, rng.choice([None, *"abcdefgh"]), sign(), sign()))
    return out


@pytest.fixture
def many_tasks(spark):
    """Small partitions are not put together, so that readings cross tasks."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.unset(key)


@pytest.mark.parametrize("timed", [True, False])
def test_hot_patients_are_dealt_over_tasks(spark, timed, many_tasks):
    df = frame(spark, readings(4, 30, 1500, 0.4), "patient_id long, timestamp string, systolic_bp double, spo2 double")
    df = df if timed else df.drop("timestamp")
    order = lambda rows: sorted(tuple(r) for r in rows)
    want = order(rules.VitalSpikes().spikes(df).collect())
    for limit in (20, 100, 0):
        assert order(rules.VitalSpikes(hot_rows=limit).spikes(df).collect()) == want
    assert any(r[1] for r in want)


def test_a_third_of_all_readings_in_one_patient(spark, many_tasks):
    """No task has more than a fraction of the hot patient's rows, and pairs across tasks are not lost."""
    n = 4000
    df = spark.range(n).select(F.col("id").alias(ROW_ID), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 100).alias("patient_id"), F.when(F.col("id") % 6 == 0, 100.0).otherwise(200.0).alias("heart_rate"))
    values = df.where("patient_id = 7").select(F.col("patient_id").alias("patient"), ROW_ID, F.col("heart_rate").alias("v0"))
    dealt = rules._carried(values, [F.col(ROW_ID)], 1)
    largest = max(r["n"] for r in dealt.groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect())
    assert dealt.count() == 1334 and largest < 1334 / 2
    assert rules.VitalSpikes(hot_rows=500).check(df).first().affected_rows == sum(1 for i in range(1, 1334) if i % 2 == 1)


def test_one_scan_for_measured_rules(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_id").alias(ROW_ID), (F.col("event_id") % 130).alias("age"), F.col("value").cast("string").alias("glucose"), (F.col("event_id") % 5).cast("string").alias("creatinine"))
    suite = [rules.AgeLabCoherence(), rules.AgePlausibility(), rules.MissingThresholds(ignored=(ROW_ID,))]
    found = rules.RuleRunner(suite).run(df)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert [tuple(r)[1:] for r in found.collect()] == [tuple(r.check(df).first()) for r in suite]
    marks = rules.all_violations(suite[:2], df)
    assert marks._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    both = rules.AgeLabCoherence().violations(df).unionByName(rules.AgePlausibility().violations(df))
    assert sorted(map(repr, marks.collect())) == sorted(map(repr, both.collect())) != []


def test_outliers(spark):
    rows = [(float(x), "7", str(x)) for x in [*range(1, 21), 100, -60]] + [(None, "7", "x"), (float("nan"), "8", None)]
    df = frame(spark, rows, "v double, same string, t string")
    assert [(r.row_id, r.column_name) for r in rules.IqrOutliers().violations(df).orderBy(ROW_ID).collect()] == [(20, "v"), (21, "v")]
    every = rules.IqrOutliers(numeric_only=False).violations(df).collect()
    assert sorted((r.row_id, r.column_name) for r in every) == [(20, "t"), (20, "v"), (21, "t"), (21, "v"), (23, "same")]
    assert rules.IqrOutliers(100).check(df).first().affected_rows == 0
    assert rules.IqrOutliers().check(df.select(ROW_ID, "t")).first().affected_rows == 0
    assert rules.IqrOutliers().violations(df.limit(0)).count() == 0
