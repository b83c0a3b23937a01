from pyspark.sql import functions as F

from vitalgrain.operators import records
from vitalgrain.sources.tables import ROW_ID



def frame(spark, rows, schema):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"{ROW_ID} long, {schema}")


def codes(df):
    return {r.row_id: r.error_code for r in df.collect()}


def test_patients(spark):
    rows = [(1, " Male ", "2020-01-01"), (None, None, None), (2, "M", "2999-01-01"), (3, "x", "01/02/2020"), (4, "x", "2026-01-01")]
    df = frame(spark, rows, "patient_nbr long, gender string, birthDate string")
    found = records.patients(df, today=F.lit("2026-01-01").cast("date"))
    assert codes(found) == {0: None, 1: None, 2: "future_birth_date", 3: "bad_birth_date", 4: None}
    assert [r.row_id for r in found.where("null_id").collect()] == [1]
    assert records.patients(df.drop("gender")).count() == 0


def test_labs(spark):
    df = frame(spark, [(1, ">200", "7.1"), (2, "Norm", "1_000"), (3, None, "inf"), (4, "nan", None)], "patient_nbr long, max_glu_serum string, A1Cresult string")
    got = {(r.row_id, r.code): r.error_code for r in records.lab_observations(df).collect()}
    assert got == {(0, "max_glu_serum"): "non_numeric", (0, "A1Cresult"): None, (1, "max_glu_serum"): "non_numeric", (1, "A1Cresult"): None, (2, "A1Cresult"): None, (3, "max_glu_serum"): None}
    assert {r.id for r in records.lab_observations(df).where("row_id = 0").collect()} == {"obs-0-max_glu_serum", "obs-0-A1Cresult"}


def test_vital_ranges(spark):
    rows = [(1, 50.0, 500.0, 35.0, 100.0), (1, 49.9, 1.0, 42.1, 100.1), (1, 250.0, None, 42.0, 50.0), (1, float("nan"), None, float("inf"), 49.0)]
    df = frame(spark, rows, "patient_nbr long, systolic_bp double, heart_rate double, temperature double, spo2 double")
    bad = {(r.row_id, r.code) for r in records.vital_observations(df).where("error_code = 'out_of_range'").collect()}
    assert bad == {(1, "systolic_bp"), (1, "temperature"), (1, "spo2"), (3, "temperature"), (3, "spo2")}
    more = {(r.row_id, r.code) for r in records.vital_observations(df, extended_codes=True).where("error_code is not null").collect()}
    assert more - bad == {(0, "heart_rate"), (1, "heart_rate")}


def test_first_matching_code_wins(spark):
    df = spark.createDataFrame([("Pulse-temp", 210.0), ("my_hr", 20.0), ("body.temp", 20.0), ("SBP", 251.0), ("glucose", 1e9)], "code string, value double")
    got = [r[0] for r in df.select(records.vital_out_of_range(F.col("code"), F.col("value"))).collect()]
    assert got == [True, True, True, True, False]


def test_summary(spark):
    df = frame(spark, [(1, "male", "2999-01-01", "x"), (2, "male", None, "60")], "patient_nbr long, gender string, birthDate string, spo2 string")
    s = records.summary(df, today=F.lit("2026-01-01").cast("date")).first()
    assert (s.patients_validated, s.patient_errors, s.observations_validated, s.observation_errors) == (1, 1, 1, 1)
    assert s.example == "Patient row 0: future birth date"
    none = records.summary(df.select(ROW_ID)).first()
    assert none.patients_validated == 0 and none.example is None


def test_struct_constraints(spark):
    rows = [("o1", "final", "c", "s", (1.0, "u", "c"), None), (None, "final", "c", "s", None, None), ("o2", "done", "c", "s", None, None), ("o3", "final", "c", "s", (1.0, None, "c"), None)]
    df = spark.createDataFrame(rows, records.OBSERVATION)
    assert [r.error_code for r in records.validate(df, records.observation_errors()).collect()] == [None, "missing_id", "bad_status", "incomplete_quantity"]


def test_one_scan_for_all_records(spark, sf_dir):
    """The counters agree with the long table, and neither reads the input twice."""
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    k = F.col("c_custkey")
    df = c.select(k.alias(ROW_ID), k.alias("patient_nbr"), F.lit("male").alias("gender"), F.when(k % 3 == 0, "2020-02-30").alias("birthDate"), F.when(k % 2 == 0, "x").alias("A1Cresult"), (k % 400).cast("double").alias("systolic_bp"), F.when(k % 7 != 0, "99").alias("spo2"))
    long, short = records.validated(df), records.summary(df)
    for frame_ in (long, records.errors(long), short):
        assert frame_._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    s, rows = short.first(), long.collect()
    assert s.patients_validated == sum(r.kind == "patient" and r.error_code is None for r in rows) and s.patient_errors == sum(r.kind == "patient" and r.error_code is not None for r in rows)
    assert s.observations_validated == sum(r.kind != "patient" and r.error_code is None for r in rows) and s.observation_errors == sum(r.kind != "patient" and r.error_code is not None for r in rows)
    assert s.example == records.errors(long).orderBy("ordinal").first().message
