import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vitalgrain.functions import expressions as e


def values(spark, rows, kind, expr):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [r[0] for r in df.select("i", expr.alias("y")).orderBy("i").select("y").collect()]


def test_to_number(spark):
    texts = ["1", " 2.5 ", "1.5d", "1f", "0x1p3", "1_000", "-inf", "Infinity", "nan", "", None, "1e3", "abc", ".5", "5."]
    want = [1, 2.5, None, None, None, None, float("-inf"), float("inf"), None, None, None, 1000, None, 0.5, 5]
    assert values(spark, texts, "string", e.to_number("x")) == want


def test_parsed_float(spark):
    texts = ["1_000", "1__0", "_1", "inf", "x", " 7 ", "1.5d", None]
    assert values(spark, texts, "string", e.parsed_float("x")) == [1000, None, None, float("inf"), None, 7, None, None]
    assert values(spark, ["nan"], "string", F.isnan(e.parsed_float("x"))) == [True]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(alphabet="0123456789+-._eEinfa x", max_size=8), min_size=1, max_size=30))
def test_parsed_float_is_pythons(spark, texts):
    def python(t):
        try:
            return float(t)
        except ValueError:
            return None

    got = values(spark, texts, "string", e.parsed_float("x"))
    assert [None if g is None else str(g) for g in got] == [None if (p := python(t)) is None else str(p) for t in texts]


def test_gender(spark):
    assert values(spark, [" Male ", "FEMALE", "M", None, "x", "other"], "string", e.normalised_gender("x")) == ["male", "female", "unknown", "unknown", "unknown", "other"]
    assert values(spark, ["M", "f"], "string", e.normalised_gender("x", {"m": "male", "f": "female"})) == ["male", "female"]


def test_age_years(spark):
    born = [dt.date(2000, 2, 29), dt.date(2000, 3, 1), dt.date(1990, 2, 28), None, dt.date(2023, 2, 28)]
    assert values(spark, born, "date", e.age_years("x", F.lit("2023-02-28").cast("date"))) == [22, 22, 33, None, 0]


@pytest.mark.parametrize(
    ("text", "good"),
    [
        ("2020-01-02", True), ("2020-01-02T00:00:00", True), ("2020-01-02 00:00:00", True), ("2020-01-02T00:00", True), ("2020-01-02T00:00:00Z", True),
        ("2020-01-02T10:00:00", False), ("2020-1-2", False), (" 2020-01-02", False), ("2020-01", False), ("01/02/2020", False), ("2020-02-30", False),
        ("1577923200", True), ("1577923200000", True), ("1577923201", False),
    ],
)
def test_birth_dates(spark, text, good):
    assert values(spark, [text], "string", e.parsed_birth_date("x")) == [dt.date(2020, 1, 2) if good else None]


def test_birth_date_epochs(spark):
    assert values(spark, ["0", "86400", "86400.0"], "string", e.parsed_birth_date("x")) == [dt.date(1970, 1, 1), dt.date(1970, 1, 2), dt.date(1970, 1, 2)]


def test_status_bucket(spark):
    assert values(spark, [0.0, 10.0, 10.1, 30.0, 30.1], "double", e.status_bucket(F.col("x"))) == ["LOW", "LOW", "MODERATE", "MODERATE", "HIGH"]


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (400.0,), (None,)], "x double")
    assert e.missing_normalised(df).where("x > 300").count() == 1
