import numpy as np
import pandas as pd
import pytest

from vitalgrain.operators import profile

SCHEMA = "i long, d double, s string, b boolean, bn boolean, none string"
ROWS = [(1, 1.5, "a", True, None, None), (2, float("nan"), "b", False, True, None), (None, None, None, True, True, None), (4, 2.5, "a", True, False, None)]


@pytest.fixture(scope="module")
def mixed(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_missing(mixed):
    rows = profile.missing_summary(mixed).collect()
    assert [(r.column_name, r.missing_count, r.missing_ratio) for r in rows] == [("none", 4, 1.0), ("d", 2, 0.5), ("i", 1, 0.25), ("s", 1, 0.25), ("bn", 1, 0.25), ("b", 0, 0.0)]
    assert profile.worst_column(profile.missing_summary(mixed)).first().column_name == "none"
    assert [r.column_name for r in profile.exclusion_candidates(profile.missing_summary(mixed), 0.5).collect()] == ["none", "d"]
    assert profile.completeness(profile.missing_summary(mixed)).first()[0] == 62.5


def test_worst_column_is_the_first_of_equals(spark):
    df = spark.createDataFrame([(None, None)], "a int, b int")
    assert profile.worst_column(profile.missing_summary(df)).first().column_name == "a"


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert {r.missing_ratio for r in profile.missing_summary(df).collect()} == {None}
    assert [r["count"] for r in profile.numeric_summary(df).collect()] == [0, 0]
    assert profile.categorical_summary(df).count() == 0
    assert profile.completeness(profile.missing_summary(df)).first()[0] is None


def test_numeric(spark, mixed):
    want = pd.DataFrame(ROWS, columns=["i", "d", "s", "b", "bn", "none"])[["i", "d"]].astype(float).describe().T
    for r in profile.numeric_summary(mixed).collect():
        w = want.loc[r.column_name]
        assert [r["count"], r.mean, r.std, r.min, r.p25, r.p50, r.p75, r.max] == pytest.approx([w["count"], w["mean"], w["std"], w["min"], w["25%"], w["50%"], w["75%"], w["max"]])
    one = profile.numeric_summary(spark.createDataFrame([(3,)], "x int")).first()
    assert one.std is None and one.p25 == 3
    assert profile.numeric_summary(spark.createDataFrame([("a",)], "x string")).count() == 0


@pytest.mark.parametrize(("accuracy", "gather"), [(8, 10), (50, 0), (10_000, 50_000)])
def test_quartiles_are_exact(spark, monkeypatch, accuracy, gather):
    """Few and many rounds; ties, infinities, zeros of both signs, and columns that share every scan."""
    if gather <= 10:
        monkeypatch.setattr(profile, "BINS", 4)
    frame = pd.DataFrame({
        "a": [(i * 7919 % 1000) ** 2 / 3 for i in range(800)] + [5.0] * 200 + [1e12],
        "ties": [float(i % 3) for i in range(1001)],
        "one": [7.5] * 1001,
        "wide": [(-1) ** i * 10.0 ** (i % 300) for i in range(1001)],
        "zeros": [0.0, -0.0] * 500 + [1.0],
        "ends": [float("inf")] * 300 + [float("-inf")] * 300 + [float(i) for i in range(401)],
    })
    df = spark.createDataFrame(frame).repartition(5)
    got = {r.column_name: r for r in profile.numeric_summary(df, accuracy, gather).collect()}
    for name in frame:
        want = np.sort(frame[name])  # 1001 rows: every quartile is a value
        assert [got[name].p25, got[name].p50, got[name].p75] == [want[250], want[500], want[750]], name
    half = profile.numeric_summary(df.where("a < 5").select("a"), accuracy, gather).first()
    few = frame["a"][frame["a"] < 5]
    assert [half.p25, half.p50, half.p75] == pytest.approx(list(few.quantile([0.25, 0.5, 0.75])))


def test_categorical(spark):
    df = spark.createDataFrame([(x,) for x in ["b", "a", "b", "a", None, "c"]], "s string")
    assert [(r.value, r["count"], r["rank"]) for r in profile.categorical_summary(df, 3).collect()] == [("a", 2, 1), ("b", 2, 2), ("c", 1, 3)]
    assert profile.distinct_counts(df).first().distinct_values == 4


def test_order_does_not_matter(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/customer.parquet")
    for f in (profile.missing_summary, profile.categorical_summary):
        assert f(df).collect() == f(df.repartition(7).orderBy("c_name")).collect()


def test_odd_column_names(spark):
    df = spark.createDataFrame([(1, None)], "`a.b` int, `c d``e` string")
    assert [r.column_name for r in profile.missing_summary(df).collect()] == ["c d`e", "a.b"]
    assert profile.numeric_summary(df).first().column_name == "a.b"


def test_footers_tell_what_is_missing(spark, tmp_path):
    """No page of a text or integer column is read, NaN counts as missing, and files of several row groups and none are one table."""
    rows = [(i, None if i % 3 else "x", float("nan") if i % 5 == 0 else None if i % 7 == 0 else 1.5, None, i % 2 == 0, [1] if i % 4 else None) for i in range(1000)]
    df = spark.createDataFrame(rows, "i long, s string, `d.x` double, n int, b boolean, a array<int>")
    path = str(tmp_path / "t.parquet")
    df.repartition(3).write.option("parquet.block.size", 1024).parquet(path)
    df.limit(0).write.mode("append").parquet(path)
    assert profile.missing_summary_of_parquet(spark, path).collect() == profile.missing_summary(df).collect()
    plan = profile.footer_counts(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), COUNT(i), COUNT(s), COUNT(n), COUNT(b)]" in plan
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")
    read = profile.missing_summary_of_parquet(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet [d.x" in read and "s#" not in read[read.index("FileScan") :].split("Batched")[0]
