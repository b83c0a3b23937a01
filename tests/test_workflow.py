import csv
import logging

import pytest

from vitalgrain import cli
from vitalgrain.config import Settings, load_settings, settings_from
from vitalgrain.plans import workflow
from vitalgrain.plans.report import ReportWriter, missing_chart

ROWS = "patient_id,patient_nbr,gender,age,glucose,sex,<b>\n1,1,male,5,400,M,\n1,1,x,45,1,F,\n2,2,female,30,NA,F,\n3,3,other,72,2,M,\n"


@pytest.fixture
def table(tmp_path):
    p = tmp_path / "t.csv"
    p.write_text(ROWS)
    return str(p)


def test_settings(tmp_path):
    p = tmp_path / "c.yaml"
    p.write_text("quality:\n  missing:\n    critical_threshold: 0.9\nlogging:\n  level: DEBUG\n")
    s = load_settings(p)
    assert (s.quality.missing.critical_threshold, s.quality.missing.warning_threshold, s.logging.level) == (0.9, 0.0, "DEBUG")
    assert settings_from(None) == Settings()
    with pytest.raises(ValueError, match="quality.nope"):
        settings_from({"quality": {"nope": 1}})


def test_quality(spark, table, capsys):
    assert workflow.run_quality(spark, table, Settings(), logging.getLogger("t")) == 0
    out = capsys.readouterr().out
    assert "Candidates for exclusion" in out and "Values of gender" in out and "<b>\t4\t1.0" in out


def test_pipeline(spark, table, tmp_path, caplog):
    out = tmp_path / "out"
    seen = []
    with caplog.at_level("INFO", "t"):
        assert workflow.run_pipeline(spark, table, Settings(), out, logging.getLogger("t"), lambda df: seen.append(df.columns)) == 0
    rows = list(csv.reader((out / "missing_summary.csv").open()))
    assert rows[0] == ["", "missing_count", "missing_ratio"] and rows[1] == ["<b>", "4", "1.0"] and len(rows) == 8
    html = (out / "quality_report.html").read_text()
    assert "&lt;b&gt;" in html and "<b></td>" not in html and "ClinicalCoherenceRule" in html and "First: 0" in html
    assert "row_id" not in html and seen and "row_id" not in seen[0]
    assert "PDF report skipped" in caplog.text or (out / "quality_report.pdf").exists()


def test_cli(spark, table, tmp_path, monkeypatch, capsys):
    monkeypatch.chdir(tmp_path)
    assert cli.main(["quality", "--data", table]) == 0
    assert cli.main(["pipeline", "--data", table, "--output", str(tmp_path / "o")]) == 0
    with pytest.raises(SystemExit):
        cli.main([])


def test_logger_once(tmp_path):
    assert len(workflow.logger_for("once", "info", tmp_path).handlers) == len(workflow.logger_for("once", "info", tmp_path).handlers) == 2


def test_chart():
    assert missing_chart([{"column_name": "a", "missing_count": 0}]) == ""
    assert "&amp;" in missing_chart([{"column_name": "a&b", "missing_count": 2}])


def test_pdf_needs_a_converter(tmp_path):
    try:
        import weasyprint  # noqa: F401
    except (ImportError, OSError):
        with pytest.raises(RuntimeError):
            ReportWriter().write_pdf(tmp_path / "a.html", tmp_path / "a.pdf")


def test_stream(spark, sf_dir, tmp_path):
    from vitalgrain.operators import profile
    from vitalgrain.streaming.ingest import missing_counts_stream, missing_summary_so_far

    e = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr("event_id", "nullif(event_type, 'error') as t")
    e.repartition(3).write.parquet(str(tmp_path / "in"))
    missing_counts_stream(spark, str(tmp_path / "in"), e.schema, str(tmp_path / "counts"), str(tmp_path / "chk")).awaitTermination(60)
    columns = ["position", "column_name", "missing_count", "missing_ratio", "rows"]
    assert missing_summary_so_far(spark, str(tmp_path / "counts")).select(columns).collect() == profile.missing_summary(e).select(columns).collect()


def test_one_scan_for_all_that_is_counted(spark, sf_dir):
    from pyspark.sql import functions as F

    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    k = F.col("c_custkey")
    df = c.select(k.alias("row_id"), k.alias("patient_nbr"), F.lit("male").alias("gender"), (k % 130).alias("age"), F.lit("400").alias("glucose"), F.when(k % 2 == 0, "x").alias("A1Cresult"), (k % 400).cast("double").alias("systolic_bp"))
    row = workflow.measured_row(df)[0]
    plan = row._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and row.count() == 1
    found = workflow.validate(df)
    assert found["missing"].count() == 6 and {r.rule: r.affected_rows > 0 for r in found["findings"].collect()} == {"ClinicalCoherenceRule": True, "VitalSignAnomalyRule": False, "MissingDataThresholdRule": False}
    assert found["records"].first().patients_validated == c.count()


def test_results_are_whole_and_single(spark, tmp_path, monkeypatch):
    """Written again they are replaced; a run that is killed before its commit changes nothing, and leaves nothing after the next."""
    from vitalgrain.sources import results

    path = str(tmp_path / "r")
    with pytest.raises(FileNotFoundError):
        results.read_results(spark, path, "t")

    def table(n):
        return {"t": spark.range(n).selectExpr("id % 2 as part", "id")}

    def rows():
        return sorted(r.id for r in results.read_results(spark, path, "t").collect())

    for n in (5, 3):
        results.write_results(table(n), path, {"t": "part"})
        assert rows() == list(range(n)) and results.read_results(spark, path, "t").columns == ["part", "id"]
    with monkeypatch.context() as m:
        m.setattr(results, "_commit", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            results.write_results(table(9), path, {"t": "part"})
    assert rows() == [0, 1, 2] and len([p for p in (tmp_path / "r").iterdir() if p.name.startswith("run-")]) == 2
    results.write_results(table(4), path, {"t": "part"})
    assert rows() == [0, 1, 2, 3] and len([p for p in (tmp_path / "r").iterdir() if p.name.startswith("run-")]) == 1
    results.write_results(table(0), path)
    assert rows() == []


def test_pipeline_keeps_all_violations(spark, tmp_path):
    from vitalgrain.sources.results import read_results

    p = tmp_path / "t.csv"
    p.write_text("patient_nbr,gender,age,creatinine,spo2\n" + "".join(f"{i},male,70,9,{i}\n" for i in range(50)))
    at = str(tmp_path / "results")
    assert workflow.run_pipeline(spark, str(p), Settings(), tmp_path / "out", logging.getLogger("t"), results_path=at) == 0
    found = read_results(spark, at, "violations")
    assert found.where("rule = 'ClinicalCoherenceRule'").count() == 50 and read_results(spark, at, "errors").where("kind = 'vital'").count() == 50


def test_quality_of_parquet(spark, sf_dir, capsys):
    assert workflow.run_quality(spark, f"{sf_dir}/customer.parquet", Settings(), logging.getLogger("t")) == 0
    out = capsys.readouterr().out
    assert "c_mktsegment\tstring" in out and "Values of c_mktsegment" in out and "c_acctbal\t0\t0.0" in out


def test_settings_of_outliers_have_an_effect(spark, tmp_path):
    from vitalgrain.sources.results import read_results

    p = tmp_path / "t.csv"
    p.write_text("k,v\n" + "".join(f"{i},{10 + i % 5}\n" for i in range(40)) + "40,17\n")
    found = []
    for multiplier in (1.5, 9.0):
        at = str(tmp_path / str(multiplier))
        settings = settings_from({"outliers": {"iqr_multiplier": multiplier}})
        assert workflow.run_pipeline(spark, str(p), settings, tmp_path / "out", logging.getLogger("t"), results_path=at, outliers=True) == 0
        found.append([(r.row_id, r.column_name) for r in read_results(spark, at, "violations").where("rule = 'IqrOutlierRule'").collect()])
    assert found == [[(40, "v")], []]
    with pytest.raises(ValueError, match="method"):
        workflow.outlier_rule(settings_from({"outliers": {"method": "z"}}))
