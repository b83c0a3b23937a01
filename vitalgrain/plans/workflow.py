"""The two workflows of the command line: profile a table, and validate it with reports."""

from __future__ import annotations

import logging
from collections import defaultdict
from collections.abc import Callable
from datetime import datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Settings
from ..functions.expressions import quoted
from ..operators import profile, records, rules
from ..sources.results import read_results, write_results
from ..sources.tables import ROW_ID, CsvText, is_parquet, number_text, parsed, read_table, typed
from .report import ReportWriter, write_missing_csv

#: Numeric columns that the console profile shows.
NUMERIC_SHOWN = 5


def logger_for(name: str, level: str = "INFO", log_dir: str | Path = "logs") -> logging.Logger:
    """Logs to the console and to a dated file; handlers are added once for each name."""
    log = logging.getLogger(name)
    log.setLevel(level.upper())
    if not log.handlers:
        Path(log_dir).mkdir(parents=True, exist_ok=True)
        form = logging.Formatter("%(asctime)s - %(levelname)s - %(message)s")
        for handler in (logging.StreamHandler(), logging.FileHandler(Path(log_dir) / f"quality_{datetime.now():%Y%m%d_%H%M%S}.log", encoding="utf-8")):
            handler.setFormatter(form)
            log.addHandler(handler)
        log.propagate = False
    return log


def _log_missing(log: logging.Logger, worst: tuple[str, float] | None, settings: Settings) -> None:
    limits = settings.quality.missing
    if worst is None or worst[1] is None:
        return
    if worst[1] > limits.warning_threshold:
        log.warning("Missing values: up to %.2f, in column %s", worst[1], worst[0])
    if worst[1] > limits.critical_threshold:
        log.error("Critically many missing values: %.2f, in column %s", worst[1], worst[0])


def _show(title: str, rows: list[dict], names: list[str]) -> None:
    print(f"\n=== {title} ===")
    print("\t".join(names))
    for r in rows:
        print("\t".join("" if r[n] is None else str(r[n]) for n in names))


def _moments(df: DataFrame, names: list[str]) -> dict[str, profile.Moments]:
    found = df.agg(*(F.expr(m) for v in profile.number_sql(df, names) for m in profile.moment_measures(v))).first() if names else []
    return dict(zip(names, profile.moments_from(found)))


def _first_scan(spark: SparkSession, path: str) -> tuple[DataFrame, int, list[int], dict[str, profile.Moments]]:
    """The table, its rows, the missing values of each column and the moments of the numeric columns that are shown.

    For CSV all of it comes with the types; the first records tell which columns to take the moments of,
    and if they mislead, the moments are another scan.
    """
    if is_parquet(path):
        df = read_table(spark, path)
        missing = profile.missing_summary_of_parquet(spark, path).orderBy("position").collect()
        return df, missing[0]["rows"] if missing else 0, [r["missing_count"] for r in missing], _moments(df, profile.numeric_columns(df)[:NUMERIC_SHOWN])
    text = CsvText.of(spark, path)
    guessed = text.likely_numbers()[:NUMERIC_SHOWN]

    def measures(rows: DataFrame) -> list[str]:
        return [*(f"count({quoted(n)})" for n in rows.columns), *(m for n in guessed for m in profile.moment_measures(number_text(rows, n)))]

    rows, kinds, found = parsed(text, measures)
    df = typed(text, kinds)
    known = dict(zip(guessed, profile.moments_from(found[len(df.columns) :])))
    shown = profile.numeric_columns(df)[:NUMERIC_SHOWN]
    moments = {**known, **_moments(df, [n for n in shown if n not in known])}
    return df, rows, [rows - n for n in found[: len(df.columns)]], {n: moments[n] for n in shown}


def run_quality(spark: SparkSession, path: str, settings: Settings, log: logging.Logger | None = None) -> int:
    """Prints the profile of a table. One scan gives types, missing values and moments, the next quartiles and categories."""
    log = log or logger_for("vitalgrain", settings.logging.level, settings.logging.log_dir)
    log.info("Reading %s", path)
    df, rows, gone, moments = _first_scan(spark, path)
    q = settings.quality
    missing = sorted(({"position": i, "column_name": n, "missing_count": m, "missing_ratio": m / rows if rows else None, "rows": rows} for i, (n, m) in enumerate(zip(df.columns, gone))), key=lambda r: (-(r["missing_ratio"] or 0), r["position"]))
    log.info("%d rows, %d columns", rows, len(df.columns))
    _show("Overview", [{"rows": rows, "columns": len(df.columns)}], ["rows", "columns"])
    _show("Columns", [{"column": n, "type": t} for n, t in df.dtypes], ["column", "type"])
    _log_missing(log, (missing[0]["column_name"], missing[0]["missing_ratio"]) if missing else None, settings)
    _show("Missing values", missing[: q.missing.report_top_n_columns], ["column_name", "missing_count", "missing_ratio"])
    some_missing = {r["column_name"] for r in missing if r["missing_count"]}
    names = [n for n in profile.categorical_columns(df) if dict(df.dtypes)[n] != "boolean" or n in some_missing]
    numeric = list(moments) if q.numeric_summary.enabled else []
    numbers, values = profile.summaries(df, numeric, [moments[n] for n in numeric], names, q.categorical.report_top_n_values)
    if q.numeric_summary.enabled:
        if not numeric:
            log.warning("No numeric columns")
        shown = ["column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max"]
        _show("Numbers", [dict(zip(shown, r[1:])) for r in numbers], shown)
    candidates = [r for r in missing if r["missing_ratio"] is not None and r["missing_ratio"] >= q.missing.exclusion_candidate_threshold]
    for r in candidates:
        log.warning("Candidate for exclusion: %s (%.2f missing)", r["column_name"], r["missing_ratio"])
    _show("Candidates for exclusion", candidates, ["column_name", "missing_count", "missing_ratio"])
    top: dict[str, list[dict]] = defaultdict(list)
    for _, name, value, count, _ in values:
        top[name].append({"value": value, "count": count})
    for name in names:
        _show(f"Values of {name}", top[name], ["value", "count"])
    log.info("Profile complete")
    return 0


def outlier_rule(settings: Settings) -> rules.IqrOutliers:
    """The rule that the settings under `outliers` ask for. ValueError if they name a method that is not known."""
    given = settings.outliers
    if given.method != "iqr":
        raise ValueError(f"unknown method of outliers: {given.method}")
    return rules.IqrOutliers(given.iqr_multiplier, given.numeric_only)


def measured_row(df: DataFrame, more: tuple[rules.Rule, ...] = ()) -> tuple[DataFrame, rules.RuleRunner, dict, list[records.Cell]]:
    """One row with all that the validation counts by itself: missing values, the measures of the rules, the counters of the records. One scan."""
    runner = rules.RuleRunner([*rules.clinical_suite(rules.MissingThresholds(ignored=(ROW_ID,))), *more])
    cells = records.record_cells(df)
    parts = {"missing": profile.missing_measures(df.drop(ROW_ID)), "records": records.summary_measures(cells), **runner.measures(df)}
    return rules.measured(df, parts), runner, parts, cells


def validate(df: DataFrame, more: tuple[rules.Rule, ...] = ()) -> dict[str, DataFrame]:
    """The results of the validation: missing, findings, violations, errors, records. `df` has row numbers; `more` follows the suite's rules.

    All aggregates are one scan, which runs here; rules that need the table in another order run by
    themselves, and violations and errors are lazy.
    """
    spark = df.sparkSession
    row, runner, parts, cells = measured_row(df, more)
    known = spark.createDataFrame([row.first()], row.schema)
    names = [n for n in df.columns if n != ROW_ID]
    missing = known.select(*(c.alias(n) for n, c in rules.part_of(parts["missing"], "missing").items()))
    return {
        "missing": profile.missing_rows(missing, names),
        "findings": runner.run(df, known),
        "violations": rules.all_violations(runner.rules, df),
        "errors": records.errors(records.validated(df)).drop("ordinal"),
        "records": records.summary_of(known, cells, rules.part_of(parts["records"], "records")),
    }


def run_pipeline(spark: SparkSession, path: str, settings: Settings, output: str | Path, log: logging.Logger | None = None, transform: Callable[[DataFrame], DataFrame] = lambda df: df, results_path: str | None = None, outliers: bool = False) -> int:
    """Reads, validates, writes missing_summary.csv and the reports, and hands the table to `transform`. A failing report is logged, no more.

    All violations, by rule, and all records' errors, by kind, go to `results_path`, a folder that the
    cluster shares; a later run replaces them as a whole. `outliers` adds the rule that the settings describe.
    """
    log = log or logger_for("vitalgrain.pipeline", settings.logging.level, settings.logging.log_dir)
    log.info("Reading %s", path)
    df = read_table(spark, path, row_ids=True)
    results = validate(df, (outlier_rule(settings),) if outliers else ())
    missing = [r.asDict() for r in results["missing"].collect()]
    rows = missing[0]["rows"] if missing else 0
    log.info("%d rows from %s", rows, path)
    _log_missing(log, (missing[0]["column_name"], missing[0]["missing_ratio"]) if missing else None, settings)
    findings = [r.asDict() for r in results["findings"].collect()]
    for f in findings:
        (log.warning if f["affected_rows"] else log.info)("%s: %s", f["rule"], f["message"])
    violations = results["violations"]
    if results_path:
        write_results({"violations": violations, "errors": results["errors"]}, results_path, {"violations": "rule", "errors": "kind"})
        log.info("Violations and errors in %s", results_path)
        violations = read_results(spark, results_path, "violations")
    first: dict[str, list] = defaultdict(list)
    for r in rules.first_violations(violations).collect():
        first[r["rule"]].append(r["column_name"] if r["row_id"] is None else r["row_id"])
    found = results["records"].first().asDict()

    out = Path(output)
    out.mkdir(parents=True, exist_ok=True)
    write_missing_csv(missing, out / "missing_summary.csv")
    table = [r.asDict() for r in profile.missing_report(results["missing"]).collect()]
    percent = profile.completeness(results["missing"]).first()[0]
    top = [r.asDict() for r in profile.top_missing(results["missing"]).collect()]
    writer = ReportWriter(log)
    html = out / "quality_report.html"
    try:
        writer.write_html(html, rows=rows, columns=len(missing), completeness_pct=percent, missing=table, top=top, findings=findings, first=first, records=found)
    except Exception as e:  # noqa: BLE001
        log.error("HTML report failed: %s", e)
    try:
        writer.write_pdf(html, out / "quality_report.pdf")
    except RuntimeError as e:
        log.warning("PDF report skipped: %s", e)
    except Exception as e:  # noqa: BLE001
        log.error("PDF report failed: %s", e)
    transform(df.drop(ROW_ID))
    log.info("Pipeline complete")
    return 0
