"""Report sinks. Everything here works on small aggregates that Spark has already made."""

from __future__ import annotations

import csv
import logging
from collections.abc import Mapping, Sequence
from datetime import datetime
from html import escape
from pathlib import Path
from typing import Any

_STYLE = "body{font:15px/1.5 sans-serif;max-width:60rem;margin:2rem auto;color:#222}table{border-collapse:collapse;width:100%}td,th{border-bottom:1px solid #ccc;padding:.3rem .6rem;text-align:left}.HIGH{color:#a30}.MODERATE{color:#860}.LOW{color:#063}.bad{background:#fee;padding:.6rem}.good{background:#efe;padding:.6rem}"


def write_missing_csv(rows: Sequence[Mapping[str, Any]], path: str | Path) -> None:
    """The missing-value summary; the first header is empty, as the column names stand under it."""
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f)
        out.writerow(["", "missing_count", "missing_ratio"])
        out.writerows([r["column_name"], r["missing_count"], r["missing_ratio"]] for r in rows)


def missing_chart(rows: Sequence[Mapping[str, Any]]) -> str:
    """Bars of missing counts as inline SVG; nothing if no cell is missing."""
    most = max((r["missing_count"] for r in rows), default=0)
    if not most:
        return ""
    bars = []
    for i, r in enumerate(rows):
        width = round(420 * r["missing_count"] / most, 1)
        y = 26 * i
        bars.append(f'<text x="190" y="{y + 15}" text-anchor="end">{escape(str(r["column_name"]))}</text><rect x="200" y="{y + 2}" width="{width}" height="18" fill="#36c"/><text x="{205 + width}" y="{y + 15}">{r["missing_count"]}</text>')
    return f'<svg xmlns="http://www.w3.org/2000/svg" width="720" height="{26 * len(rows) + 4}" font-size="13" role="img" aria-label="Missing values by column">{"".join(bars)}</svg>'


def _table(head: Sequence[str], rows: Sequence[Sequence[Any]]) -> str:
    cells = "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows)
    return f"<table><thead><tr>{''.join(f'<th>{escape(h)}</th>' for h in head)}</tr></thead><tbody>{cells}</tbody></table>"


def _missing_section(rows: Sequence[Mapping[str, Any]]) -> str:
    if not any(r["missing_count"] for r in rows):
        return '<p class="good">No missing data.</p>'
    return _table(["Column", "Missing", "Missing %", "Status"], [(escape(r["column_name"]), r["missing_count"], f"{round(r['missing_pct'], 2):.2f}", f'<b class="{r["status"]}">{r["status"]}</b>') for r in rows])


def _rules_section(findings: Sequence[Mapping[str, Any]], first: Mapping[str, Sequence[Any]]) -> str:
    if not findings:
        return '<p class="good">No rule was run.</p>'
    out = []
    for f in findings:
        name = escape(f["rule"])
        if f["affected_rows"]:
            shown = ", ".join(escape(str(x)) for x in first.get(f["rule"], ()))
            out.append(f'<h3>{name}</h3><div class="bad"><b>{f["affected_rows"]} violations</b>, severity {escape(f["severity"])}<br>First: {shown}</div>')
        else:
            out.append(f'<h3>{name}</h3><p class="good">No violations.</p>')
    return "".join(out)


def _records_section(summary: Mapping[str, Any] | None) -> str:
    if summary is None:
        return "<p>Records were not validated.</p>"
    names = ("patients_validated", "patient_errors", "observations_validated", "observation_errors")
    table = _table(["Metric", "Value"], [(n.replace("_", " "), summary[n]) for n in names])
    example = summary["example"]
    return table + (f'<p class="bad">Example: {escape(example)}</p>' if example else '<p class="good">No record fails.</p>')


class ReportWriter:
    """Renders the quality report. `now` may be set for reproducible output."""

    def __init__(self, logger: logging.Logger | None = None, now: datetime | None = None):
        self.logger, self.now = logger or logging.getLogger(__name__), now

    def html(self, rows: int, columns: int, completeness_pct: float | None, missing: Sequence[Mapping[str, Any]] = (), top: Sequence[Mapping[str, Any]] = (), findings: Sequence[Mapping[str, Any]] = (), first: Mapping[str, Sequence[Any]] | None = None, records: Mapping[str, Any] | None = None) -> str:
        made = (self.now or datetime.now()).strftime("%Y-%m-%d %H:%M:%S")
        complete = "-" if completeness_pct is None else f"{completeness_pct}%"
        chart = missing_chart(top)
        body = [
            "<h1>Clinical data quality</h1>",
            _table(["Date", "Records", "Columns", "Completeness"], [(made, rows, columns, complete)]),
            "<h2>Missing data</h2>", _missing_section(missing), f"<h3>Most missing columns</h3>{chart}" if chart else "",
            "<h2>Clinical rules</h2>", _rules_section(findings, first or {}),
            "<h2>Patient and observation records</h2>", _records_section(records),
        ]
        return f'<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>Clinical data quality</title><style>{_STYLE}</style></head><body>{"".join(body)}</body></html>'

    def write_html(self, path: str | Path, **parts: Any) -> None:
        Path(path).write_text(self.html(**parts), encoding="utf-8")
        self.logger.info("HTML report written to %s", path)

    def write_pdf(self, html_path: str | Path, pdf_path: str | Path) -> None:
        """Converts the HTML; RuntimeError where no converter is installed."""
        try:
            from weasyprint import HTML
        except (ImportError, OSError) as e:
            self.logger.error("No PDF converter: %s", e)
            raise RuntimeError("weasyprint is needed for PDF reports") from e
        HTML(str(html_path)).write_pdf(str(pdf_path))
        self.logger.info("PDF report written to %s", pdf_path)
