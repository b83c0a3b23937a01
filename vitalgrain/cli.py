"""Command line: `quality` prints a profile, `pipeline` validates and writes reports."""

from __future__ import annotations

import argparse
from pathlib import Path

from .config import Settings, load_settings
from .plans.workflow import run_pipeline, run_quality
from .session import session

DEFAULT_CONFIG = "config/config.yaml"


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="vitalgrain", description="Profiles clinical tables and checks them with rules, on Spark.")
    commands = out.add_subparsers(dest="command", required=True)
    quality = commands.add_parser("quality", help="print the profile of a table")
    pipeline = commands.add_parser("pipeline", help="validate a table and write reports")
    for p in (quality, pipeline):
        p.add_argument("--data", required=True, help="CSV or Parquet")
        p.add_argument("--config", help=f"YAML settings; {DEFAULT_CONFIG} if it exists")
    pipeline.add_argument("--output", default="./output", help="folder for the reports")
    pipeline.add_argument("--results", help="shared folder for all violations and errors")
    pipeline.add_argument("--outliers", action="store_true", help="also mark values outside the fences that the settings describe")
    return out


def _settings(path: str | None) -> Settings:
    if path is None and not Path(DEFAULT_CONFIG).exists():
        return Settings()
    return load_settings(path or DEFAULT_CONFIG)


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    settings = _settings(args.config)
    spark = session()
    if args.command == "quality":
        return run_quality(spark, args.data, settings)
    return run_pipeline(spark, args.data, settings, args.output, results_path=args.results, outliers=args.outliers)
