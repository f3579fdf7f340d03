"""Clean four CSV tables and write every report.

    python -m tidemark INPUT OUTPUT [--as-of 2025-01-31] [--format csv] [--single-line]

INPUT holds customers.csv, subscriptions.csv, usage.csv and tickets.csv (files or folders).
"""

from __future__ import annotations

import argparse
from datetime import date

from tidemark.operators.cleaning import clean_all
from tidemark.plans.reports import write_all
from tidemark.session import build_session
from tidemark.sources.readers import load_tables
from tidemark.sources.staging import released


def main() -> None:
    parser = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    parser.add_argument("input")
    parser.add_argument("output")
    parser.add_argument("--as-of", type=date.fromisoformat, default=None, help="day that tenure counts to")
    parser.add_argument("--format", choices=("parquet", "csv"), default="parquet", help="of the reports")
    parser.add_argument("--single-line", action="store_true", help="no quoted text of the input holds a line break")
    arguments = parser.parse_args()

    spark = build_session()
    names = ("customers", "subscriptions", "usage", "tickets")
    raw = load_tables(spark, {name: f"{arguments.input}/{name}.csv" for name in names}, multi_line=not arguments.single_line)
    with released(spark):
        paths = write_all(spark, clean_all(raw), arguments.output, arguments.as_of, arguments.format)
    for name, path in paths.items():
        print(f"{name}: {path}")


if __name__ == "__main__":
    main()
