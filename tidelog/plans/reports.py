"""The SQL layer over stored batch results: a database, its views and the reports."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators.reports import REPORTS, create_views, report_sql, run_report
from tidelog.plans.sinks import write_table
from tidelog.session import build_session, configure
from tidelog.sources.tables import create_database, read_batch_tables


def report_tables(
    spark: SparkSession, results: str, database: str | None = None, file_format: str = "parquet"
) -> dict[str, DataFrame]:
    """Every report over the batch results in a folder.

    With a database the result folders are catalogued under its name, with the two views,
    and the reports read them from there; other SQL clients of the catalog can then do the
    same. Nothing is copied: the tables are the folders.
    """
    configure(spark)
    if database is not None:
        create_database(spark, database, results, file_format)
        create_views(spark, database)
        return {name: spark.sql(report_sql(name, database)) for name in REPORTS}
    tables = read_batch_tables(spark, results, file_format)
    tables["endpoint_historical_summary"] = run_report(spark, "endpoint_historical_summary", tables)
    return {name: run_report(spark, name, tables) for name in REPORTS}


def run_reports(
    spark: SparkSession,
    results: str,
    output: str,
    names: Sequence[str] = tuple(REPORTS),
    database: str | None = None,
    file_format: str = "parquet",
    output_format: str = "csv",
) -> bool:
    """Write the named reports below ``output``; whether all totals of the results agree."""
    tables = report_tables(spark, results, database, file_format)
    for name in names:
        write_table(tables[name], f"{output}/{name}", output_format)
    checks = tables["reconcile_batch"]
    return checks.filter(F.col("validation_status") != "PASS").limit(1).count() == 0


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True, help="output of the batch job")
    parser.add_argument("--output", required=True)
    parser.add_argument("--report", action="append", choices=sorted(REPORTS), help="may be repeated; all if not given")
    parser.add_argument("--database", help="catalogue the results under this name")
    parser.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    parser.add_argument("--output-format", default="csv", choices=["parquet", "csv"])
    arguments = parser.parse_args()
    agree = run_reports(
        build_session("tidelog-reports"),
        arguments.input,
        arguments.output,
        arguments.report or tuple(REPORTS),
        arguments.database,
        arguments.format,
        arguments.output_format,
    )
    sys.exit(0 if agree else 1)


if __name__ == "__main__":
    main()
