"""The historical job: raw lines to result tables, data quality and rejected lines."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.columns import minute
from tidelog.operators.aggregates import add_up, batch_metrics, endpoint_summary
from tidelog.operators.parse import data_quality, rejected_breakdown, rejected_sample
from tidelog.plans.sinks import write_batch_results, write_data_quality, write_rejected, write_table
from tidelog.schema import REJECTED_SAMPLE_SIZE
from tidelog.session import build_session, configure
from tidelog.sources.event_table import VALID, EventTable
from tidelog.sources.logs import read_lines


def line_facts(lines: DataFrame) -> DataFrame:
    """Minute facts of the valid lines and counts of the rejected ones, in one grouping.

    ``lines`` are those of an event table. Valid rows have no ``reason``; rejected rows
    have nothing else. The stored lines are read once for all aggregates and all quality
    figures.
    """
    reason = F.when(F.col("kind") != VALID, F.col("kind"))
    rows = lines.select(
        reason.alias("reason"),
        "endpoint",
        minute(F.col("timestamp")).alias("minute"),
        "status_code",
        F.lit(1).cast("bigint").alias("requests"),
        "response_bytes",
        F.col("timestamp").alias("latest"),
    )
    return add_up(rows, "reason")


def facts_of(line_facts_table: DataFrame) -> DataFrame:
    return line_facts_table.filter(F.col("reason").isNull()).drop("reason")


def run_batch(
    spark: SparkSession,
    source: str,
    output: str,
    file_format: str = "parquet",
    ordered: bool = False,
    single_file: bool = False,
    sample_size: int = REJECTED_SAMPLE_SIZE,
    repeatable_sample: bool = True,
    gather_hours: bool = False,
) -> None:
    """Write all ten result tables below ``output``, plus those they come from: the event
    table, the facts and the endpoint summary.

    The text is read and parsed once, into the event table; everything else starts there.
    A repeatable sample sorts all rejected lines, which are partitions of their own;
    otherwise Spark stops at the first ones it finds.
    """
    configure(spark)
    table = EventTable(spark, f"{output}/events")
    table.write(read_lines(spark, source), gather=gather_hours)
    write_table(line_facts(table.lines()), f"{output}/line_facts")
    stored = spark.read.parquet(f"{output}/line_facts")

    facts = facts_of(stored)
    write_table(endpoint_summary(facts), f"{output}/endpoint_summary")
    summary = spark.read.parquet(f"{output}/endpoint_summary")
    write_batch_results(
        batch_metrics(facts, summary), output, file_format, ordered, single_file
    )
    write_data_quality(data_quality(stored), output, file_format)
    rejected = table.rejected()
    if repeatable_sample:
        sample = rejected_sample(rejected, sample_size)
    else:
        sample = rejected.limit(sample_size)
    write_rejected(rejected_breakdown(stored), sample, output, file_format)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    parser.add_argument("--ordered", action="store_true")
    parser.add_argument("--single-file", action="store_true")
    parser.add_argument("--any-sample", action="store_true")
    parser.add_argument("--gather-hours", action="store_true", help="for a log in no order of time")
    arguments = parser.parse_args()
    run_batch(
        build_session("tidelog-batch"),
        arguments.input,
        arguments.output,
        arguments.format,
        arguments.ordered,
        arguments.single_file,
        repeatable_sample=not arguments.any_sample,
        gather_hours=arguments.gather_hours,
    )


if __name__ == "__main__":
    main()
