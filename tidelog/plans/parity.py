"""Batch and stream metrics of one input, compared key by key."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.columns import strip
from tidelog.operators.aggregates import minute_facts
from tidelog.operators.parity import compare_metrics, compare_values, metric_values
from tidelog.operators.window import recent_window
from tidelog.schema import WINDOW_SECONDS
from tidelog.session import build_session, configure, scratch_path, stage
from tidelog.sources.event_table import EventTable
from tidelog.sources.logs import read_lines


def stream_side_events(replayed: DataFrame) -> DataFrame:
    """What the window accepts of replayed events: trimmed endpoints that are not blank."""
    events = replayed.withColumn("endpoint", strip(F.col("endpoint")))
    return events.filter(F.col("endpoint") != "")


def batch_stream_values(table: EventTable, window_seconds: int = WINDOW_SECONDS) -> DataFrame:
    """Both sides of every comparable value of one stored log."""
    batch = metric_values(minute_facts(table.events()))
    window = recent_window(stream_side_events(table.replayed()), window_seconds)
    return compare_values(batch, metric_values(minute_facts(window)))


def run_parity(spark: SparkSession, source: str, window_seconds: int = WINDOW_SECONDS) -> bool:
    """Compare both sides of a log; its text is read once, into a scratch event table."""
    configure(spark)
    table = EventTable(spark, scratch_path(spark, "parity"))
    table.write(read_lines(spark, source))
    checked = stage(compare_metrics(batch_stream_values(table, window_seconds)), "parity-checked")
    checked.show(truncate=False)
    return checked.agg(F.bool_and("match")).first()[0]


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True)
    parser.add_argument("--window-seconds", type=int, default=WINDOW_SECONDS)
    arguments = parser.parse_args()
    spark = build_session("tidelog-parity")
    sys.exit(0 if run_parity(spark, arguments.input, arguments.window_seconds) else 1)


if __name__ == "__main__":
    main()
