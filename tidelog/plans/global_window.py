"""One recent window from all delta documents."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators import aggregates
from tidelog.operators.dedup import (
    aggregation_statistics,
    dedup_events,
    delta_events,
    unique_events,
)
from tidelog.operators.window import error_anomalies, recent_window, window_summary
from tidelog.plans.sinks import write_table
from tidelog.schema import (
    ERROR_RATE_THRESHOLD,
    MINIMUM_REQUESTS_FOR_ANOMALY,
    WINDOW_SECONDS,
)
from tidelog.session import build_session, configure, stage
from tidelog.sources.documents import read_documents
from tidelog.streaming.records import read_delta_table


def window_sections(
    facts: DataFrame,
    window_seconds: int,
    error_rate_threshold: float = ERROR_RATE_THRESHOLD,
    minimum_requests: int = MINIMUM_REQUESTS_FOR_ANOMALY,
) -> dict[str, DataFrame]:
    """All tables of a snapshot from the facts of a window. The per-endpoint ones are one."""
    endpoints = aggregates.endpoint_summary(facts).drop("avg_requests_per_minute")
    return {
        "window_summary": window_summary(facts, window_seconds),
        "endpoints": endpoints,
        "traffic_by_hour": aggregates.traffic_by_hour(facts),
        "status_code_distribution": aggregates.status_code_distribution(facts),
        "anomalies": error_anomalies(endpoints, error_rate_threshold, minimum_requests),
    }


def global_window(
    documents: DataFrame, window_seconds: int = WINDOW_SECONDS
) -> tuple[DataFrame, DataFrame]:
    """The classified events of all documents, and the window of the unique ones.

    Decoding and de-duplication each feed several results, so both are written to the
    shared folder once; a lost executor costs only its own tasks.
    """
    return _classify(stage(delta_events(documents), "decoded"), window_seconds)


def _classify(decoded: DataFrame, window_seconds: int) -> tuple[DataFrame, DataFrame]:
    classified = stage(dedup_events(decoded), "classified")
    return classified, recent_window(unique_events(classified), window_seconds)


def run_global(
    spark: SparkSession,
    source: str,
    output: str,
    window_seconds: int = WINDOW_SECONDS,
    error_rate_threshold: float = ERROR_RATE_THRESHOLD,
    minimum_requests: int = MINIMUM_REQUESTS_FOR_ANOMALY,
    pattern: str = "*.json",
    stored: bool = False,
) -> None:
    """Write the global snapshot: its sections, anomalies and statistics.

    ``source`` holds delta documents, or with ``stored`` the delta table of a stream job.
    """
    configure(spark)
    if stored:
        classified, window = _classify(read_delta_table(spark, source), window_seconds)
    else:
        documents = read_documents(spark, source, pattern)
        classified, window = global_window(documents, window_seconds)
    write_table(aggregates.minute_facts(window), f"{output}/facts")
    facts = spark.read.parquet(f"{output}/facts")
    sections = window_sections(facts, window_seconds, error_rate_threshold, minimum_requests)
    for name, table in sections.items():
        write_table(table, f"{output}/{name}")
    statistics = aggregation_statistics(classified)
    summary = spark.read.parquet(f"{output}/window_summary")
    anomalies = spark.read.parquet(f"{output}/anomalies").agg(F.count("*"))
    write_table(
        statistics.withColumns(
            {
                "window_event_count": summary.select("window_event_count").scalar(),
                "anomaly_count": anomalies.scalar(),
            }
        ),
        f"{output}/statistics",
    )


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--stored", action="store_true", help="the input is a delta table")
    parser.add_argument("--window-seconds", type=int, default=WINDOW_SECONDS)
    parser.add_argument("--error-rate-threshold", type=float, default=ERROR_RATE_THRESHOLD)
    parser.add_argument("--minimum-requests", type=int, default=MINIMUM_REQUESTS_FOR_ANOMALY)
    arguments = parser.parse_args()
    run_global(
        build_session("tidelog-global"),
        arguments.input,
        arguments.output,
        arguments.window_seconds,
        arguments.error_rate_threshold,
        arguments.minimum_requests,
        stored=arguments.stored,
    )


if __name__ == "__main__":
    main()
