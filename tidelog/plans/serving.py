"""The serving job: historical tables and a window snapshot to one view."""

from __future__ import annotations

import argparse

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.instants import iso_text
from tidelog.operators.reports import run_report
from tidelog.operators.serving import (
    combined_view,
    document_metrics,
    endpoint_metrics,
    endpoint_universe,
    single_endpoint_baseline,
    view_lines,
)
from tidelog.plans.sinks import write_serving_view, write_view_lines
from tidelog.schema import MINIMUM_REQUESTS_FOR_SPIKE, TRAFFIC_SPIKE_RATIO, WINDOW_SECONDS
from tidelog.session import build_session, configure, stage
from tidelog.sources.documents import (
    baseline_value,
    document_totals,
    metric_rows,
    parse_metric_documents,
    read_baselines,
    read_documents,
)
from tidelog.sources.tables import read_batch_tables
from tidelog.streaming.job import StreamJob


def _recent_metrics(endpoints: DataFrame) -> DataFrame:
    missing = F.lit(None).cast("double")
    return endpoint_metrics(endpoints.withColumn("avg_requests_per_minute", missing))


def view_of_tables(
    spark: SparkSession,
    batch_tables: dict[str, DataFrame],
    snapshot: dict[str, DataFrame],
    ratio: float = TRAFFIC_SPIKE_RATIO,
    minimum_requests: int = MINIMUM_REQUESTS_FOR_SPIKE,
    snapshot_generated_at: Column | None = None,
) -> dict[str, DataFrame]:
    """The serving view from batch tables and the sections of a snapshot.

    The batch job's ``endpoint_summary`` is used as it is; without it the three tables
    it could be made from are joined.
    """
    history = batch_tables.get("endpoint_summary")
    if history is None:
        history = run_report(spark, "endpoint_historical_summary", batch_tables)
    return combined_view(
        endpoint_metrics(history),
        _recent_metrics(snapshot["endpoints"]),
        batch_tables["status_code_distribution"],
        snapshot["status_code_distribution"],
        snapshot["window_summary"],
        snapshot["anomalies"],
        ratio,
        minimum_requests,
        snapshot_generated_at=snapshot_generated_at,
    )


def _document_side(documents: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Endpoint metrics, status counts and totals of one metric document.

    A document is one long text, so what is read from it is written down at once.
    """
    baselines = read_baselines(
        documents.select(
            "doc_key", baseline_value(F.col("metrics"), F.col("root")).alias("baseline")
        )
    )
    rows = stage(metric_rows(documents), "metrics")
    status = rows.filter(F.col("metric") == "status_code_distribution").select(
        F.col("key").alias("status_code"), F.col("count").alias("request_count")
    )
    metrics = stage(document_metrics(rows, baselines).drop("doc_key"), "endpoints")
    return metrics, status, stage(document_totals(documents), "totals")


def view_of_documents(
    batch_document: DataFrame,
    speed_document: DataFrame,
    ratio: float = TRAFFIC_SPIKE_RATIO,
    minimum_requests: int = MINIMUM_REQUESTS_FOR_SPIKE,
) -> dict[str, DataFrame]:
    """The serving view from one batch and one speed document (``doc_key, value``).

    This is for existing JSON exports, which hold a whole side in one text.
    """
    batch = parse_metric_documents(batch_document, "batch")
    speed = parse_metric_documents(speed_document, "speed")
    history, history_status, history_totals = _document_side(batch)
    recent, recent_status, recent_totals = _document_side(speed)
    # A scalar baseline belongs to the endpoint when only one is known at all.
    universe = endpoint_universe(history, recent).withColumn("pair", F.lit(0))
    scalar = history_totals.select(F.lit(0).alias("pair"), "baseline_scalar")
    without = history.agg(F.count("baseline_rpm")).scalar() == 0
    only = single_endpoint_baseline(universe, scalar, ["pair"]).filter(without)
    extra = universe.select("endpoint").join(only.drop("pair"), "endpoint", "left").select(
        "endpoint",
        F.lit(None).cast("bigint").alias("requests"),
        F.lit(None).cast("bigint").alias("response_bytes"),
        F.lit(None).cast("double").alias("error_rate"),
        "baseline_rpm",
    )
    largest = [F.max(name).alias(name) for name in extra.columns if name != "endpoint"]
    history = stage(history.unionByName(extra).groupBy("endpoint").agg(*largest), "history")
    anomalies = speed.select(F.variant_get("root", "$.anomalies", "variant").alias("anomalies"))
    listed = anomalies.select(
        F.explode(F.try_variant_get("anomalies", "$", "array<variant>")).alias("anomaly")
    ).select(
        F.try_variant_get("anomaly", "$.endpoint", "string").alias("endpoint"), "anomaly"
    )
    return combined_view(
        history,
        recent,
        history_status,
        recent_status,
        recent_totals,
        listed,
        ratio,
        minimum_requests,
        history_totals,
        recent_totals,
        recent_totals.select("generated_at").scalar(),
    )


def write_view(view: dict[str, DataFrame], output: str) -> None:
    """Write the view as tables, and as JSON rows under ``lines``."""
    write_serving_view(view, output)
    spark = next(iter(view.values())).sparkSession
    stored = {name: spark.read.parquet(f"{output}/{name}") for name in view}
    write_view_lines(view_lines(stored), f"{output}/lines")


def run_serving_documents(
    spark: SparkSession,
    batch_document: str,
    speed_document: str,
    output: str,
    ratio: float = TRAFFIC_SPIKE_RATIO,
    minimum_requests: int = MINIMUM_REQUESTS_FOR_SPIKE,
) -> None:
    """Write the serving view of two JSON documents, each named by its path."""
    configure(spark)
    read = lambda path: read_documents(spark, path, "*")
    write_view(view_of_documents(read(batch_document), read(speed_document), ratio, minimum_requests), output)


def run_serving(
    spark: SparkSession,
    batch_path: str,
    snapshot_path: str | None,
    output: str,
    file_format: str = "parquet",
    ratio: float = TRAFFIC_SPIKE_RATIO,
    minimum_requests: int = MINIMUM_REQUESTS_FOR_SPIKE,
    stream: StreamJob | None = None,
) -> None:
    """Write the serving view as tables, and as JSON rows under ``lines``.

    The recent side is a global snapshot, or the latest one of a running stream job.
    """
    configure(spark)
    names = ["window_summary", "endpoints", "status_code_distribution", "anomalies"]
    made = None
    if stream is None:
        snapshot = {name: spark.read.parquet(f"{snapshot_path}/{name}") for name in names}
    else:
        snapshot = {name: stream.read_snapshot(spark, name) for name in names}
        made = iso_text(F.lit(stream.latest(spark)["generated_at"]))
    tables = read_batch_tables(spark, batch_path, file_format)
    try:
        tables["endpoint_summary"] = spark.read.parquet(f"{batch_path}/endpoint_summary")
    except AnalysisException:
        pass  # tables of another writer
    write_view(view_of_tables(spark, tables, snapshot, ratio, minimum_requests, made), output)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    past = parser.add_mutually_exclusive_group(required=True)
    past.add_argument("--batch", help="output of the batch job")
    past.add_argument("--batch-document", help="a JSON document, together with --speed-document")
    recent = parser.add_mutually_exclusive_group(required=True)
    recent.add_argument("--snapshot", help="output of the global window job")
    recent.add_argument("--stream", help="output of the stream job")
    recent.add_argument("--speed-document", help="a JSON document")
    parser.add_argument(
        "--window-seconds", type=int, default=WINDOW_SECONDS, help="of a stream whose markers have no settings"
    )
    parser.add_argument("--output", required=True)
    parser.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    parser.add_argument("--traffic-spike-ratio", type=float, default=TRAFFIC_SPIKE_RATIO)
    parser.add_argument("--minimum-requests", type=int, default=MINIMUM_REQUESTS_FOR_SPIKE)
    arguments = parser.parse_args()
    if bool(arguments.batch_document) != bool(arguments.speed_document):
        parser.error("--batch-document and --speed-document belong together")
    if arguments.batch_document:
        run_serving_documents(
            build_session("tidelog-serving"),
            arguments.batch_document,
            arguments.speed_document,
            arguments.output,
            arguments.traffic_spike_ratio,
            arguments.minimum_requests,
        )
        return
    run_serving(
        build_session("tidelog-serving"),
        arguments.batch,
        arguments.snapshot,
        arguments.output,
        arguments.format,
        arguments.traffic_spike_ratio,
        arguments.minimum_requests,
        StreamJob(arguments.stream, arguments.window_seconds) if arguments.stream else None,
    )


if __name__ == "__main__":
    main()
