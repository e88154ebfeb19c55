"""The recent window: events no older than W seconds before the newest event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.instants import iso_text
from tidelog.functions.traffic import recent_rpm
from tidelog.operators.aggregates import error_rates
from tidelog.operators.skew import spread_join
from tidelog.schema import (
    ANOMALY_REASON,
    ERROR_RATE_THRESHOLD,
    MINIMUM_REQUESTS_FOR_ANOMALY,
    check_anomaly_thresholds,
    check_window,
)


def newest_event(events: DataFrame) -> DataFrame:
    """Time of the newest event, one row."""
    return events.agg(F.max("timestamp").alias("window_end"))


def window_start(window_end: Column, window_seconds: int) -> Column:
    return window_end - F.make_dt_interval(secs=F.lit(window_seconds))


def _start_of(events: DataFrame, window_seconds: int) -> Column:
    """Start of the window as a bare scalar subquery, which a file scan can use."""
    bound = newest_event(events).select(window_start(F.col("window_end"), window_seconds))
    return bound.scalar()


def recent_window(
    events: DataFrame,
    window_seconds: int,
    by: list[str] | None = None,
    newest: Column | None = None,
) -> DataFrame:
    """Events from ``newest - W`` on, both ends included, in any arrival order.

    The bound is a scalar subquery, which Spark evaluates first and hands to the scan as
    a filter. ``newest`` gives the time of the newest event when it is already known.
    With ``by`` every group has a window of its own.
    """
    check_window(window_seconds)
    if by:
        bounds = events.groupBy(*by).agg(
            F.max("timestamp").alias("window_end"), F.count("*").alias("copies")
        )
        joined = spread_join(events, bounds, by, salt_on=["timestamp", "endpoint"])
        start = window_start(F.col("window_end"), window_seconds)
        return joined.filter(F.col("timestamp") >= start).drop("window_end")
    if newest is None:
        start = _start_of(events, window_seconds)
    else:
        start = window_start(newest, window_seconds)
    return events.filter(F.col("timestamp") >= start)


def window_summary(facts: DataFrame, window_seconds: int) -> DataFrame:
    """One row about the facts of a window; no bounds when it is empty."""
    end = F.max("latest")
    count = F.coalesce(F.sum("requests"), F.lit(0))
    return facts.agg(
        F.lit(int(window_seconds)).alias("window_seconds"),
        iso_text(window_start(end, window_seconds)).alias("window_start"),
        iso_text(end).alias("window_end"),
        count.alias("window_event_count"),
        count.alias("total_valid_records"),
        F.coalesce(F.sum("response_bytes"), F.lit(0)).alias("total_response_bytes"),
        recent_rpm(count, F.lit(window_seconds)).alias("recent_rpm"),
    )


def split_by_window(events: DataFrame, window_seconds: int) -> DataFrame:
    """Add ``recent``: is the event inside the window or before it?"""
    check_window(window_seconds)
    start = _start_of(events, window_seconds)
    return events.withColumn("recent", F.col("timestamp") >= start)


def error_anomalies(
    rates: DataFrame,
    error_rate_threshold: float = ERROR_RATE_THRESHOLD,
    minimum_requests: int = MINIMUM_REQUESTS_FOR_ANOMALY,
) -> DataFrame:
    """Endpoints whose recent error rate reaches the threshold with enough requests."""
    check_anomaly_thresholds(error_rate_threshold, minimum_requests)
    return rates.filter(
        (F.col("total_requests") >= minimum_requests)
        & (F.col("error_rate") >= error_rate_threshold)
    ).select(
        "endpoint", "total_requests", "error_count", "error_rate", F.lit(ANOMALY_REASON).alias("reason")
    )


def window_anomalies(facts: DataFrame, **thresholds) -> DataFrame:
    return error_anomalies(error_rates(facts), **thresholds)


def endpoint_count(requests: DataFrame, endpoints: DataFrame) -> DataFrame:
    """The request count of each asked endpoint, 0 when the window has none."""
    counts = requests.groupBy("endpoint").agg(F.sum("total_requests").alias("n"))
    return endpoints.join(counts, "endpoint", "left").select(
        *endpoints.columns, F.coalesce("n", F.lit(0)).alias("request_count")
    )
