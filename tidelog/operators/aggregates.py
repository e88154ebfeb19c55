"""Historical and recent aggregates.

Every aggregate works on *facts*: rows of ``endpoint, minute, status_code, requests,
response_bytes, latest`` (the newest event time). Facts are either one row per event
(``unit_facts``, no shuffle) or pre-aggregated (``minute_facts``); both give the same
results, and facts of several days can be put together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.columns import minute, rate
from tidelog.schema import ERROR_STATUS

KEYS = ["endpoint", "minute", "status_code"]


def unit_facts(events: DataFrame, *more_keys: str) -> DataFrame:
    return events.select(
        *more_keys,
        "endpoint",
        minute(F.col("timestamp")).alias("minute"),
        "status_code",
        F.lit(1).cast("bigint").alias("requests"),
        F.col("response_bytes").cast("bigint").alias("response_bytes"),
        F.col("timestamp").alias("latest"),
    )


def add_up(facts: DataFrame, *more_keys: str) -> DataFrame:
    """One row per endpoint, UTC minute and status (and any further key)."""
    return facts.groupBy(*more_keys, *KEYS).agg(
        F.sum("requests").alias("requests"),
        F.sum("response_bytes").alias("response_bytes"),
        F.max("latest").alias("latest"),
    )


def minute_facts(events: DataFrame) -> DataFrame:
    return add_up(unit_facts(events))


def _errors():
    return F.sum(
        F.when(F.col("status_code") >= ERROR_STATUS, F.col("requests")).otherwise(F.lit(0))
    )


def requests_per_endpoint(facts: DataFrame) -> DataFrame:
    return facts.groupBy("endpoint").agg(F.sum("requests").alias("total_requests"))


def traffic_by_hour(facts: DataFrame) -> DataFrame:
    """Requests by UTC hour of day, all dates together."""
    return facts.groupBy(F.hour("minute").alias("hour")).agg(
        F.sum("requests").alias("request_count")
    )


def error_rates(facts: DataFrame) -> DataFrame:
    return (
        facts.groupBy("endpoint")
        .agg(F.sum("requests").alias("total_requests"), _errors().alias("error_count"))
        .withColumn("error_rate", rate(F.col("error_count"), F.col("total_requests")))
    )


def status_code_distribution(facts: DataFrame) -> DataFrame:
    return facts.groupBy("status_code").agg(F.sum("requests").alias("request_count"))


def response_byte_totals(facts: DataFrame) -> DataFrame:
    return facts.groupBy("endpoint").agg(F.sum("response_bytes").alias("total_response_bytes"))


def batch_summary(facts: DataFrame) -> DataFrame:
    return facts.agg(
        F.coalesce(F.sum("requests"), F.lit(0)).alias("total_valid_records"),
        F.sum("response_bytes").alias("total_response_bytes"),
    )


def baseline_rpm(facts: DataFrame, idle_minutes: bool = False) -> DataFrame:
    """Mean requests per minute of each endpoint over the minutes it was active in.

    ``idle_minutes`` counts all minutes from its first to its last request instead.
    """
    per_minute = facts.groupBy("endpoint", "minute").agg(F.sum("requests").alias("requests"))
    if idle_minutes:
        span = (F.unix_seconds(F.max("minute")) - F.unix_seconds(F.min("minute"))) / 60 + 1
        mean = F.sum("requests") / span
    else:
        mean = F.avg("requests")
    return per_minute.groupBy("endpoint").agg(mean.alias("avg_requests_per_minute"))


def endpoint_summary(facts: DataFrame) -> DataFrame:
    """Requests, errors, bytes and baseline of each endpoint from one pass.

    This is what joining the four per-endpoint tables gives. The two groupings have
    the endpoint in common, and the first one is already combined before the shuffle.
    """
    per_minute = facts.groupBy("endpoint", "minute").agg(
        F.sum("requests").alias("requests"),
        _errors().alias("errors"),
        F.sum("response_bytes").alias("response_bytes"),
    )
    return (
        per_minute.groupBy("endpoint")
        .agg(
            F.sum("requests").alias("total_requests"),
            F.sum("errors").alias("error_count"),
            F.sum("response_bytes").alias("total_response_bytes"),
            F.avg("requests").alias("avg_requests_per_minute"),
        )
        .select(
            "endpoint",
            "total_requests",
            "error_count",
            rate(F.col("error_count"), F.col("total_requests")).alias("error_rate"),
            "total_response_bytes",
            "avg_requests_per_minute",
        )
    )


def batch_metrics(facts: DataFrame, summary: DataFrame) -> dict[str, DataFrame]:
    """The seven batch result tables, unordered.

    ``summary`` is the stored ``endpoint_summary`` of the facts: the per-endpoint tables
    are columns of it and need no grouping of their own.
    """
    return {
        "requests_per_endpoint": summary.select("endpoint", "total_requests"),
        "traffic_by_hour": traffic_by_hour(facts),
        "error_rates": summary.select("endpoint", "total_requests", "error_count", "error_rate"),
        "status_code_distribution": status_code_distribution(facts),
        "response_byte_totals": summary.select("endpoint", "total_response_bytes"),
        "batch_summary": batch_summary(facts),
        "baseline_rpm": summary.select("endpoint", "avg_requests_per_minute"),
    }


# The order a result table is shown in; the endpoint settles ties.
OUTPUT_ORDER = {
    "requests_per_endpoint": [F.desc, "total_requests", "endpoint"],
    "traffic_by_hour": [None, "hour"],
    "error_rates": [F.desc, "error_rate", "endpoint"],
    "status_code_distribution": [None, "status_code"],
    "response_byte_totals": [None, "endpoint"],
}


def in_output_order(name: str, table: DataFrame) -> DataFrame:
    if name not in OUTPUT_ORDER:
        return table
    direction, first, *rest = OUTPUT_ORDER[name]
    return table.orderBy(direction(first) if direction else first, *rest)
