"""Load events for a trial run, one for each row of a table of requests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.schema import EVENT_COLUMNS

ERROR_EVERY = 20


def load_events(requests: DataFrame, endpoint: str) -> DataFrame:
    """Requests (``id, client_ip, sec, method``) turned to one endpoint: valid events with
    the client, time and method of each, every twentieth an error.

    Their number, times and clients are those of the requests, so a trial has the arrival
    pattern and the hot clients of real traffic.
    """
    number = F.col("id")
    return requests.select(
        "client_ip",
        F.timestamp_seconds("sec").alias("timestamp"),
        "method",
        F.lit(endpoint).alias("endpoint"),
        F.lit("HTTP/1.1").alias("protocol"),
        F.when((number + 1) % ERROR_EVERY == 0, 500).otherwise(200).alias("status_code"),
        (F.lit(200) + number % 50).cast("bigint").alias("response_bytes"),
        F.lit("-").alias("referrer"),
        F.lit("tidelog-load").alias("user_agent"),
    ).select(*EVENT_COLUMNS)
