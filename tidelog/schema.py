"""Record layouts, defaults and other values that results depend on."""

from __future__ import annotations

import math

from pyspark.sql import types as T

# The access-log line format and its timestamp format.
LOG_PATTERN = (
    r'^(\S+) \S+ \S+ \[([^\]]+)\] "([^"]*)" (\d{3}) (\S+) "([^"]*)" "([^"]*)" "([^"]*)"$'
)
LOG_TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"

# Text labels that appear in results.
EVENT_SOURCE = "nginx_access_log"
DELTA_DOCUMENT_TYPE = "speed_batch_delta"
ANOMALY_REASON = "recent error rate reached the configured threshold"

# What a snapshot says about itself.
SNAPSHOT_SCHEMA_VERSION = 1
SNAPSHOT_LAYER = "speed"

# What a serving view says about itself.
VIEW_SCHEMA_VERSION = 2
VIEW_TYPE = "historical_and_recent"
VIEW_NOTE = (
    "The two sides cover different lengths of time: compare rates and shares, not counts. "
    "A significant increase reaches both the ratio and the number of requests of this view."
)

# Defaults.
ERROR_STATUS = 400
WINDOW_SECONDS = 300
ERROR_RATE_THRESHOLD = 0.5
MINIMUM_REQUESTS_FOR_ANOMALY = 2
TRAFFIC_SPIKE_RATIO = 2.0
MINIMUM_REQUESTS_FOR_SPIKE = 10
REJECTED_SAMPLE_SIZE = 20
SEND_BATCH_SIZE = 500

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("client_ip", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("method", T.StringType()),
        T.StructField("endpoint", T.StringType()),
        T.StructField("protocol", T.StringType()),
        T.StructField("status_code", T.IntegerType()),
        T.StructField("response_bytes", T.LongType()),
        T.StructField("referrer", T.StringType()),
        T.StructField("user_agent", T.StringType()),
    ]
)
EVENT_COLUMNS = EVENT_SCHEMA.names

DELTA_EVENT_FIELDS = [
    "event_id",
    "sequence_number",
    "timestamp",
    "client_ip",
    "method",
    "endpoint",
    "status_code",
    "response_bytes",
    "source",
]

BATCH_TABLES = {
    "requests_per_endpoint": "endpoint STRING, total_requests BIGINT",
    "traffic_by_hour": "hour INT, request_count BIGINT",
    "error_rates": (
        "endpoint STRING, total_requests BIGINT, error_count BIGINT, error_rate DOUBLE"
    ),
    "status_code_distribution": "status_code INT, request_count BIGINT",
    "response_byte_totals": "endpoint STRING, total_response_bytes BIGINT",
    "batch_summary": "total_valid_records BIGINT, total_response_bytes BIGINT",
    "baseline_rpm": "endpoint STRING, avg_requests_per_minute DOUBLE",
}


def check_window(window_seconds: float) -> None:
    if window_seconds <= 0:
        raise ValueError("window_seconds must be greater than zero")


def check_spike_thresholds(ratio: float, minimum_requests: int) -> None:
    if not math.isfinite(ratio) or ratio <= 1.0:
        raise ValueError("the traffic spike ratio must be a finite number above 1.0")
    if minimum_requests < 1:
        raise ValueError("the minimum number of requests must be at least 1")


def check_anomaly_thresholds(rate: float, minimum_requests: int) -> None:
    if not 0.0 <= rate <= 1.0:
        raise ValueError("the error-rate threshold must lie between 0 and 1")
    if minimum_requests < 1:
        raise ValueError("the minimum number of requests must be at least 1")


def check_batch_size(size: int) -> None:
    if not 1 <= size <= SEND_BATCH_SIZE:
        raise ValueError(f"batch size must be between 1 and {SEND_BATCH_SIZE}")
