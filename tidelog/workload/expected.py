"""Building blocks of the check SQL: what DuckDB reads from the same derived text."""

from __future__ import annotations

from tidelog.schema import LOG_PATTERN
from tidelog.workload import derive
from tidelog.workload.frames import WINDOW

D = derive.DUCKDB
TIME = "strftime({}, '%Y-%m-%d %H:%M:%S')"
ISO = "strftime({}, '%Y-%m-%dT%H:%M:%S+00:00')"

_GROUPS = ", ".join(
    f"regexp_extract(value, '{LOG_PATTERN}', {number}) AS {name}"
    for number, name in enumerate(
        ["client_ip", "timestamp_raw", "request_raw", "status_code_raw",
         "response_bytes_raw", "referrer", "user_agent", "extra"],
        start=1,
    )
)


def _parsed(lines: str) -> str:
    return f"""
    groups AS (SELECT value AS raw_line, {_GROUPS} FROM {lines}),
    typed AS (
        SELECT *,
            make_timestamp(epoch_us(try_strptime(timestamp_raw, '%d/%b/%Y:%H:%M:%S %z'))) AS ts,
            regexp_matches(request_raw, '^[^ ]* [^ ]* ') AS request_valid,
            split_part(request_raw, ' ', 1) AS first_part,
            split_part(request_raw, ' ', 2) AS second_part
        FROM groups),
    parsed AS (
        SELECT raw_line, client_ip, ts,
            CASE WHEN request_valid THEN first_part END AS method,
            CASE WHEN request_valid THEN second_part ELSE request_raw END AS endpoint,
            CASE WHEN request_valid THEN
                substr(request_raw, length(first_part) + length(second_part) + 3) END AS protocol,
            TRY_CAST(status_code_raw AS INTEGER) AS status_code,
            CASE WHEN regexp_matches(response_bytes_raw, '^[0-9]+$')
                 THEN CAST(response_bytes_raw AS BIGINT) ELSE 0 END AS response_bytes,
            referrer, user_agent,
            client_ip <> '' AS format_valid, ts IS NOT NULL AS timestamp_valid, request_valid,
            CASE WHEN client_ip = '' THEN 'invalid_format'
                 WHEN ts IS NULL THEN 'invalid_timestamp'
                 WHEN NOT request_valid THEN 'invalid_request' END AS reason
        FROM typed),
    valid AS (SELECT * FROM parsed WHERE reason IS NULL)"""


LINES = f"lines AS ({derive.lines(D)})"
# Everything the batch rule reads from the log.
BATCH = f"WITH {LINES}, {_parsed('lines')}"
# The replay rule first drops blanks around a line.
PARSED_TRIMMED = _parsed("trimmed")
REPLAY = f"WITH {LINES}, trimmed AS (SELECT trim(value) AS value FROM lines), {_parsed('trimmed')}"


def recent(seconds: int = WINDOW, prefix: str = BATCH) -> str:
    """Adds the CTE ``recent`` to the batch ones."""
    return f"""{prefix},
    recent AS (SELECT * FROM valid
               WHERE ts >= (SELECT max(ts) FROM valid) - INTERVAL {seconds} SECOND)"""


SERVING = f"""{recent()},
    past AS (SELECT * FROM valid
             WHERE ts < (SELECT max(ts) FROM valid) - INTERVAL {WINDOW} SECOND),
    history AS (
        SELECT endpoint, CAST(sum(n) AS BIGINT) AS requests, CAST(sum(bytes) AS BIGINT) AS bytes,
            CAST(sum(errors) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS error_rate, avg(n) AS baseline
        FROM (SELECT endpoint, date_trunc('minute', ts) AS minute, count(*) AS n,
                  count(*) FILTER (status_code >= 400) AS errors, sum(response_bytes) AS bytes
              FROM past GROUP BY 1, 2) m
        GROUP BY endpoint),
    now_side AS (
        SELECT endpoint, count(*) AS requests, CAST(sum(response_bytes) AS BIGINT) AS bytes,
            CAST(count(*) FILTER (status_code >= 400) AS DOUBLE) / CAST(count(*) AS DOUBLE)
                AS error_rate
        FROM recent GROUP BY endpoint)"""


def comparison(ratio: float, minimum: int) -> str:
    """Adds the CTE ``compared``, every endpoint with its traffic classification."""
    return f"""{SERVING},
    joined AS (
        SELECT coalesce(h.endpoint, r.endpoint) AS endpoint,
            coalesce(h.requests, 0) AS historical_requests,
            coalesce(r.requests, 0) AS recent_requests,
            h.baseline AS historical_baseline_rpm,
            round(coalesce(r.requests, 0) * 60.0::DOUBLE / {WINDOW}, 6) AS recent_rpm,
            h.error_rate AS historical_error_rate, r.error_rate AS recent_error_rate,
            round(r.error_rate - h.error_rate, 6) AS error_rate_difference,
            coalesce(h.bytes, 0) AS historical_response_bytes,
            coalesce(r.bytes, 0) AS recent_response_bytes
        FROM history h FULL JOIN now_side r ON h.endpoint = r.endpoint),
    rated AS (
        SELECT *, historical_baseline_rpm IS NOT NULL AS comparison_available,
            recent_rpm - historical_baseline_rpm AS difference,
            CASE WHEN historical_baseline_rpm > 0
                 THEN recent_rpm / historical_baseline_rpm END AS ratio,
            recent_requests >= {minimum} AS minimum_requests_met
        FROM joined),
    judged AS (
        SELECT *, coalesce(minimum_requests_met AND difference > 0
                  AND (ratio IS NULL OR ratio >= {ratio}), false) AS significant_increase
        FROM rated),
    compared AS (
        SELECT endpoint, historical_requests, recent_requests, historical_baseline_rpm,
            recent_rpm, comparison_available, round(difference, 6) AS rpm_difference,
            round(ratio, 6) AS recent_to_baseline_ratio,
            CASE WHEN NOT comparison_available THEN 'baseline unavailable'
                 WHEN significant_increase THEN 'significant increase'
                 WHEN difference > 0 THEN 'above baseline'
                 WHEN difference < 0 THEN 'below baseline'
                 ELSE 'equal to baseline' END AS traffic_status,
            significant_increase, {ratio}::DOUBLE AS spike_ratio_threshold,
            {minimum} AS minimum_requests_threshold, minimum_requests_met,
            historical_error_rate, recent_error_rate, error_rate_difference,
            historical_response_bytes, recent_response_bytes
        FROM judged)"""


STATUS_SHARES = """,
    past_status AS (
        SELECT status_code, count(*) AS n,
            round(count(*)::DOUBLE / (SELECT count(*) FROM past)::DOUBLE, 6) AS share
        FROM past GROUP BY status_code),
    now_status AS (
        SELECT status_code, count(*) AS n,
            round(count(*)::DOUBLE / (SELECT count(*) FROM recent)::DOUBLE, 6) AS share
        FROM recent GROUP BY status_code),
    status_compared AS (
        SELECT coalesce(p.status_code, r.status_code)::VARCHAR AS status_code,
            coalesce(p.n, 0) AS historical_count, coalesce(r.n, 0) AS recent_count,
            coalesce(p.share, 0) AS historical_share, coalesce(r.share, 0) AS recent_share,
            round(coalesce(r.share, 0) - coalesce(p.share, 0), 6) AS share_difference
        FROM past_status p FULL JOIN now_status r ON p.status_code = r.status_code)"""

PAYLOADS = f"WITH payloads AS ({derive.payloads(D)})"

# Records with the identifier they are reported under.
RECORDS = f"""WITH raw_records AS ({derive.records(D)}),
    placed AS (
        SELECT *, row_number() OVER (PARTITION BY invocation ORDER BY copy, id) - 1 AS record_index
        FROM raw_records WHERE invocation % 10 <> 9),
    records AS (
        SELECT * EXCLUDE (valid), valid AND broken = '' AS valid,
            CASE WHEN broken = 'object' THEN 'record-' || record_index
                 WHEN broken <> 'kinesis' AND id % 41 NOT IN (6, 9) THEN id::VARCHAR
                 WHEN id % 41 <> 9 THEN 'shard-' || id
                 ELSE 'record-' || record_index END AS identifier
        FROM placed)"""

# Elements of delta documents with their class.
ELEMENTS = f"""WITH raw_elements AS ({derive.elements(D)}),
    placed AS (
        SELECT *, 'doc-' || lpad(doc::VARCHAR, 10, '0') AS doc_key,
            row_number() OVER (PARTITION BY doc ORDER BY copy, id) - 1 AS position
        FROM raw_elements WHERE doc % 10 NOT IN (8, 9)),
    seen AS (
        SELECT *, max(valid::INT) OVER (PARTITION BY identity ORDER BY doc, position
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS accepted
        FROM placed),
    classified AS (
        SELECT *, make_timestamp(sec * 1000000) AS ts,
            CASE WHEN NOT is_object THEN 'invalid' WHEN accepted = 1 THEN 'duplicate'
                 WHEN valid THEN 'unique' ELSE 'invalid' END AS event_class
        FROM seen)"""
GLOBAL = f"""{ELEMENTS},
    unique_events AS (SELECT * FROM classified WHERE event_class = 'unique'),
    recent AS (SELECT endpoint, ts, status AS status_code, size AS response_bytes
               FROM unique_events
               WHERE ts >= (SELECT max(ts) FROM unique_events) - INTERVAL {WINDOW} SECOND)"""

ENDPOINT_ROWS = """
    SELECT endpoint, count(*) AS total_requests,
        count(*) FILTER (status_code >= 400) AS error_count,
        count(*) FILTER (status_code >= 400)::DOUBLE / count(*)::DOUBLE AS error_rate,
        sum(response_bytes)::BIGINT AS total_response_bytes
    FROM {} GROUP BY endpoint"""
