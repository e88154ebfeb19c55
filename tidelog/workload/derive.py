"""SQL that turns the ``events`` table into log lines, stream payloads and documents.

The same text runs on Spark and on DuckDB; a dialect fills in the few names that
differ. Only whole numbers and text are used, so both give identical rows. The
``truth`` columns say what a correct operator must find in the text.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

DELTA_DOCUMENT_SIZE = 500
INVOCATION_SIZE = 100


@dataclass(frozen=True)
class Dialect:
    events: str
    div: str
    timestamp: Callable[[str], str]
    log_time: Callable[[str], str]
    iso_time: Callable[[str], str]
    join_text: Callable[[str, str], str]
    base64: Callable[[str], str]


def spark_dialect(events: str) -> Dialect:
    return Dialect(
        events=events,
        div="div",
        timestamp=lambda seconds: f"timestamp_seconds({seconds})",
        log_time=lambda seconds: f"date_format(timestamp_seconds({seconds}), 'dd/MMM/yyyy:HH:mm:ss')",
        iso_time=lambda seconds: (
            f"date_format(timestamp_seconds({seconds}), \"yyyy-MM-dd'T'HH:mm:ss\")"
        ),
        join_text=lambda text, order: (
            "concat_ws(',', transform(array_sort(collect_list(named_struct("
            f"'o', struct({order}), 't', {text}))), e -> e.t))"
        ),
        base64=lambda text: f"replace(base64(encode({text}, 'utf-8')), '\r\n', '')",
    )


DUCKDB = Dialect(
    events="events",
    div="//",
    timestamp=lambda seconds: f"make_timestamp(({seconds}) * 1000000)",
    log_time=lambda seconds: f"strftime(make_timestamp(({seconds}) * 1000000), '%d/%b/%Y:%H:%M:%S')",
    iso_time=lambda seconds: f"strftime(make_timestamp(({seconds}) * 1000000), '%Y-%m-%dT%H:%M:%S')",
    join_text=lambda text, order: f"string_agg({text}, ',' ORDER BY {order})",
    base64=lambda text: f"to_base64(encode({text}))",
)


def requests(d: Dialect) -> str:
    """One request per event: 100 a minute, three hot endpoints of changing share."""
    cycle, place = f"(event_id {d.div} 1000)", "(event_id % 1000)"
    return f"""
    SELECT event_id AS id,
        '10.0.0.' || CAST(user_id % 250 AS STRING) AS client_ip,
        1704067200 + event_id * 6 {d.div} 10 AS sec,
        CASE WHEN event_id % 3 = 0 THEN 'POST' ELSE 'GET' END AS method,
        CASE WHEN {place} = 999 THEN '/new/' || CAST({cycle} AS STRING)
             WHEN {place} >= 950 + 10 * (({cycle} + 1) % 5)
                 THEN '/hot/' || CAST(event_id % 3 AS STRING)
             ELSE '/' || event_type || '/' || CAST(event_id % 10 AS STRING) END AS endpoint,
        CASE WHEN event_type = 'error' THEN
                 CASE event_id % 3 WHEN 0 THEN 500 WHEN 1 THEN 404 ELSE 503 END
             WHEN event_id % 5 = 0 THEN 304 ELSE 200 END AS status,
        event_id * 37 % 5000 AS size
    FROM {d.events}"""


def lines(d: Dialect) -> str:
    """Log lines, with zones, missing sizes and every kind of defect."""
    return f"""
    SELECT id,
        CASE WHEN id % 97 = 13 THEN 'malformed line ' || CAST(id AS STRING)
        ELSE client_ip || ' - - ['
            || CASE WHEN id % 101 = 7 THEN '99/Foo/2024:00:00:00 +0000'
                    WHEN id % 13 = 4 THEN {d.log_time('sec + 3600')} || ' +0100'
                    ELSE {d.log_time('sec')} || ' +0000' END
            || '] "'
            || CASE WHEN id % 103 = 5 THEN 'BROKEN'
                    WHEN id % 83 = 19 THEN method || '  ' || endpoint || ' HTTP/1.1'
                    ELSE method || ' ' || endpoint || ' HTTP/1.1' END
            || '" ' || CAST(status AS STRING) || ' '
            || CASE WHEN id % 11 = 0 THEN '-' ELSE CAST(size AS STRING) END
            || ' "' || CASE WHEN id % 4 = 0 THEN 'https://site/' || CAST(id % 10 AS STRING)
                            ELSE '-' END
            || '" "agent/' || CAST(id % 7 AS STRING) || ' (a; b)" "-"'
            || CASE WHEN id % 89 = 17 THEN ' ' ELSE '' END
        END AS value
    FROM ({requests(d)}) r"""


def payloads(d: Dialect) -> str:
    """Stream events as JSON text, next to the values a consumer must read from it."""
    return f"""
    SELECT *,
        is_object AND good_time AND good_endpoint AND good_status AND good_size AS valid,
        CASE WHEN NOT is_object THEN '[1]' ELSE
            '{{"client_ip":"' || client_ip || '","timestamp":"' || time_text
            || '","method":"' || method || '","endpoint":"' || endpoint_text
            || '","protocol":"HTTP/1.1","status_code":' || status_text
            || ',"response_bytes":' || size_text
            || ',"referrer":"-","user_agent":"agent/1","event_id":'
            || CASE WHEN event_id = '' THEN 'null' ELSE '"' || event_id || '"' END
            || ',"ingested_at":"' || {d.iso_time('sec')} || '.' || ingest_micros
            || '+00:00","source":"nginx_access_log"}}' END AS payload
    FROM (SELECT id, client_ip, sec, method, endpoint,
        id % 79 <> 43 AS is_object,
        id % 47 <> 3 AS good_time,
        id % 53 <> 9 AS good_endpoint,
        id % 67 <> 21 AS good_status,
        id % 61 <> 13 AS good_size,
        CASE WHEN id % 47 = 3 THEN {d.iso_time('sec')}
             WHEN id % 5 = 2 THEN {d.iso_time('sec')} || 'Z'
             WHEN id % 11 = 4 THEN {d.iso_time('sec + 3600')} || '+01:00'
             WHEN id % 9 = 5 THEN {d.iso_time('sec')} || '.000000+00:00'
             ELSE {d.iso_time('sec')} || '+00:00' END AS time_text,
        CASE WHEN id % 53 = 9 THEN '   ' WHEN id % 43 = 5 THEN '  ' || endpoint || ' '
             ELSE endpoint END AS endpoint_text,
        CASE WHEN id % 67 = 21 THEN '"x"' WHEN id % 59 = 11 THEN '"404"'
             WHEN id % 71 = 33 THEN '200.7' ELSE CAST(status AS STRING) END AS status_text,
        CASE WHEN id % 59 = 11 THEN 404 WHEN id % 71 = 33 THEN 200 ELSE status END AS status,
        CASE WHEN id % 61 = 13 THEN '-5' WHEN id % 64 = 10 THEN '" 12 "'
             ELSE CAST(size AS STRING) END AS size_text,
        CASE WHEN id % 64 = 10 THEN 12 ELSE size END AS size,
        CASE WHEN id % 73 = 41 THEN '' ELSE 'e-' || CAST(id AS STRING) END AS event_id,
        CAST(100000 + id * 7919 % 900000 AS STRING) AS ingest_micros
        FROM ({requests(d)}) r) t"""


def records(d: Dialect) -> str:
    """Transport records of invocations; every 7th event is sent again one later."""
    return f"""
    SELECT *, id {d.div} {INVOCATION_SIZE} + copy AS invocation,
        CASE WHEN id % 127 = 5 THEN 'object' WHEN id % 29 = 3 THEN 'kinesis'
             WHEN id % 31 = 7 THEN 'base64' ELSE '' END AS broken,
        CASE WHEN id % 127 = 5 THEN '7' ELSE
            '{{"eventID":' || CASE WHEN id % 41 = 9 THEN 'null'
                                  ELSE '"shard-' || CAST(id AS STRING) || '"' END
            || CASE WHEN id % 29 = 3 THEN '' ELSE
                ',"kinesis":{{"partitionKey":"' || client_ip || '"'
                || CASE WHEN id % 41 IN (6, 9) THEN ''
                        ELSE ',"sequenceNumber":"' || CAST(id AS STRING) || '"' END
                || ',"data":"' || CASE WHEN id % 31 = 7 THEN '***'
                                       ELSE {d.base64('payload')} END || '"}}' END
            || '}}' END AS record
    FROM (SELECT *, 0 AS copy FROM ({payloads(d)}) sent
          UNION ALL SELECT *, 1 AS copy FROM ({payloads(d)}) again WHERE id % 7 = 0) p"""


def invocations(d: Dialect) -> str:
    """Invocation documents; now and then one has no list of records."""
    return f"""
    SELECT invocation,
        CASE WHEN invocation % 10 = 9 THEN '{{"Records":"none"}}'
             ELSE '{{"Records":[' || listed || ']}}' END AS value
    FROM (SELECT invocation, {d.join_text('record', 'copy, id')} AS listed
          FROM ({records(d)}) r GROUP BY invocation) g"""


def elements(d: Dialect) -> str:
    """Elements of delta documents: retries, invalid copies, one id used again and again."""
    return f"""
    SELECT *, is_object AND good_time AND good_size AS valid,
        CASE WHEN NOT is_object THEN '"text"' ELSE
            '{{"event_id":' || id_text || ',"sequence_number":' || sequence_text
            || ',"timestamp":"' || time_text || '","client_ip":"' || client_ip
            || '","method":"' || method || '","endpoint":"' || endpoint
            || '","status_code":' || CAST(status AS STRING)
            || ',"response_bytes":' || size_text || ',"source":"nginx_access_log"}}'
            END AS element,
        CASE WHEN NOT is_object THEN NULL
             WHEN id_text <> 'null' THEN 'i:' || id_text
             WHEN sequence_text <> 'null' THEN 's:' || sequence_text
             ELSE 'f:' || time_text || client_ip || method || endpoint
                 || CAST(status AS STRING) || size_text END AS identity
    FROM (SELECT id, copy, id {d.div} {DELTA_DOCUMENT_SIZE} + copy AS doc,
        client_ip, sec, method, endpoint, status, size,
        id % 79 <> 43 AS is_object,
        NOT (copy = 1 AND id % 21 = 0) AS good_time,
        NOT (copy = 0 AND id % 49 = 0) AS good_size,
        CASE WHEN id % 10 = 9 THEN '"hot-key"' WHEN id % 73 = 41 OR id % 37 = 8 THEN 'null'
             ELSE '"e-' || CAST(id AS STRING) || '"' END AS id_text,
        CASE WHEN id % 37 = 8 THEN 'null' ELSE '"s-' || CAST(id AS STRING) || '"' END
            AS sequence_text,
        CASE WHEN copy = 1 AND id % 21 = 0 THEN 'never'
             ELSE {d.iso_time('sec')} || '+00:00' END AS time_text,
        CASE WHEN copy = 0 AND id % 49 = 0 THEN '-1' ELSE CAST(size AS STRING) END AS size_text
        FROM (SELECT *, 0 AS copy FROM ({requests(d)}) stored
              UNION ALL SELECT *, 1 AS copy FROM ({requests(d)}) again WHERE id % 7 = 0) r) t"""


def delta_documents(d: Dialect, mark: str = "'@'") -> str:
    """Delta documents; ``mark`` is the SQL text of a byte order mark some start with."""
    return f"""
    SELECT doc, 'doc-' || lpad(CAST(doc AS STRING), 10, '0') AS doc_key,
        CASE WHEN doc % 10 = 8 THEN 'not json' ELSE
            CASE WHEN doc % 10 = 7 THEN {mark} ELSE '' END
            || '{{"schema_version":1,"document_type":"'
            || CASE WHEN doc % 10 = 9 THEN 'other' ELSE 'speed_batch_delta' END
            || '","record_count":' || CAST(n AS STRING) || ',"events":[' || listed || ']}}'
            END AS value
    FROM (SELECT doc, count(*) AS n, {d.join_text('element', 'copy, id')} AS listed
          FROM ({elements(d)}) e GROUP BY doc) g"""


def minute_counts(d: Dialect) -> str:
    """Requests, errors and bytes of each endpoint in each minute, for documents."""
    return f"""
    SELECT sec {d.div} 60 - 28401120 AS doc, endpoint, count(*) AS n,
        count(CASE WHEN status >= 400 THEN 1 END) AS errors,
        CAST(sum(size) AS BIGINT) AS bytes
    FROM ({requests(d)}) r GROUP BY sec {d.div} 60 - 28401120, endpoint"""


def metric_documents(d: Dialect) -> str:
    """A metrics document per minute, in each of the known shapes."""
    counts = """CASE WHEN errors > 0 THEN '"' || endpoint || '":"' || CAST(n AS STRING) || '"'
                     ELSE '"' || endpoint || '":' || CAST(n AS STRING) END"""
    sizes = """'"' || endpoint || '":' || CASE WHEN n = 3 THEN '"many"' ELSE CAST(bytes AS STRING) END"""
    rates = """'"' || endpoint || '":' || CASE WHEN errors > 0
                   THEN '{"total_requests":' || CAST(n AS STRING) || ',"error_rate":'
                        || CAST(errors AS STRING) || '}'
                   ELSE CAST(errors AS STRING) END"""
    return f"""
    SELECT doc, 'metrics-' || lpad(CAST(doc AS STRING), 10, '0') AS doc_key,
        CASE doc % 4 WHEN 0 THEN '{{"batch_metrics":' || body || '}}'
                     WHEN 1 THEN '{{"batch_metrics":5,"metrics":' || body || '}}'
                     WHEN 2 THEN '{{"snapshot":' || body || '}}' ELSE body END AS value
    FROM (SELECT doc, '{{"window_seconds":60,"total_valid_records":' || CAST(sum(n) AS STRING)
            || ',"requests_per_endpoint":{{' || {d.join_text(counts, 'endpoint')}
            || '}},"response_byte_totals":{{' || {d.join_text(sizes, 'endpoint')}
            || '}},"error_rates":{{' || {d.join_text(rates, 'endpoint')} || '}}}}' AS body
          FROM ({minute_counts(d)}) m GROUP BY doc) g"""


def baseline_documents(d: Dialect) -> str:
    """A baseline document per minute: map, nested map, or rows with repeats."""
    plain = """'"' || endpoint || '":' || CASE WHEN n = 2 THEN '-1' ELSE CAST(n AS STRING) END"""
    nested = """'" ' || endpoint || '":{"' || CASE WHEN n = 1 THEN 'baseline_rpm'
                    ELSE 'avg_requests_per_minute' END || '":"' || CAST(n AS STRING) || '"}'"""
    rows = """'{"endpoint":"' || endpoint || '","value":' || CAST(n AS STRING) || '},{"endpoint":" '
                  || endpoint || '","' || CASE WHEN n = 1 THEN 'baseline_rpm'
                  ELSE 'avg_requests_per_minute' END || '":'
                  || CASE WHEN errors > 0 THEN '"none"' ELSE CAST(n + 1 AS STRING) END || '}'"""
    return f"""
    SELECT 'baseline-' || lpad(CAST(doc AS STRING), 10, '0') AS doc_key,
        CASE doc % 3 WHEN 0 THEN '{{"baseline_rpm":{{' || plain || '}}}}'
                     WHEN 1 THEN '{{"baseline_rpm":{{' || nested || '}}}}'
                     ELSE '{{"baseline_rpm":[' || listed || ']}}' END AS value
    FROM (SELECT doc, {d.join_text(plain, 'endpoint')} AS plain,
            {d.join_text(nested, 'endpoint')} AS nested, {d.join_text(rows, 'endpoint')} AS listed
          FROM ({minute_counts(d)}) m GROUP BY doc) g"""
