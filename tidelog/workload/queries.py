"""Every operator over the derived log, each with the SQL that must give the same rows."""

from __future__ import annotations

from typing import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.instants import iso_text, lenient_utc
from tidelog.functions.keys import partition_key, sanitize_key
from tidelog.functions.traffic import recent_rpm
from tidelog.operators import (
    aggregates,
    dedup,
    events,
    latency,
    parity,
    parse,
    reports,
    serving,
    window,
)
from tidelog.plans import batch, global_window, sinks
from tidelog.plans.parity import batch_stream_values
from tidelog.session import stage
from tidelog.sources import documents, generator, logs, tables
from tidelog.sources.event_table import VALID
from tidelog.streaming.job import StreamJob
from tidelog.streaming.records import RecordStore, record_rows
from tidelog.operators.replay import replay_records, replay_statistics
from tidelog.streaming.replay import read_event_stream, write_event_stream
from tidelog.workload import derive
from tidelog.workload.expected import (
    BATCH,
    D,
    ELEMENTS,
    ENDPOINT_ROWS,
    GLOBAL,
    ISO,
    LINES,
    PARSED_TRIMMED,
    PAYLOADS,
    RECORDS,
    REPLAY,
    SERVING,
    STATUS_SHARES,
    TIME,
    comparison,
    recent,
)
from tidelog.workload.frames import MINIMUM, RATIO, WINDOW, Frames, path_key, printed

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
EXPECTED: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Frames], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: printed(build(Frames(spark, sf_dir)))
        if sql is not None:
            EXPECTED[name] = sql
        return build

    return register


EVENT_ROW = f"""client_ip, {TIME.format('ts')} AS timestamp, method, endpoint, protocol,
    status_code, response_bytes, referrer, user_agent"""
COMPARED = comparison(RATIO, MINIMUM)

# ---------------------------------------------------------------- sources


@query("scan_raw_log", f"WITH {LINES} SELECT value FROM lines")
def _(f: Frames):
    return logs.read_lines(f.spark, f.line_files())


@query("scan_replay_log", f"WITH {LINES} SELECT trim(value) AS value FROM lines")
def _(f: Frames):
    lines = logs.read_replay_lines(f.spark, f.line_files())
    return lines.select(F.trim("value").alias("value"))


@query(
    "scan_event_table",
    f"""{BATCH} SELECT coalesce(reason, 'valid') AS kind, strftime(valid_ts, '%Y-%m-%d') AS event_date,
        strftime(valid_ts, '%H') AS event_hour, count(*) AS lines, min(CASE WHEN reason IS NOT NULL
        THEN raw_line END) AS first_rejected, sum(CASE WHEN reason IS NULL THEN response_bytes END)::BIGINT
        AS response_bytes
    FROM (SELECT *, CASE WHEN reason IS NULL THEN ts END AS valid_ts FROM parsed) p GROUP BY 1, 2, 3""",
)
def _(f: Frames):
    table = f.event_table()
    table.write(f.lines())  # A load that is written again replaces itself.
    return table.lines().groupBy("kind", "event_date", "event_hour").agg(
        F.count("*").alias("lines"),
        F.min("raw_line").alias("first_rejected"),
        F.sum("response_bytes").alias("response_bytes"),
    )


@query(
    "scan_stream_envelope",
    f"""{RECORDS} SELECT invocation, record_index, broken <> 'object' AS is_record,
    CASE WHEN broken <> 'object' AND id % 41 <> 9 THEN 'shard-' || id END AS event_id
    FROM records""",
)
def _(f: Frames):
    return f.records().select(
        "invocation",
        "record_index",
        F.col("record").isNotNull().alias("is_record"),
        F.try_variant_get("record", "$.eventID", "string").alias("event_id"),
    )


@query(
    "scan_delta_docs",
    f"""WITH e AS ({derive.elements(D)})
    SELECT 'doc-' || lpad(doc::VARCHAR, 10, '0') AS doc_key, doc % 10 NOT IN (8, 9) AS valid_document,
        CASE WHEN doc % 10 NOT IN (8, 9) THEN count(*) END AS events FROM e GROUP BY doc""",
)
def _(f: Frames):
    files = documents.read_documents(f.spark, f.document_files(f.delta_documents()), "*.txt")
    parsed = documents.parse_delta_documents(files)
    return parsed.select(
        path_key(F.col("doc_key")).alias("doc_key"),
        "valid_document",
        F.when(F.col("valid_document"), F.size("events").cast("bigint")).alias("events"),
    )


_METRICS = f"""WITH m AS ({derive.minute_counts(D)}),
    long AS (
        SELECT doc, 'requests_per_endpoint' AS metric, endpoint AS key, n::DOUBLE AS value FROM m
        UNION ALL SELECT doc, 'response_byte_totals', endpoint, bytes FROM m WHERE n <> 3
        UNION ALL SELECT doc, 'error_rates', endpoint, errors FROM m),
    rows AS (SELECT 'metrics-' || lpad(doc::VARCHAR, 10, '0') AS doc_key, metric, key, value FROM long)"""


@query("scan_metric_docs", f"{_METRICS} SELECT * FROM rows")
def _(f: Frames):
    files = documents.read_documents(f.spark, f.document_files(f.metric_documents()), "*.txt")
    rows = documents.metric_rows(documents.parse_metric_documents(files, "batch"))
    value = F.coalesce("rate", F.col("count").cast("double"))
    return rows.select(path_key(F.col("doc_key")).alias("doc_key"), "metric", "key", value.alias("value"))


@query(
    "sanitize_counts",
    f"""{_METRICS} SELECT doc_key, key, value::BIGINT AS value FROM rows
    WHERE metric = 'response_byte_totals'""",
)
def _(f: Frames):
    parsed = documents.parse_metric_documents(f.metric_documents(), "batch")
    return documents.sanitize_counts(parsed, "response_byte_totals")


@query("sanitize_rates", f"{_METRICS} SELECT doc_key, key, value FROM rows WHERE metric = 'error_rates'")
def _(f: Frames):
    return documents.sanitize_rates(documents.parse_metric_documents(f.metric_documents(), "batch"))


@query(
    "scan_baselines",
    f"""WITH m AS ({derive.minute_counts(D)})
    SELECT 'baseline-' || lpad(doc::VARCHAR, 10, '0') AS doc_key, endpoint,
        CASE WHEN doc % 3 = 2 AND errors = 0 THEN n + 1 ELSE n END::DOUBLE AS baseline_rpm
    FROM m WHERE NOT (doc % 3 = 0 AND n = 2)""",
)
def _(f: Frames):
    parsed = documents.parse_metric_documents(f.baseline_documents(), "batch")
    value = documents.baseline_value(F.col("metrics"), F.col("root"))
    return documents.read_baselines(parsed.select("doc_key", value.alias("baseline")))


_ALL_TABLES = f"""{BATCH},
    per_minute AS (SELECT endpoint, date_trunc('minute', ts) AS minute, count(*) AS n
                   FROM valid GROUP BY 1, 2)
    SELECT 'requests_per_endpoint' AS name, endpoint AS key, count(*) AS n, NULL::DOUBLE AS x
    FROM valid GROUP BY endpoint
    UNION ALL SELECT 'traffic_by_hour', hour(ts)::VARCHAR, count(*), NULL FROM valid GROUP BY 2
    UNION ALL SELECT 'error_rates', endpoint, count(*) FILTER (status_code >= 400),
        count(*) FILTER (status_code >= 400)::DOUBLE / count(*)::DOUBLE FROM valid GROUP BY endpoint
    UNION ALL SELECT 'status_code_distribution', status_code::VARCHAR, count(*), NULL
        FROM valid GROUP BY status_code
    UNION ALL SELECT 'response_byte_totals', endpoint, sum(response_bytes)::BIGINT, NULL
        FROM valid GROUP BY endpoint
    UNION ALL SELECT 'batch_summary', 'records', count(*), NULL FROM valid
    UNION ALL SELECT 'batch_summary', 'bytes', sum(response_bytes)::BIGINT, NULL FROM valid
    UNION ALL SELECT 'baseline_rpm', endpoint, NULL, avg(n) FROM per_minute GROUP BY endpoint"""


def _all_tables(found: dict[str, DataFrame]) -> DataFrame:
    def rows(name, key, n=None, x=None):
        return found[name].select(
            F.lit(name).alias("name"),
            key.cast("string").alias("key"),
            (F.lit(None) if n is None else F.col(n)).cast("bigint").alias("n"),
            (F.lit(None) if x is None else F.col(x)).cast("double").alias("x"),
        )

    endpoint = F.col("endpoint")
    parts = [
        rows("requests_per_endpoint", endpoint, "total_requests"),
        rows("traffic_by_hour", F.col("hour"), "request_count"),
        rows("error_rates", endpoint, "error_count", "error_rate"),
        rows("status_code_distribution", F.col("status_code"), "request_count"),
        rows("response_byte_totals", endpoint, "total_response_bytes"),
        rows("batch_summary", F.lit("records"), "total_valid_records"),
        rows("batch_summary", F.lit("bytes"), "total_response_bytes"),
        rows("baseline_rpm", endpoint, None, "avg_requests_per_minute"),
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


@query("scan_batch_tables", _ALL_TABLES)
def _(f: Frames):
    path = f.scratch("tables")
    sinks.write_batch_results(f.tables(), path, "csv")
    return _all_tables(tables.read_batch_tables(f.spark, path, "csv"))


_HEALTH = f"""{BATCH} SELECT count(*) AS total_valid_records,
    sum(response_bytes)::BIGINT AS total_response_bytes, count(*) AS status_record_count,
    count(*) FILTER (status_code >= 400) AS total_error_responses,
    count(*) FILTER (status_code >= 400)::DOUBLE / count(*)::DOUBLE AS overall_error_rate FROM valid"""


@query("create_database", _HEALTH)
def _(f: Frames):
    path, name = f.scratch("database"), f"tidelog_{uuid4().hex}"
    sinks.write_batch_results(f.tables(), path)
    tables.create_database(f.spark, name, path)
    reports.create_views(f.spark, name)
    found = stage(f.spark.table(f"{name}.batch_health_summary"), "health")
    f.spark.sql(f"DROP DATABASE {name} CASCADE")  # its tables are folders, which stay
    return found


@query(
    "generate_load_events",
    f"""WITH r AS ({derive.requests(D)}) SELECT client_ip, {TIME.format('make_timestamp(sec * 1000000)')} AS timestamp,
        method, '/load' AS endpoint, 'HTTP/1.1' AS protocol,
        CASE WHEN (id + 1) % 20 = 0 THEN 500 ELSE 200 END AS status_code,
        200 + id % 50 AS response_bytes, '-' AS referrer, 'tidelog-load' AS user_agent FROM r""",
)
def _(f: Frames):
    return generator.load_events(f.requests(), "/load")


# ---------------------------------------------------------------- sinks


@query("write_batch_results", _ALL_TABLES)
def _(f: Frames):
    path = f.scratch("results")
    batch.run_batch(f.spark, f.line_files(), path)
    return _all_tables(tables.read_batch_tables(f.spark, path))


_QUALITY = f"""{BATCH} SELECT count(*) AS total_raw_lines,
    count(*) FILTER (reason IS NULL) AS valid_records,
    count(reason) AS invalid_records,
    count(*) FILTER (reason = 'invalid_format') AS invalid_format_records,
    count(*) FILTER (reason = 'invalid_timestamp') AS invalid_timestamp_records,
    count(*) FILTER (reason = 'invalid_request') AS invalid_request_records,
    round(100.0::DOUBLE * count(reason) / count(*), 2) AS invalid_percentage FROM parsed"""


@query("write_data_quality", _QUALITY)
def _(f: Frames):
    path = f.scratch("quality")
    quality = parse.data_quality(parse.count_lines(f.parsed()))
    sinks.write_data_quality(quality, path, "csv")
    schema = ", ".join(f"{name} {kind}" for name, kind in quality.dtypes)
    return (
        f.spark.read.schema(schema).options(**tables.CSV_OPTIONS).csv(f"{path}/data_quality")
    )


@query(
    "write_rejected",
    f"""{BATCH}, sample AS (SELECT reason, raw_line FROM parsed WHERE reason IS NOT NULL
        ORDER BY reason, raw_line LIMIT 20)
    SELECT 'breakdown' AS kind, reason AS rejection_reason, count(*) AS n, NULL AS raw_line
    FROM parsed WHERE reason IS NOT NULL GROUP BY reason
    UNION ALL SELECT 'sample', reason, 1, raw_line FROM sample""",
)
def _(f: Frames):
    path, parsed = f.scratch("rejected"), f.parsed()
    breakdown = parse.rejected_breakdown(parse.count_lines(parsed))
    sample = parse.rejected_sample(parse.rejected_records(parsed))
    sinks.write_rejected(breakdown, sample, path, "csv")
    read = lambda name, schema: (
        f.spark.read.schema(schema).options(**tables.CSV_OPTIONS).csv(f"{path}/{name}")
    )
    counts = read("rejected_breakdown", "rejection_reason STRING, n BIGINT").select(
        F.lit("breakdown").alias("kind"), "rejection_reason", "n", F.lit(None).cast("string").alias("raw_line")
    )
    lines = read("rejected_sample", "raw_line STRING, rejection_reason STRING").select(
        F.lit("sample").alias("kind"), "rejection_reason", F.lit(1).cast("bigint").alias("n"), "raw_line"
    )
    return counts.unionByName(lines)


@query(
    "write_event_stream",
    f"""{REPLAY} SELECT client_ip AS partition_key, {TIME.format('ts')} AS timestamp, endpoint,
    status_code::BIGINT AS status_code, response_bytes, endpoint <> '' AS valid,
    'nginx_access_log' AS source FROM valid""",
)
def _(f: Frames):
    path = f.scratch("stream")
    write_event_stream(f.lines(), path, "run-1")
    sent = read_event_stream(f.spark, path)
    record = F.parse_json(F.to_json(F.struct("eventID", "kinesis")))
    decoded = events.decode_records(
        sent.select(
            F.col("kinesis.partitionKey").alias("partition_key"),
            F.lit(0).alias("record_index"),
            record.alias("record"),
        )
    )
    return decoded.select(
        "partition_key", "timestamp", "endpoint", "status_code", "response_bytes", "valid", "source"
    )


@query(
    "replay_ids",
    rf"""WITH {LINES}, trimmed AS (
        SELECT trim(regexp_replace(value, '\[[^]]*\]', '[01/Jan/2024:00:00:00 +0000]')) AS value FROM lines),
    {PARSED_TRIMMED},
    sent AS (SELECT endpoint, 'run-1-' || md5(chr(10) || raw_line) || '-'
        || (row_number() OVER (PARTITION BY raw_line) - 1) AS sequence_number FROM valid)
    SELECT endpoint, sequence_number, regexp_replace(md5(sequence_number),
        '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '\1-\2-\3-\4-\5') AS event_id FROM sent""",
)
def _(f: Frames):
    # With one time for all lines many are equal; each must keep an id of its own.
    at = F.regexp_replace("value", r"\[[^\]]*\]", "[01/Jan/2024:00:00:00 +0000]")
    records = replay_records(f.lines().select(F.trim(at).alias("value")), "run-1")
    event = lambda name: F.get_json_object("payload", f"$.{name}").alias(name)
    return records.select(event("endpoint"), "sequence_number", event("event_id"))


@query(
    "replay_statistics",
    f"""{REPLAY} SELECT count(*) AS total_lines, count(*) FILTER (reason IS NULL) AS valid_records,
    count(reason) AS invalid_lines, count(*) FILTER (reason IS NULL) AS successful_records,
    0::BIGINT AS failed_records, true AS batches_fit FROM parsed""",
)
def _(f: Frames):
    path = f.scratch("stream")
    write_event_stream(f.lines(), path, "run-1")
    return replay_statistics(f.lines(), read_event_stream(f.spark, path)).drop("batches_sent")


_DELTA = f"""{RECORDS} SELECT event_id,
    CASE WHEN identifier LIKE 'record-%' THEN '' ELSE identifier END AS sequence_number,
    {TIME.format('make_timestamp(sec * 1000000)')} AS timestamp, client_ip, method, endpoint,
    status::BIGINT AS status_code, size AS response_bytes, 'nginx_access_log' AS source,
    strftime(make_timestamp(sec * 1000000), '%Y-%m-%d') AS event_date,
    strftime(make_timestamp(sec * 1000000), '%H') AS event_hour FROM records WHERE valid"""


@query("write_delta", _DELTA)
def _(f: Frames):
    store = RecordStore(f.scratch("records"))
    rows = stage(record_rows(f.decoded(), 0), "record-rows")  # Both runs take the same decoded records.
    for _ in range(2):  # A micro-batch that runs again leaves the table as it was.
        store.write(rows, 0)
    return store.read(f.spark, VALID).select(
        "event_id",
        "sequence_number",
        "timestamp",
        "client_ip",
        "method",
        "endpoint",
        "status_code",
        "response_bytes",
        "source",
        "event_date",
        "event_hour",
    )


_STATISTICS = f"""(SELECT count(DISTINCT doc) FROM raw_elements) AS scanned_objects,
    (SELECT count(DISTINCT doc) FROM raw_elements WHERE doc % 10 NOT IN (8, 9)) AS valid_documents,
    (SELECT count(DISTINCT doc) FROM raw_elements WHERE doc % 10 IN (8, 9)) AS invalid_documents,
    count(*) AS raw_events, count(*) FILTER (event_class = 'unique') AS unique_events,
    count(*) FILTER (event_class = 'duplicate') AS duplicate_events,
    count(*) FILTER (event_class = 'invalid') AS invalid_events"""


@query(
    "write_snapshot",
    f"""{GLOBAL}, rows AS ({ENDPOINT_ROWS.format('recent')})
    SELECT {_STATISTICS}, (SELECT count(*) FROM recent) AS window_event_count,
    (SELECT count(*) FROM rows WHERE total_requests >= 2 AND error_rate >= 0.5) AS anomaly_count
    FROM classified""",
)
def _(f: Frames):
    path = f.scratch("snapshot")
    source = f.document_files(f.delta_documents())
    global_window.run_global(f.spark, source, path, WINDOW, pattern="*.txt")
    return f.spark.read.parquet(f"{path}/statistics")


@query(
    "write_serving_view",
    f"""{COMPARED}{STATUS_SHARES}
    SELECT 'endpoint_comparison' AS section, endpoint AS key, traffic_status AS status,
        recent_requests AS n FROM compared
    UNION ALL SELECT 'traffic_spikes', endpoint, traffic_status, recent_requests
        FROM compared WHERE significant_increase
    UNION ALL SELECT 'status_code_comparison', status_code, NULL, recent_count FROM status_compared
    UNION ALL SELECT 'recent_anomalies', endpoint, NULL, requests FROM now_side
        WHERE requests >= 2 AND error_rate >= 0.5
    UNION ALL SELECT 'about', '', NULL, 2
    UNION ALL SELECT 'window', '', NULL, {WINDOW}
    UNION ALL SELECT 'totals', '', NULL, (SELECT count(*) FROM recent)
    UNION ALL SELECT 'traffic_comparison', '', CASE
        WHEN (SELECT count(*) FROM recent) * 60.0::DOUBLE / {WINDOW} > (SELECT sum(baseline) FROM history)
        THEN 'above baseline' ELSE 'below baseline' END,
        (SELECT count(*) FROM compared WHERE significant_increase)""",
)
def _(f: Frames):
    path = f.scratch("serving")
    sinks.write_serving_view(_view(f), path)
    stored = {name: f.spark.read.parquet(f"{path}/{name}") for name in serving_sections()}
    sinks.write_view_lines(serving.view_lines(stored), f"{path}/lines")
    lines = f.spark.read.schema("section STRING, key STRING, body STRING").json(f"{path}/lines")
    number = F.coalesce(
        *[
            F.get_json_object("body", f"$.{name}").cast("double").cast("bigint")
            for name in (
                "recent_requests",
                "recent_count",
                "total_requests",
                "recent_window_seconds",
                "schema_version",
                "recent_valid_records",
                "significant_increase_count",
            )
        ]
    )
    status = F.get_json_object("body", "$.traffic_status")
    return lines.select("section", "key", status.alias("status"), number.alias("n"))


# ---------------------------------------------------------------- projections and filters


@query(
    "parse_access_log",
    f"""{BATCH} SELECT raw_line, client_ip, timestamp_raw, request_raw, status_code_raw,
    response_bytes_raw, referrer, user_agent, extra FROM groups""",
)
def _(f: Frames):
    return parse.access_log_groups(f.lines())


@query("normalize_timestamp_utc", f"{BATCH} SELECT raw_line, {TIME.format('ts')} AS timestamp FROM parsed")
def _(f: Frames):
    return f.parsed().select("raw_line", "timestamp")


@query("split_request", f"{BATCH} SELECT raw_line, method, endpoint, protocol FROM parsed")
def _(f: Frames):
    return f.parsed().select("raw_line", "method", "endpoint", "protocol")


@query("clean_response_bytes", f"{BATCH} SELECT raw_line, status_code, response_bytes FROM parsed")
def _(f: Frames):
    return f.parsed().select("raw_line", "status_code", "response_bytes")


@query(
    "validity_flags",
    f"{BATCH} SELECT raw_line, format_valid, timestamp_valid, request_valid FROM parsed",
)
def _(f: Frames):
    return f.parsed().select("raw_line", "format_valid", "timestamp_valid", "request_valid")


@query("valid_events", f"{BATCH} SELECT {EVENT_ROW} FROM valid")
def _(f: Frames):
    return f.events()


@query(
    "rejected_records",
    f"{BATCH} SELECT raw_line, reason AS rejection_reason FROM parsed WHERE reason IS NOT NULL",
)
def _(f: Frames):
    return parse.rejected_records(f.parsed())


@query(
    "enrich_stream_event",
    f"""{REPLAY} SELECT {EVENT_ROW}, 36 AS id_length, true AS has_ingest_time,
    'nginx_access_log' AS source FROM valid""",
)
def _(f: Frames):
    enriched = events.enrich_events(parse.replay_events(f.lines()))
    return enriched.withColumns(
        {"id_length": F.length("event_id"), "has_ingest_time": F.col("ingested_at").isNotNull()}
    ).drop("event_id", "ingested_at")


_MAYBE_IP = "CASE WHEN id % 17 = 0 THEN '' WHEN id % 19 = 0 THEN NULL ELSE client_ip END"


@query(
    "partition_key",
    f"""WITH r AS ({derive.requests(D)})
    SELECT id, CASE WHEN id % 17 = 0 OR id % 19 = 0 THEN 'unknown' ELSE client_ip END AS partition_key
    FROM r""",
)
def _(f: Frames):
    return f.requests().select("id", partition_key(F.expr(_MAYBE_IP)).alias("partition_key"))


@query(
    "encode_payload",
    f"""{REPLAY} SELECT client_ip AS partition_key, '{{"client_ip":"' || client_ip
        || '","timestamp":"' || {ISO.format('ts')} || '","method":"' || method
        || '","endpoint":"' || endpoint || '","protocol":"' || protocol
        || '","status_code":' || status_code || ',"response_bytes":' || response_bytes
        || ',"referrer":"' || referrer || '","user_agent":"' || user_agent
        || '","event_id":"' || user_agent || '","ingested_at":"' || {ISO.format('ts')}
        || '","source":"nginx_access_log"}}' AS payload
    FROM valid""",
)
def _(f: Frames):
    enriched = events.enrich_events(parse.replay_events(f.lines()), F.col("user_agent"))
    return events.encode_events(enriched.withColumn("ingested_at", F.col("timestamp")))


@query(
    "decode_envelope",
    f"""{RECORDS} SELECT invocation, record_index, identifier,
    CASE WHEN broken = '' THEN payload END AS payload FROM records""",
)
def _(f: Frames):
    return events.decode_envelopes(f.records())


@query(
    "decode_json_event",
    f"""{PAYLOADS} SELECT id, is_object, CASE WHEN is_object AND event_id <> '' THEN event_id END
    AS event_id, CASE WHEN is_object THEN endpoint_text END AS endpoint FROM payloads""",
)
def _(f: Frames):
    decoded = events.decode_payloads(f.payloads().select("id", "payload"))
    text = lambda name: F.try_variant_get("event", f"$.{name}", "string").alias(name)
    return decoded.select(
        "id", F.col("event").isNotNull().alias("is_object"), text("event_id"), text("endpoint")
    )


@query(
    "validate_event",
    f"""{PAYLOADS} SELECT id, valid,
    CASE WHEN valid THEN {TIME.format('make_timestamp(sec * 1000000)')} END AS timestamp,
    CASE WHEN valid THEN endpoint END AS endpoint,
    CASE WHEN valid THEN status::BIGINT END AS status_code,
    CASE WHEN valid THEN size END AS response_bytes FROM payloads""",
)
def _(f: Frames):
    checked = events.validate_events(events.decode_payloads(f.payloads().select("id", "payload")))
    if_valid = lambda name: F.when(F.col("valid"), F.col(name)).alias(name)
    return checked.select(
        "id", "valid", *map(if_valid, ["timestamp", "endpoint", "status_code", "response_bytes"])
    )


@query("record_identifier", f"{RECORDS} SELECT invocation, record_index, identifier FROM records")
def _(f: Frames):
    identifier = events.record_identifier(F.col("record"), F.col("record_index"))
    return f.records().select("invocation", "record_index", identifier.alias("identifier"))


@query(
    "batch_item_failures",
    f"""{RECORDS} SELECT record_index, identifier AS item_identifier FROM records WHERE NOT valid""",
)
def _(f: Frames):
    return events.batch_item_failures(f.decoded())


@query(
    "valid_delta_documents",
    f"""WITH e AS ({derive.elements(D)})
    SELECT 'doc-' || lpad(doc::VARCHAR, 10, '0') AS doc_key, count(*) AS events
    FROM e WHERE doc % 10 NOT IN (8, 9) GROUP BY doc""",
)
def _(f: Frames):
    parsed = documents.parse_delta_documents(f.delta_documents()).filter("valid_document")
    return parsed.select("doc_key", F.size("events").cast("bigint").alias("events"))


@query(
    "event_identity",
    f"""{ELEMENTS}, copies AS (SELECT identity, count(*) AS copies FROM placed
        WHERE identity IS NOT NULL GROUP BY identity)
    SELECT CASE identity[1] WHEN 'i' THEN 'event_id' WHEN 's' THEN 'sequence_number'
           ELSE 'fallback' END AS kind, copies, count(*) AS identities
    FROM copies GROUP BY 1, 2""",
)
def _(f: Frames):
    identified = dedup.delta_events(f.delta_documents()).filter(F.col("identity").isNotNull())
    copies = identified.groupBy("identity").agg(F.count("*").alias("copies"))
    kind = F.substring_index("identity", ":", 1)
    return copies.groupBy(kind.alias("kind"), "copies").agg(F.count("*").alias("identities"))


_LOOSE_TIME = "CASE id % 4 WHEN 0 THEN {iso} WHEN 1 THEN {iso} || 'Z' WHEN 2 THEN {iso} || '+00:00' END"


@query(
    "lenient_utc",
    f"""WITH r AS ({derive.requests(D)}) SELECT id, id % 4 = 3 AS is_now,
    CASE WHEN id % 4 < 3 THEN {TIME.format('make_timestamp(sec * 1000000)')} END AS timestamp FROM r""",
)
def _(f: Frames):
    text = F.expr(_LOOSE_TIME.format(iso=f.dialect.iso_time("sec")))
    read = f.requests().select("id", text.alias("text")).withColumn("timestamp", lenient_utc(F.col("text")))
    now = F.col("text").isNull() & F.col("timestamp").isNotNull()
    return read.select(
        "id", now.alias("is_now"), F.when(~now, F.col("timestamp")).alias("timestamp")
    )


@query(
    "endpoint_count_lookup",
    f"""{recent()}, asked AS (SELECT DISTINCT endpoint FROM parsed)
    SELECT asked.endpoint, count(recent.endpoint) AS request_count
    FROM asked LEFT JOIN recent ON recent.endpoint = asked.endpoint GROUP BY asked.endpoint""",
)
def _(f: Frames):
    asked = f.parsed().select("endpoint").distinct()
    return window.endpoint_count(aggregates.requests_per_endpoint(f.window_facts()), asked)


@query(
    "sanitize_key",
    f"""WITH r AS ({derive.requests(D)})
    SELECT id, trim(regexp_replace(endpoint || ' @ ' || client_ip || '?', '[^A-Za-z0-9._-]+', '-', 'g'), '-')
    AS safe_key FROM r""",
)
def _(f: Frames):
    text = F.concat("endpoint", F.lit(" @ "), "client_ip", F.lit("?"))
    return f.requests().select("id", sanitize_key(text).alias("safe_key"))


# ---------------------------------------------------------------- joins


@query(
    "endpoint_historical_summary",
    f"""{BATCH}, m AS (SELECT endpoint, date_trunc('minute', ts) AS minute, count(*) AS n,
        count(*) FILTER (status_code >= 400) AS errors, sum(response_bytes) AS bytes
        FROM valid GROUP BY 1, 2)
    SELECT endpoint, sum(n)::BIGINT AS total_requests, sum(errors)::BIGINT AS error_count,
        sum(errors)::DOUBLE / sum(n)::DOUBLE AS error_rate,
        sum(bytes)::BIGINT AS total_response_bytes, avg(n) AS avg_requests_per_minute
    FROM m GROUP BY endpoint""",
)
def _(f: Frames):
    return aggregates.endpoint_summary(f.facts())


@query("batch_health_summary", _HEALTH)
def _(f: Frames):
    return reports.run_report(f.spark, "batch_health_summary", f.tables())


@query(
    "reconcile_batch",
    f"""{BATCH}, t AS (SELECT count(*) AS records, sum(response_bytes)::BIGINT AS bytes FROM valid)
    SELECT validation_check, expected_value, expected_value AS actual_value,
        'PASS' AS validation_status
    FROM (SELECT 'requests_per_endpoint record total' AS validation_check, records AS expected_value FROM t
          UNION ALL SELECT 'traffic_by_hour record total', records FROM t
          UNION ALL SELECT 'status_code_distribution record total', records FROM t
          UNION ALL SELECT 'response_byte_totals byte total', bytes FROM t) c""",
)
def _(f: Frames):
    return reports.run_report(f.spark, "reconcile_batch", f.tables())


@query(
    "endpoint_comparison",
    f"""{COMPARED} SELECT endpoint, historical_requests, recent_requests, historical_error_rate,
    recent_error_rate, error_rate_difference, historical_response_bytes, recent_response_bytes
    FROM compared""",
)
def _(f: Frames):
    return _compared(f).select(
        "endpoint",
        "historical_requests",
        "recent_requests",
        "historical_error_rate",
        "recent_error_rate",
        "error_rate_difference",
        "historical_response_bytes",
        "recent_response_bytes",
    )


@query("status_code_comparison", f"{SERVING}{STATUS_SHARES} SELECT * FROM status_compared")
def _(f: Frames):
    past, now = f.sides()
    return serving.compare_status_codes(
        aggregates.status_code_distribution(past), aggregates.status_code_distribution(now)
    )


@query("window_bound_join", f"{recent(300)} SELECT {EVENT_ROW} FROM recent")
def _(f: Frames):
    return f.event_table().window(300)


_SIDE = """SELECT 'total_valid_records' AS metric, '' AS key, '' AS field, count(*)::DOUBLE AS value FROM {0}
    UNION ALL SELECT 'total_response_bytes', '', '', sum(response_bytes) FROM {0}
    UNION ALL SELECT 'requests_per_endpoint', endpoint, '', count(*) FROM {0} GROUP BY endpoint
    UNION ALL SELECT 'error_rates', endpoint, 'total_requests', count(*) FROM {0} GROUP BY endpoint
    UNION ALL SELECT 'error_rates', endpoint, 'error_count', count(*) FILTER (status_code >= 400)
        FROM {0} GROUP BY endpoint
    UNION ALL SELECT 'error_rates', endpoint, 'error_rate',
        count(*) FILTER (status_code >= 400)::DOUBLE / count(*)::DOUBLE FROM {0} GROUP BY endpoint
    UNION ALL SELECT 'traffic_by_hour', hour(ts)::VARCHAR, '', count(*) FROM {0} GROUP BY hour(ts)
    UNION ALL SELECT 'status_code_distribution', status_code::VARCHAR, '', count(*) FROM {0}
        GROUP BY status_code
    UNION ALL SELECT 'response_byte_totals', endpoint, '', sum(response_bytes) FROM {0}
        GROUP BY endpoint"""


@query(
    "batch_stream_parity",
    f"""{REPLAY}, batch_side AS (SELECT * FROM valid WHERE raw_line IN (SELECT value FROM lines)),
    stream_valid AS (SELECT * FROM valid WHERE endpoint <> ''),
    stream_side AS (SELECT * FROM stream_valid
        WHERE ts >= (SELECT max(ts) FROM stream_valid) - INTERVAL 300 SECOND),
    b AS ({_SIDE.format('batch_side')}), s AS ({_SIDE.format('stream_side')})
    SELECT metric, key, field, b.value AS batch_value, s.value AS stream_value,
        CASE WHEN b.value IS NULL THEN 'missing from batch'
             WHEN s.value IS NULL THEN 'missing from stream'
             WHEN abs(b.value - s.value)
                  <= greatest(1e-9 * greatest(abs(b.value), abs(s.value)), 1e-12) THEN 'equal'
             ELSE 'different' END AS outcome
    FROM b FULL JOIN s USING (metric, key, field)""",
)
def _(f: Frames):
    return batch_stream_values(f.event_table(), 300)


@query(
    "parity_by_metric",
    f"""{REPLAY}, batch_side AS (SELECT * FROM valid WHERE raw_line IN (SELECT value FROM lines)),
    stream_side AS (SELECT * FROM valid WHERE endpoint <> ''),
    b AS ({_SIDE.format('batch_side')}), s AS ({_SIDE.format('stream_side')})
    SELECT metric, count(*) FILTER (NOT coalesce(abs(b.value - s.value)
        <= greatest(1e-9 * greatest(abs(b.value), abs(s.value)), 1e-12), false)) AS differences,
        differences = 0 AS match
    FROM b FULL JOIN s USING (metric, key, field) GROUP BY metric""",
)
def _(f: Frames):
    whole_log = 1_000_000_000  # A window over everything, as in a controlled comparison.
    return parity.compare_metrics(batch_stream_values(f.event_table(), whole_log))


# ---------------------------------------------------------------- aggregates


@query("requests_per_endpoint", f"{BATCH} SELECT endpoint, count(*) AS total_requests FROM valid GROUP BY 1")
def _(f: Frames):
    return aggregates.requests_per_endpoint(f.facts())


@query("traffic_by_hour", f"{BATCH} SELECT hour(ts)::INT AS hour, count(*) AS request_count FROM valid GROUP BY 1")
def _(f: Frames):
    return aggregates.traffic_by_hour(f.facts())


_ERROR_RATES = """SELECT endpoint, count(*) AS total_requests,
    count(*) FILTER (status_code >= 400) AS error_count,
    count(*) FILTER (status_code >= 400)::DOUBLE / count(*)::DOUBLE AS error_rate
    FROM {} GROUP BY endpoint"""


@query("error_rates", f"{BATCH} {_ERROR_RATES.format('valid')}")
def _(f: Frames):
    return aggregates.error_rates(f.facts())


@query("aggregate_output_order", f"{BATCH} {_ERROR_RATES.format('valid')} ORDER BY 4 DESC, 1")
def _(f: Frames):
    return aggregates.in_output_order("error_rates", aggregates.error_rates(f.facts()))


_STATUS = "SELECT status_code, count(*) AS request_count FROM {} GROUP BY 1"


@query("status_code_distribution", f"{BATCH} {_STATUS.format('valid')}")
def _(f: Frames):
    return aggregates.status_code_distribution(f.facts())


_BYTES = "SELECT endpoint, sum(response_bytes)::BIGINT AS total_response_bytes FROM {} GROUP BY 1"


@query("response_byte_totals", f"{BATCH} {_BYTES.format('valid')}")
def _(f: Frames):
    return aggregates.response_byte_totals(f.facts())


@query(
    "batch_summary",
    f"""{BATCH} SELECT count(*) AS total_valid_records,
    sum(response_bytes)::BIGINT AS total_response_bytes FROM valid""",
)
def _(f: Frames):
    return aggregates.batch_summary(f.facts())


_PER_MINUTE = "m AS (SELECT endpoint, date_trunc('minute', ts) AS t, count(*) AS n FROM valid GROUP BY 1, 2)"


@query("baseline_rpm", f"{BATCH}, {_PER_MINUTE} SELECT endpoint, avg(n) AS avg_requests_per_minute FROM m GROUP BY 1")
def _(f: Frames):
    return aggregates.baseline_rpm(f.facts())


@query("data_quality", _QUALITY)
def _(f: Frames):
    return parse.data_quality(parse.count_lines(f.parsed()))


@query(
    "rejected_breakdown",
    f"""{BATCH} SELECT reason AS rejection_reason, count(*) AS count FROM parsed
    WHERE reason IS NOT NULL GROUP BY 1""",
)
def _(f: Frames):
    return parse.rejected_breakdown(parse.count_lines(f.parsed()))


@query("window_requests_per_endpoint", f"{recent()} SELECT endpoint, count(*) AS total_requests FROM recent GROUP BY 1")
def _(f: Frames):
    return aggregates.requests_per_endpoint(f.window_facts())


@query("window_error_rates", f"{recent()} {_ERROR_RATES.format('recent')}")
def _(f: Frames):
    return aggregates.error_rates(f.window_facts())


@query("window_traffic_by_hour", f"{recent()} SELECT hour(ts)::INT AS hour, count(*) AS request_count FROM recent GROUP BY 1")
def _(f: Frames):
    return aggregates.traffic_by_hour(f.window_facts())


@query("window_status_distribution", f"{recent()} {_STATUS.format('recent')}")
def _(f: Frames):
    return aggregates.status_code_distribution(f.window_facts())


@query("window_response_bytes", f"{recent()} {_BYTES.format('recent')}")
def _(f: Frames):
    return aggregates.response_byte_totals(f.window_facts())


@query(
    "window_summary",
    f"""{recent()} SELECT {WINDOW} AS window_seconds,
    {ISO.format(f"max(ts) - INTERVAL {WINDOW} SECOND")} AS window_start,
    {ISO.format('max(ts)')} AS window_end, count(*) AS window_event_count,
    count(*) AS total_valid_records, sum(response_bytes)::BIGINT AS total_response_bytes,
    round(count(*) * 60.0::DOUBLE / {WINDOW}, 6) AS recent_rpm FROM recent""",
)
def _(f: Frames):
    return window.window_summary(f.window_facts(), WINDOW)


@query(
    "error_anomalies",
    f"""{recent(300)}, rates AS ({_ERROR_RATES.format('recent')})
    SELECT *, 'recent error rate reached the configured threshold' AS reason FROM rates
    WHERE total_requests >= 2 AND error_rate >= 0.5""",
)
def _(f: Frames):
    return window.window_anomalies(aggregates.unit_facts(f.window(300)))


_SENT = f"""{RECORDS}, accepted AS (
        SELECT endpoint, make_timestamp(sec * 1000000) AS ts, status AS status_code,
            size AS response_bytes, invocation, record_index,
            CASE WHEN event_id <> '' THEN 'e:' || event_id
                 WHEN identifier NOT LIKE 'record-%' THEN 's:' || identifier
                 ELSE 'f:' || time_text || client_ip || method || endpoint_text || status_text
                     || size_text END AS identity
        FROM records WHERE valid),
    recent AS (SELECT * FROM accepted
               WHERE ts >= (SELECT max(ts) FROM accepted) - INTERVAL {WINDOW} SECOND)"""


@query(
    "invocation_summary",
    f"""{_SENT} SELECT count(*) AS received_records, count(*) FILTER (valid) AS processed_records,
    count(*) FILTER (NOT valid) AS invalid_records,
    (SELECT count(*) FROM recent) AS window_event_count,
    (SELECT count(*) FROM ({_ERROR_RATES.format('recent')}) r
     WHERE total_requests >= 2 AND error_rate >= 0.5) AS anomaly_count FROM records""",
)
def _(f: Frames):
    decoded = stage(f.decoded().drop("event", "payload"), "decoded")
    seen = window.recent_window(decoded.filter("valid"), WINDOW)
    anomalies = window.window_anomalies(aggregates.unit_facts(seen))
    return events.invocation_summary(
        decoded, seen.agg(F.count("*")).scalar(), anomalies.agg(F.count("*")).scalar()
    )


@query("aggregation_statistics", f"{ELEMENTS} SELECT {_STATISTICS} FROM classified")
def _(f: Frames):
    return dedup.aggregation_statistics(f.classified())


_PASSED = "(id * 13 % 1000) * 1000 + 100000"
_LATENCY = f"""{PAYLOADS}, timed AS (
        SELECT id, valid, CASE WHEN valid AND {_PASSED} >= ingest_micros::BIGINT
            THEN {_PASSED} - ingest_micros::BIGINT END AS micros FROM payloads)"""
_LATENCY_ROW = """count(*) AS records_attempted, count(*) FILTER (valid) AS records_processed,
    count(*) FILTER (NOT valid) AS invalid_records, 2.0::DOUBLE AS runtime_seconds,
    count(*) FILTER (valid) / 2.0::DOUBLE AS throughput_records_per_second,
    count(micros) AS latency_samples, min(micros) / 1000.0::DOUBLE AS latency_min_ms,
    avg(micros) / 1000.0::DOUBLE AS latency_mean_ms,
    quantile_cont(micros, 0.5) / 1000.0::DOUBLE AS latency_p50_ms,
    round(quantile_cont(micros, 0.95) / 1000.0::DOUBLE, 6) AS latency_p95_ms,
    max(micros) / 1000.0::DOUBLE AS latency_max_ms"""


def _latency(f: Frames, payloads: DataFrame) -> DataFrame:
    processed = F.timestamp_micros(F.expr(f"sec * 1000000 + {_PASSED}"))
    kept = payloads.select("id", processed.alias("processed_at"), "payload")
    checked = events.validate_events(events.decode_payloads(kept))
    measured = latency.stream_latency(checked, 2.0)
    return measured.withColumn("latency_p95_ms", F.round("latency_p95_ms", 6))


@query("stream_latency", f"{_LATENCY} SELECT {_LATENCY_ROW} FROM timed")
def _(f: Frames):
    return _latency(f, f.payloads())


@query("sampled_latency", f"{_LATENCY} SELECT {_LATENCY_ROW} FROM timed WHERE (id + 1) % 10 = 0")
def _(f: Frames):
    return _latency(f, latency.every_nth(f.payloads(), 10, F.col("id") + 1))


@query(
    "overall_traffic_comparison",
    f"""{SERVING}, rates AS (
        SELECT round((SELECT sum(baseline) FROM history), 6) AS baseline_rpm,
            round((SELECT count(*) FROM recent) * 60.0::DOUBLE / {WINDOW}, 6) AS recent_rpm)
    SELECT baseline_rpm, recent_rpm, true AS comparison_available,
        round(recent_rpm - baseline_rpm, 6) AS rpm_difference,
        round(recent_rpm / baseline_rpm, 6) AS recent_to_baseline_ratio,
        CASE WHEN recent_rpm > baseline_rpm THEN 'above baseline'
             WHEN recent_rpm < baseline_rpm THEN 'below baseline'
             ELSE 'equal to baseline' END AS traffic_status FROM rates""",
)
def _(f: Frames):
    past, now = map(_metrics, f.sides())
    return serving.overall_traffic(
        serving.side_totals(past), serving.side_totals(now), F.lit(WINDOW)
    )


@query(
    "serving_totals",
    f"""{SERVING} SELECT (SELECT count(*) FROM past) AS historical_valid_records,
    (SELECT count(*) FROM recent) AS recent_valid_records,
    (SELECT sum(response_bytes)::BIGINT FROM past) AS historical_response_bytes,
    (SELECT sum(response_bytes)::BIGINT FROM recent) AS recent_response_bytes""",
)
def _(f: Frames):
    past, now = map(_metrics, f.sides())
    return serving.serving_totals(serving.side_totals(past), serving.side_totals(now))


@query(
    "spike_summary",
    f"""{COMPARED} SELECT {RATIO}::DOUBLE AS traffic_spike_ratio,
    {MINIMUM} AS minimum_requests_for_traffic_spike,
    count(historical_baseline_rpm) AS endpoint_baselines_available,
    count(*) FILTER (comparison_available) AS endpoints_compared,
    count(*) FILTER (significant_increase) AS significant_increase_count FROM compared""",
)
def _(f: Frames):
    return serving.spike_summary(_compared(f), RATIO, MINIMUM)


@query(
    "scaling_efficiency",
    f"""WITH r AS ({derive.requests(D)}),
    runs AS (SELECT sec // 600 AS job, (1 + id % 4)::INT AS workers, sum(size)::DOUBLE AS elapsed_sec
             FROM r GROUP BY 1, 2)
    SELECT a.job, a.workers, a.elapsed_sec,
        round(coalesce(b.elapsed_sec / a.elapsed_sec, 1.0), 3) AS speedup,
        round(coalesce(b.elapsed_sec / a.elapsed_sec, 1.0) / a.workers, 3) AS efficiency
    FROM runs a LEFT JOIN runs b ON b.job = a.job AND b.workers = 1""",
)
def _(f: Frames):
    runs = (
        f.requests()
        .groupBy(F.expr("sec div 600").alias("job"), F.expr("cast(1 + id % 4 as int)").alias("workers"))
        .agg(F.sum("size").cast("double").alias("elapsed_sec"))
    )
    return latency.scaling_efficiency(runs, ["job"])


@query(
    "event_validation_profile",
    f"""{PAYLOADS}, e AS (SELECT * FROM payloads WHERE valid)
    SELECT 'decoded_events' AS item, count(*)::VARCHAR AS value, count(*) AS events FROM e
    UNION ALL SELECT 'event_ids_present', CASE WHEN bool_and(event_id <> '') THEN 'true' ELSE 'false' END,
        count(*) FILTER (event_id <> '') FROM e
    UNION ALL SELECT 'source', 'nginx_access_log', count(*) FROM e
    UNION ALL SELECT 'endpoint', endpoint, count(*) FROM e GROUP BY endpoint""",
)
def _(f: Frames):
    checked = events.validate_events(events.decode_payloads(f.payloads().select("payload")))
    return events.validation_profile(checked.filter("valid"))


# ---------------------------------------------------------------- window and duplicates


@query("recent_window", f"{recent()} SELECT {EVENT_ROW} FROM recent")
def _(f: Frames):
    return f.window()


@query(
    "dedup_events",
    f"{ELEMENTS} SELECT doc_key, position, event_class FROM classified",
)
def _(f: Frames):
    counted = f.classified().filter(F.col("position").isNotNull())
    return counted.select("doc_key", "position", "event_class")


@query("global_window", f"{GLOBAL} {ENDPOINT_ROWS.format('recent')}")
def _(f: Frames):
    _, seen = global_window.global_window(f.delta_documents(), WINDOW)
    return global_window.window_sections(aggregates.unit_facts(seen), WINDOW)["endpoints"]


@query("incremental_window", f"{GLOBAL} {ENDPOINT_ROWS.format('recent')}")
def _(f: Frames):
    return f.incremental().read_snapshot(f.spark, "endpoints").select(
        "endpoint", "total_requests", "error_count", "error_rate", "total_response_bytes"
    )


@query(
    "incremental_statistics",
    f"{ELEMENTS} SELECT {_STATISTICS} FROM classified",
)
def _(f: Frames):
    return f.incremental().statistics(f.spark)


@query(
    "local_window",
    f"""{RECORDS}, accepted AS (SELECT client_ip, endpoint, make_timestamp(sec * 1000000) AS ts
        FROM records WHERE valid),
    bounds AS (SELECT client_ip, max(ts) AS newest FROM accepted GROUP BY client_ip)
    SELECT client_ip, endpoint, count(*) AS total_requests
    FROM accepted JOIN bounds USING (client_ip) WHERE ts >= newest - INTERVAL {WINDOW} SECOND
    GROUP BY client_ip, endpoint""",
)
def _(f: Frames):
    # Records are dealt by client, so a window of one consumer is a window by client.
    accepted = stage(f.decoded().filter("valid").select("client_ip", "endpoint", "timestamp"), "accepted")
    seen = window.recent_window(accepted, WINDOW, by=["client_ip"])
    return seen.groupBy("client_ip", "endpoint").agg(F.count("*").alias("total_requests"))


@query(
    "window_by_client",
    f"""{BATCH}, bounds AS (SELECT client_ip, max(ts) AS newest FROM valid GROUP BY client_ip)
    SELECT client_ip, endpoint, count(*) AS total_requests
    FROM valid JOIN bounds USING (client_ip) WHERE ts >= newest - INTERVAL {WINDOW} SECOND
    GROUP BY client_ip, endpoint""",
)
def _(f: Frames):
    seen = window.recent_window(f.event_table().events(), WINDOW, by=["client_ip"])
    return seen.groupBy("client_ip", "endpoint").agg(F.count("*").alias("total_requests"))


@query(
    "recent_rpm",
    f"""{recent()} SELECT endpoint, round(count(*) * 60.0::DOUBLE / {WINDOW}, 6) AS recent_rpm
    FROM recent GROUP BY endpoint""",
)
def _(f: Frames):
    counts = aggregates.requests_per_endpoint(f.window_facts())
    return counts.select(
        "endpoint", recent_rpm(F.col("total_requests"), F.lit(WINDOW)).alias("recent_rpm")
    )


@query(
    "stream_job",
    f"""{_SENT}, firsts AS (
        SELECT * FROM recent QUALIFY row_number() OVER (
            PARTITION BY identity
            ORDER BY invocation, record_index) = 1)
    {ENDPOINT_ROWS.format('firsts')}""",
)
def _(f: Frames):
    source, root = f.scratch("arrivals"), f.scratch("stream-job")
    lines = f.invocations().select("value").hint("rebalance")
    lines.write.option("maxRecordsPerFile", 50_000).text(source)
    job = StreamJob(root, WINDOW)
    job.start(f.spark, source, f"{root}/checkpoint", files_per_trigger=2).awaitTermination()
    return job.read_snapshot(f.spark, "endpoints")


# ---------------------------------------------------------------- reports


def _report(name: str, sql: str) -> None:
    @query(name, sql)
    def _(f: Frames):
        found = f.tables()
        found["endpoint_historical_summary"] = aggregates.endpoint_summary(
            aggregates.minute_facts(f.events())
        )
        return reports.run_report(f.spark, name, found)


_report(
    "top_endpoints",
    f"{BATCH} SELECT endpoint, count(*) AS total_requests FROM valid GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
)
_report(
    "hourly_traffic_report",
    f"{BATCH} SELECT hour(ts)::INT AS hour, count(*) AS request_count FROM valid GROUP BY 1 ORDER BY 1",
)
_report(
    "top_error_endpoints",
    f"""{BATCH}, r AS ({_ERROR_RATES.format('valid')}) SELECT endpoint, total_requests, error_count,
    round(error_rate * 100, 4) AS error_percentage FROM r
    ORDER BY error_count DESC, error_rate DESC, total_requests DESC, endpoint LIMIT 10""",
)
_report(
    "status_percentage",
    f"""{BATCH}, s AS ({_STATUS.format('valid')}) SELECT status_code, request_count,
    round(100.0::DOUBLE * request_count / (SELECT sum(request_count) FROM s)::DOUBLE, 4)
        AS percentage_of_requests FROM s""",
)
_report(
    "top_byte_endpoints",
    f"{BATCH} {_BYTES.format('valid')} ORDER BY 2 DESC, 1 LIMIT 10",
)
_report(
    "top_baseline_endpoints",
    f"""{BATCH}, {_PER_MINUTE} SELECT endpoint, round(avg(n), 4) AS avg_requests_per_minute
    FROM m GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
)
_report(
    "combined_endpoint_report",
    f"""{BATCH}, {_PER_MINUTE}, b AS (SELECT endpoint, avg(n) AS rpm FROM m GROUP BY 1),
    r AS ({ENDPOINT_ROWS.format('valid')})
    SELECT r.endpoint, total_requests, error_count, round(error_rate * 100, 4) AS error_percentage,
        total_response_bytes, round(rpm, 4) AS avg_requests_per_minute
    FROM r JOIN b ON b.endpoint = r.endpoint ORDER BY total_requests DESC, r.endpoint LIMIT 10""",
)


@query(
    "rejected_sample",
    f"""{BATCH} SELECT raw_line, reason AS rejection_reason FROM parsed WHERE reason IS NOT NULL
    ORDER BY reason, raw_line LIMIT 20""",
)
def _(f: Frames):
    return parse.rejected_sample(parse.rejected_records(f.parsed()))


# ---------------------------------------------------------------- serving


def _compared(f: Frames) -> DataFrame:
    past, now = map(_metrics, f.sides())
    return serving.compare_endpoints(past, now, F.lit(WINDOW), RATIO, MINIMUM)


def _metrics(facts: DataFrame) -> DataFrame:
    return serving.endpoint_metrics(aggregates.endpoint_summary(facts))


def _view(f: Frames) -> dict[str, DataFrame]:
    past, now = f.sides()
    return serving.combined_view(
        _metrics(past),
        _metrics(now),
        aggregates.status_code_distribution(past),
        aggregates.status_code_distribution(now),
        window.window_summary(now, WINDOW),
        window.window_anomalies(now),
        RATIO,
        MINIMUM,
    )


def serving_sections() -> list[str]:
    return [
        "window",
        "totals",
        "traffic_comparison",
        "endpoint_comparison",
        "traffic_spikes",
        "status_code_comparison",
        "recent_anomalies",
        "about",
    ]


_SPIKES = f"""{COMPARED} SELECT endpoint, recent_requests, historical_baseline_rpm, recent_rpm,
    rpm_difference, recent_to_baseline_ratio, traffic_status FROM compared WHERE significant_increase"""


@query("traffic_spikes", _SPIKES)
def _(f: Frames):
    return serving.traffic_spikes(_compared(f))


@query(
    "ranked_spikes",
    f"""WITH s AS ({_SPIKES}) SELECT *, row_number() OVER (ORDER BY recent_to_baseline_ratio DESC NULLS FIRST,
    recent_rpm DESC, endpoint) AS rank FROM s""",
)
def _(f: Frames):
    return serving.ranked_spikes(serving.traffic_spikes(_compared(f)))


@query(
    "traffic_comparison",
    f"""{COMPARED} SELECT endpoint, historical_baseline_rpm, recent_rpm, comparison_available,
    rpm_difference, recent_to_baseline_ratio, traffic_status, significant_increase,
    spike_ratio_threshold, minimum_requests_threshold, minimum_requests_met FROM compared""",
)
def _(f: Frames):
    return _compared(f).drop(
        "historical_requests",
        "recent_requests",
        "historical_error_rate",
        "recent_error_rate",
        "error_rate_difference",
        "historical_response_bytes",
        "recent_response_bytes",
    )


@query(
    "endpoint_universe",
    f"{SERVING} SELECT endpoint FROM history UNION SELECT endpoint FROM now_side ORDER BY 1",
)
def _(f: Frames):
    return serving.endpoint_universe(*f.sides())


@query(
    "single_endpoint_scalar_baseline",
    f"""{BATCH}, known AS (SELECT DISTINCT client_ip, strftime(ts, '%H:%M') AS minute, endpoint FROM valid),
    counted AS (SELECT client_ip, minute, min(endpoint) AS endpoint, count(*) AS n FROM known GROUP BY 1, 2),
    scalar AS (SELECT client_ip, strftime(ts, '%H:%M') AS minute, count(*)::DOUBLE AS baseline_rpm
               FROM valid GROUP BY 1, 2)
    SELECT client_ip, minute, endpoint, baseline_rpm FROM counted JOIN scalar USING (client_ip, minute)
    WHERE n = 1""",
)
def _(f: Frames):
    seen = f.events().select("client_ip", F.date_format("timestamp", "HH:mm").alias("minute"), "endpoint")
    by = ["client_ip", "minute"]
    scalar = seen.groupBy(*by).agg(F.count("*").cast("double").alias("baseline_scalar"))
    return serving.single_endpoint_baseline(seen.distinct(), scalar, by)


@query(
    "combined_view",
    f"""{COMPARED}{STATUS_SHARES},
    spikes AS (SELECT * FROM compared WHERE significant_increase)
    SELECT 'endpoint_comparison' AS section, endpoint AS key, traffic_status AS label,
        recent_requests::DOUBLE AS a, rpm_difference AS b, error_rate_difference AS c FROM compared
    UNION ALL SELECT 'traffic_spikes', endpoint, traffic_status, recent_requests, rpm_difference,
        recent_to_baseline_ratio FROM spikes
    UNION ALL SELECT 'status_code_comparison', status_code, '', recent_count, historical_share,
        share_difference FROM status_compared
    UNION ALL SELECT 'recent_anomalies', endpoint, '', requests, error_rate, NULL FROM now_side
        WHERE requests >= 2 AND error_rate >= 0.5
    UNION ALL SELECT 'window', '', (SELECT {ISO.format('max(ts)')} FROM recent), {WINDOW}, NULL, NULL
    UNION ALL SELECT 'totals', '', '', (SELECT count(*) FROM past), (SELECT count(*) FROM recent),
        (SELECT sum(response_bytes) FROM recent)
    UNION ALL SELECT 'traffic_comparison', '', '',
        round((SELECT count(*) FROM recent) * 60.0::DOUBLE / {WINDOW}, 6),
        (SELECT count(*) FROM spikes), (SELECT count(*) FROM history)""",
)
def _(f: Frames):
    view = _view(f)

    def rows(section, key, label, a, b, c):
        number = lambda name: (F.lit(None) if name is None else F.col(name)).cast("double")
        return view[section].select(
            F.lit(section).alias("section"),
            (F.lit("") if key is None else F.col(key)).alias("key"),
            (F.lit("") if label is None else F.col(label)).alias("label"),
            number(a).alias("a"),
            number(b).alias("b"),
            number(c).alias("c"),
        )

    parts = [
        rows("endpoint_comparison", "endpoint", "traffic_status", "recent_requests",
             "rpm_difference", "error_rate_difference"),
        rows("traffic_spikes", "endpoint", "traffic_status", "recent_requests",
             "rpm_difference", "recent_to_baseline_ratio"),
        rows("status_code_comparison", "status_code", None, "recent_count",
             "historical_share", "share_difference"),
        rows("recent_anomalies", "endpoint", None, "total_requests", "error_rate", None),
        rows("window", None, "recent_window_end", "recent_window_seconds", None, None),
        rows("totals", None, None, "historical_valid_records", "recent_valid_records",
             "recent_response_bytes"),
        rows("traffic_comparison", None, None, "recent_rpm", "significant_increase_count",
             "endpoint_baselines_available"),
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
