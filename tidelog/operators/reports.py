"""Report and reconciliation queries over the batch tables, in Spark SQL.

Every statement names its tables in braces; ``run_report`` fills in DataFrames, and
``report_sql`` prints the statement for tables registered under a database.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession

REPORTS = {
    "endpoint_historical_summary": """
        SELECT r.endpoint, r.total_requests, e.error_count, e.error_rate,
               b.total_response_bytes, m.avg_requests_per_minute
        FROM {requests_per_endpoint} r
        LEFT JOIN {error_rates} e ON e.endpoint = r.endpoint
        LEFT JOIN {response_byte_totals} b ON b.endpoint = r.endpoint
        LEFT JOIN {baseline_rpm} m ON m.endpoint = r.endpoint""",
    "batch_health_summary": """
        SELECT total_valid_records, total_response_bytes,
               status_record_count, total_error_responses,
               CASE WHEN total_valid_records = 0 THEN 0.0D
                    ELSE CAST(total_error_responses AS DOUBLE)
                         / CAST(total_valid_records AS DOUBLE) END AS overall_error_rate
        FROM (SELECT total_valid_records, total_response_bytes,
                     (SELECT sum(request_count) FROM {status_code_distribution})
                         AS status_record_count,
                     (SELECT sum(CASE WHEN status_code >= 400 THEN request_count ELSE 0 END)
                      FROM {status_code_distribution}) AS total_error_responses
              FROM {batch_summary})""",
    "reconcile_batch": """
        WITH totals AS (
            SELECT 'requests_per_endpoint record total' AS validation_check,
                   'records' AS total, count(*) AS parts, sum(total_requests) AS actual_value
            FROM {requests_per_endpoint}
            UNION ALL
            SELECT 'traffic_by_hour record total', 'records', count(*), sum(request_count)
            FROM {traffic_by_hour}
            UNION ALL
            SELECT 'status_code_distribution record total', 'records', count(*),
                   sum(request_count)
            FROM {status_code_distribution}
            UNION ALL
            SELECT 'response_byte_totals byte total', 'bytes', count(*),
                   sum(total_response_bytes)
            FROM {response_byte_totals}),
        expected AS (
            SELECT 'records' AS total, total_valid_records AS expected_value FROM {batch_summary}
            UNION ALL
            SELECT 'bytes', total_response_bytes FROM {batch_summary})
        SELECT validation_check, expected_value, actual_value,
               CASE WHEN expected_value = actual_value THEN 'PASS' ELSE 'FAIL' END
                   AS validation_status
        FROM totals JOIN expected ON expected.total = totals.total
        WHERE parts > 0 ORDER BY validation_check""",
    "top_endpoints": """
        SELECT endpoint, total_requests FROM {requests_per_endpoint}
        ORDER BY total_requests DESC, endpoint LIMIT 10""",
    "hourly_traffic_report": """
        SELECT hour, request_count FROM {traffic_by_hour} ORDER BY hour""",
    "top_error_endpoints": """
        SELECT endpoint, total_requests, error_count,
               round(error_rate * 100, 4) AS error_percentage
        FROM {error_rates}
        ORDER BY error_count DESC, error_rate DESC, total_requests DESC, endpoint LIMIT 10""",
    "status_percentage": """
        SELECT status_code, request_count,
               round(100.0D * request_count
                     / (SELECT sum(request_count) FROM {status_code_distribution}), 4)
                   AS percentage_of_requests
        FROM {status_code_distribution} ORDER BY status_code""",
    "top_byte_endpoints": """
        SELECT endpoint, total_response_bytes FROM {response_byte_totals}
        ORDER BY total_response_bytes DESC, endpoint LIMIT 10""",
    "top_baseline_endpoints": """
        SELECT endpoint, round(avg_requests_per_minute, 4) AS avg_requests_per_minute
        FROM {baseline_rpm}
        ORDER BY 2 DESC, endpoint LIMIT 10""",
    "combined_endpoint_report": """
        SELECT endpoint, total_requests, error_count,
               round(error_rate * 100, 4) AS error_percentage, total_response_bytes,
               round(avg_requests_per_minute, 4) AS avg_requests_per_minute
        FROM {endpoint_historical_summary}
        ORDER BY total_requests DESC, endpoint LIMIT 10""",
}


def tables_of(report: str) -> list[str]:
    return sorted({name for _, name, _, _ in string.Formatter().parse(REPORTS[report]) if name})


def run_report(spark: SparkSession, report: str, tables: dict[str, DataFrame]) -> DataFrame:
    """Run one report; only the tables it names are used."""
    return spark.sql(REPORTS[report], **{name: tables[name] for name in tables_of(report)})


def report_sql(report: str, database: str) -> str:
    return REPORTS[report].format(**{name: f"{database}.{name}" for name in tables_of(report)})


def create_views(spark: SparkSession, database: str) -> None:
    """The two views over catalogued batch tables."""
    for view in ("endpoint_historical_summary", "batch_health_summary"):
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{view} AS {report_sql(view, database)}")
