import pytest

from tidelog.operators import aggregates, reports
from tidelog.operators.parse import read_events
from tidelog.plans.batch import run_batch
from tidelog.plans.reports import run_reports
from tidelog.sources.tables import create_database, read_batch_tables
from tests.samples import CONTROLLED_LOG, log_line


@pytest.fixture
def controlled(lines_of):
    return read_events(lines_of(CONTROLLED_LOG))


def metrics_of(facts):
    return aggregates.batch_metrics(facts, aggregates.endpoint_summary(facts))


def as_dict(df, key, *values):
    return {row[key]: tuple(row[v] for v in values) for row in df.collect()}


@pytest.mark.parametrize("facts_of", [aggregates.unit_facts, aggregates.minute_facts])
def test_controlled_log(controlled, facts_of):
    facts = facts_of(controlled)
    metrics = metrics_of(facts)
    for name in ("requests_per_endpoint", "error_rates", "response_byte_totals", "baseline_rpm"):
        alone = getattr(aggregates, name)(facts)
        assert sorted(map(tuple, alone.collect())) == sorted(map(tuple, metrics[name].collect()))
    assert as_dict(metrics["requests_per_endpoint"], "endpoint", "total_requests") == {
        "/catalog": (2,), "/catalog/7": (2,), "/cart": (2,), "/style.css": (1,)
    }
    assert as_dict(metrics["traffic_by_hour"], "hour", "request_count") == {22: (2,), 23: (5,)}
    assert as_dict(metrics["error_rates"], "endpoint", "error_count", "error_rate")["/cart"] == (2, 1.0)
    assert as_dict(metrics["status_code_distribution"], "status_code", "request_count") == {
        200: (4,), 206: (1,), 403: (1,), 502: (1,)
    }
    assert as_dict(metrics["response_byte_totals"], "endpoint", "total_response_bytes")["/style.css"] == (1200,)
    assert tuple(metrics["batch_summary"].first()) == (7, 2000)


def test_baseline_counts_active_minutes(lines_of):
    times = ["10:00:01", "10:00:30", "10:00:59", "10:05:00"]
    events = read_events(lines_of([log_line(time=f"30/Jul/2026:{t} +0000") for t in times]))
    facts = aggregates.unit_facts(events)
    assert aggregates.baseline_rpm(facts).first().avg_requests_per_minute == 2.0
    assert aggregates.baseline_rpm(facts, idle_minutes=True).first().avg_requests_per_minute == 4 / 6


def test_summary_equals_joined_tables(spark, controlled):
    facts = aggregates.minute_facts(controlled)
    joined = reports.run_report(spark, "endpoint_historical_summary", metrics_of(facts))
    direct = aggregates.endpoint_summary(facts)
    assert sorted(map(tuple, joined.select(*direct.columns).collect())) == sorted(
        map(tuple, direct.collect())
    )


def test_output_order(controlled):
    rates = aggregates.error_rates(aggregates.unit_facts(controlled))
    shown = aggregates.in_output_order("error_rates", rates).collect()
    assert [row.endpoint for row in shown] == ["/cart", "/catalog", "/catalog/7", "/style.css"]


@pytest.mark.parametrize("file_format", ["parquet", "csv"])
def test_batch_job(spark, tmp_path, file_format):
    (tmp_path / "logs").mkdir()
    odd = log_line('GET /a,b\\c HTTP/1.1', time="30/Jul/2026:12:00:00 +0000")
    rejected = ' "quoted, \\ line" '
    text = "\n".join([*CONTROLLED_LOG, odd, rejected])
    (tmp_path / "logs" / "access.log").write_text(text + "\n")
    out = str(tmp_path / "out")
    run_batch(spark, str(tmp_path / "logs"), out, file_format, ordered=True, single_file=True)
    found = read_batch_tables(spark, out, file_format)
    assert as_dict(found["requests_per_endpoint"], "endpoint", "total_requests")["/a,b\\c"] == (1,)
    assert tuple(found["batch_summary"].first()) == (8, 2100)
    if file_format == "parquet":
        assert spark.read.parquet(f"{out}/data_quality").first().invalid_records == 3
        sample = {r.raw_line for r in spark.read.parquet(f"{out}/rejected_sample").collect()}
    else:
        from tidelog.sources.tables import CSV_OPTIONS

        read = spark.read.options(**CSV_OPTIONS).csv(f"{out}/rejected_sample")
        sample = {r.raw_line for r in read.collect()}
    assert rejected in sample and len(sample) == 3


@pytest.mark.parametrize("file_format", ["parquet", "csv"])
def test_catalogue(spark, tmp_path, file_format, controlled):
    from tidelog.plans.sinks import write_batch_results

    out = str(tmp_path / "tables")
    write_batch_results(metrics_of(aggregates.minute_facts(controlled)), out, file_format)
    database = f"tidelog_test_{file_format}"
    create_database(spark, database, out, file_format)
    reports.create_views(spark, database)
    assert spark.table(f"{database}.batch_health_summary").first().overall_error_rate == 2 / 7
    top = spark.sql(reports.report_sql("top_endpoints", database)).collect()
    assert [(r.endpoint, r.total_requests) for r in top][:2] == [("/cart", 2), ("/catalog", 2)]
    checks = spark.sql(reports.report_sql("reconcile_batch", database)).collect()
    assert [r.validation_status for r in checks] == ["PASS"] * 4


def test_reconciliation_fails_on_a_missing_row(spark, controlled):
    tables = metrics_of(aggregates.minute_facts(controlled))
    tables["requests_per_endpoint"] = tables["requests_per_endpoint"].filter("endpoint <> '/catalog'")
    tables["traffic_by_hour"] = tables["traffic_by_hour"].filter("false")
    checks = reports.run_report(spark, "reconcile_batch", tables).collect()
    assert [(r.validation_check, r.validation_status) for r in checks] == [
        ("requests_per_endpoint record total", "FAIL"),
        ("response_byte_totals byte total", "PASS"),
        ("status_code_distribution record total", "PASS"),
    ]


@pytest.mark.parametrize("database", [None, "tidelog_reports"])
def test_report_command(spark, tmp_path, database):
    (tmp_path / "a.log").write_text("\n".join(CONTROLLED_LOG) + "\n")
    results, out = str(tmp_path / "results"), str(tmp_path / "reports")
    run_batch(spark, str(tmp_path / "a.log"), results)
    assert run_reports(spark, results, out, database=database)
    assert sorted(path.name for path in (tmp_path / "reports").iterdir()) == sorted(reports.REPORTS)
    top = spark.read.option("header", "true").csv(f"{out}/combined_endpoint_report").collect()
    assert {row.endpoint for row in top} == {"/catalog", "/catalog/7", "/cart", "/style.css"}
    spark.createDataFrame([(1, 1)], "total_valid_records BIGINT, total_response_bytes BIGINT").write.mode("overwrite").parquet(
        f"{results}/batch_summary"
    )
    if database:
        spark.catalog.refreshTable(f"{database}.batch_summary")
    assert not run_reports(spark, results, out, ["reconcile_batch"], database)
    if database:
        spark.sql(f"DROP DATABASE {database} CASCADE")
        assert spark.read.parquet(f"{results}/requests_per_endpoint").count() == 4
