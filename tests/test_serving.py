import json

import pytest
from pyspark.sql import functions as F

from tidelog.operators import aggregates, latency, parity, serving
from tidelog.operators.aggregates import minute_facts
from tidelog.operators.parse import read_events
from tidelog.plans.parity import batch_stream_values
from tidelog.plans.serving import run_serving, run_serving_documents, view_of_documents
from tidelog.plans.sinks import write_batch_results
from tidelog.sources.documents import (
    baseline_value,
    parse_metric_documents,
    read_baselines,
    sanitize_counts,
    sanitize_rates,
)
from tests.samples import CONTROLLED_LOG, log_line

SIDE = "endpoint STRING, requests BIGINT, response_bytes BIGINT, error_rate DOUBLE, baseline_rpm DOUBLE"


def compare(spark, baselines, recent, window=300, **options):
    past = spark.createDataFrame([(e, None, None, None, b) for e, b in baselines.items()], SIDE)
    now = spark.createDataFrame([(e, n, None, None, None) for e, n in recent.items()], SIDE)
    seconds = F.lit(window).cast("double")
    return serving.compare_endpoints(past, now, seconds, **options)


def only(df):
    return df.first().asDict()


def test_significant_increase(spark):
    found = only(compare(spark, {"/a": 0.4}, {"/a": 10}))
    assert (found["recent_rpm"], found["rpm_difference"], found["recent_to_baseline_ratio"]) == (2.0, 1.6, 5.0)
    assert found["traffic_status"] == "significant increase" and found["minimum_requests_met"]


def test_too_few_requests(spark):
    found = only(compare(spark, {"/a": 0.1}, {"/a": 5}))
    assert found["recent_to_baseline_ratio"] == 10.0
    assert (found["significant_increase"], found["traffic_status"]) == (False, "above baseline")


def test_zero_baseline(spark):
    found = only(compare(spark, {"/a": 0.0}, {"/a": 10}))
    assert found["recent_to_baseline_ratio"] is None
    assert found["traffic_status"] == "significant increase"


@pytest.mark.parametrize(
    "baseline, requests, window, status",
    [
        (None, 10, 300, "baseline unavailable"),
        (-1.0, 10, 300, "baseline unavailable"),
        (float("nan"), 10, 300, "baseline unavailable"),
        (float("inf"), 10, 300, "baseline unavailable"),
        (1.0, 10, 0, "recent rate unavailable"),
        (1.0, 10, None, "recent rate unavailable"),
        (2.0, 10, 300, "equal to baseline"),
        (3.0, 10, 300, "below baseline"),
    ],
)
def test_statuses(spark, baseline, requests, window, status):
    found = only(compare(spark, {"/a": baseline}, {"/a": requests}, window))
    assert (found["traffic_status"], found["significant_increase"]) == (status, False)


def test_ranking_and_summary(spark):
    compared = compare(
        spark, {"/api/login": 0.5, "/api/users": 1.0, "/new": 0.0}, {"/api/login": 20, "/api/users": 5, "/new": 10}
    )
    ranked = serving.ranked_spikes(serving.traffic_spikes(compared)).collect()
    assert [row.endpoint for row in ranked] == ["/new", "/api/login"]
    summary = only(serving.spike_summary(compared))
    assert summary["significant_increase_count"] == 2
    assert (summary["endpoint_baselines_available"], summary["endpoints_compared"]) == (3, 3)


def test_thresholds(spark):
    for options in ({"ratio": 1.0}, {"ratio": float("inf")}, {"minimum_requests": 0}):
        with pytest.raises(ValueError):
            compare(spark, {"/a": 1.0}, {"/a": 1}, **options)


def baselines(spark, value):
    df = spark.createDataFrame([("d", json.dumps({"baseline_rpm": value}))], "doc_key STRING, value STRING")
    parsed = parse_metric_documents(df, "batch")
    rows = read_baselines(parsed.select("doc_key", baseline_value(F.col("metrics"), F.col("root")).alias("baseline")))
    return {row.endpoint: row.baseline_rpm for row in rows.collect()}


@pytest.mark.parametrize(
    "value, right",
    [
        ({"/a": 3.5, "/b": {"avg_requests_per_minute": 2.0}, "/bad": -1, "/n": None}, {"/a": 3.5, "/b": 2.0}),
        (
            [{"endpoint": "/a", "avg_requests_per_minute": 0.5}, {"endpoint": "/b", "baseline_rpm": 1.0}, 7],
            {"/a": 0.5, "/b": 1.0},
        ),
        ([{"endpoint": " /a ", "value": "4"}, {"endpoint": "/a", "value": {"baseline_rpm": 5}}], {"/a": 5.0}),
        ([{"endpoint": "/a", "value": 1}, {"endpoint": "/a", "value": -1}], {"/a": 1.0}),
        ([{"value": 1}, {"endpoint": None, "value": 1}, {"endpoint": " ", "value": 1}], {}),
        ({"/a": {"avg_requests_per_minute": None, "baseline_rpm": 2}, "/b": "nan", "/c": "inf"}, {}),
        (5, {}),
        ("text", {}),
    ],
)
def test_baseline_shapes(spark, value, right):
    assert baselines(spark, value) == right


def test_safe_maps(spark):
    body = {
        "requests_per_endpoint": {"/a": "5", "/b": "x", "/c": 2.9, "/d": None, "/e": [1]},
        "error_rates": {"/a": {"error_rate": "0.5"}, "/b": 0.25, "/c": {"other": 1}, "/d": "no"},
    }
    df = spark.createDataFrame([("d", json.dumps({"batch_metrics": "x", "metrics": body}))], "doc_key STRING, value STRING")
    parsed = parse_metric_documents(df, "batch")
    counts = {r.key: r.value for r in sanitize_counts(parsed, "requests_per_endpoint").collect()}
    rates = {r.key: r.value for r in sanitize_rates(parsed).collect()}
    assert counts == {"/a": 5, "/c": 2} and rates == {"/a": 0.5, "/b": 0.25}


def view(spark, batch, speed, **options):
    one = lambda text: spark.createDataFrame([("d", text)], "doc_key STRING, value STRING")
    found = view_of_documents(one(json.dumps(batch)), one("﻿" + json.dumps(speed)), **options)
    return {name: [row.asDict() for row in table.collect()] for name, table in found.items()}


# Invented sides: 66 requests in two minutes against 8.25 a minute, 9 of them errors.
BATCH = {
    "batch_metrics": {
        "baseline_rpm": {"/garden/seeds": 8.25},
        "error_rates": {"/garden/seeds": {"error_count": 99, "error_rate": 0.02}},
        "requests_per_endpoint": {"/garden/seeds": 4950},
        "response_byte_totals": {"/garden/seeds": 990000},
        "total_response_bytes": 7500000,
        "total_valid_records": 25000,
    }
}
SPEED = {
    "generated_at": "2027-03-18T06:30:10+00:00",
    "anomalies": [{"endpoint": "/garden/seeds", "error_rate": 0.5}],
    "snapshot": {
        "window_seconds": 120,
        "window_start": "2027-03-18T06:28:00+00:00",
        "window_end": "2027-03-18T06:30:00+00:00",
        "window_event_count": 66,
        "total_valid_records": 66,
        "total_response_bytes": 13200,
        "requests_per_endpoint": {"/garden/seeds": 66},
        "response_byte_totals": {"/garden/seeds": 13200},
        "error_rates": {"/garden/seeds": {"total_requests": 66, "error_count": 9, "error_rate": 9 / 66}},
        "status_code_distribution": {"200": 57, "503": 9},
    },
}


def test_serving_documents(spark):
    found = view(spark, BATCH, SPEED)
    (seeds,) = found["endpoint_comparison"]
    assert (seeds["recent_rpm"], seeds["rpm_difference"]) == (33.0, 24.75)
    assert (seeds["recent_to_baseline_ratio"], seeds["error_rate_difference"]) == (4.0, 0.116364)
    assert seeds["traffic_status"] == "significant increase"
    (traffic,) = found["traffic_comparison"]
    assert (traffic["baseline_rpm"], traffic["traffic_status"]) == (8.25, "above baseline")
    assert traffic["significant_increase_count"] == 1
    assert found["totals"] == [
        {
            "historical_valid_records": 25000,
            "recent_valid_records": 66,
            "historical_response_bytes": 7500000,
            "recent_response_bytes": 13200,
        }
    ]
    status = {row["status_code"]: row for row in found["status_code_comparison"]}
    assert (status["503"]["historical_share"], status["503"]["share_difference"]) == (0.0, 0.136364)
    assert found["recent_anomalies"][0]["endpoint"] == "/garden/seeds"
    assert [row["rank"] for row in found["traffic_spikes"]] == [1]
    (about,) = found["about"]
    assert (about["schema_version"], about["speed_snapshot_generated_at"]) == (2, "2027-03-18T06:30:10+00:00")
    assert about["generated_at"] > about["speed_snapshot_generated_at"][:2] and about["comparison_note"]


def test_serving_command_for_documents(spark, tmp_path):
    for name, document in (("batch", BATCH), ("speed", SPEED)):
        (tmp_path / f"{name}.json").write_text(json.dumps(document, indent=1))
    out = str(tmp_path / "view")
    run_serving_documents(spark, str(tmp_path / "batch.json"), str(tmp_path / "speed.json"), out)
    assert spark.read.parquet(f"{out}/traffic_spikes").first().recent_to_baseline_ratio == 4.0
    assert spark.read.json(f"{out}/lines").filter("section = 'about'").count() == 1


def test_ranks_of_many_spikes(spark):
    rows = [(f"/{n}", 10, None if n % 9 == 0 else float(n % 7), float(n % 5), 1.0, None if n % 9 == 0 else float(n % 7), "") for n in range(200)]
    spikes = spark.createDataFrame(rows, ", ".join(f"{n} {k}" for n, k in zip(
        serving.SPIKE_COLUMNS, ["STRING", "INT", "DOUBLE", "DOUBLE", "DOUBLE", "DOUBLE", "STRING"]))).repartition(7)
    found = [row.endpoint for row in sorted(serving.ranked_spikes(spikes).collect(), key=lambda row: row["rank"])]
    order = sorted(rows, key=lambda row: (row[5] is not None, -(row[5] or 0), -row[3], row[0]))
    assert found == [row[0] for row in order]


def test_missing_baseline(spark):
    found = view(spark, {"batch_metrics": {"total_valid_records": 7, "requests_per_endpoint": {"/": 7}}}, SPEED)
    (traffic,) = found["traffic_comparison"]
    assert (traffic["comparison_available"], traffic["traffic_status"]) == (False, "baseline unavailable")
    assert {row["endpoint"] for row in found["endpoint_comparison"]} == {"/", "/garden/seeds"}


def test_scalar_baseline_of_the_only_endpoint(spark):
    batch = {"batch_metrics": {"baseline_rpm": 16.5, "requests_per_endpoint": {"/garden/seeds": 5}}}
    (seeds,) = view(spark, batch, SPEED)["endpoint_comparison"]
    assert (seeds["historical_baseline_rpm"], seeds["recent_to_baseline_ratio"]) == (16.5, 2.0)
    batch["batch_metrics"]["requests_per_endpoint"]["/other"] = 1
    found = view(spark, batch, SPEED)
    assert {row["historical_baseline_rpm"] for row in found["endpoint_comparison"]} == {None}
    assert found["traffic_comparison"][0]["baseline_rpm"] == 16.5


def test_totals_fall_back_to_sums(spark):
    speed = {"window_seconds": 60, "requests_per_endpoint": {"/a": 2, "/b": 3}, "response_byte_totals": {"/a": 9}}
    batch = {"requests_per_endpoint": {"/a": 4}, "response_byte_totals": {"/a": 8}}
    assert list(view(spark, batch, speed)["totals"][0].values()) == [4, 5, 8, 9]


def test_serving_job(spark, tmp_path, lines_of):
    from tidelog.operators.window import recent_window
    from tidelog.plans.global_window import window_sections

    events = read_events(lines_of(CONTROLLED_LOG))
    past = minute_facts(events)
    tables = aggregates.batch_metrics(past, aggregates.endpoint_summary(past))
    write_batch_results(tables, str(tmp_path / "batch"))
    facts = aggregates.unit_facts(recent_window(events, 120))
    for name, table in window_sections(facts, 120).items():
        table.write.parquet(str(tmp_path / "snapshot" / name))
    run_serving(spark, str(tmp_path / "batch"), str(tmp_path / "snapshot"), str(tmp_path / "view"))
    compared = spark.read.parquet(str(tmp_path / "view" / "endpoint_comparison"))
    rows = {row.endpoint: row for row in compared.collect()}
    assert (rows["/catalog"].historical_requests, rows["/catalog"].recent_requests) == (2, 1)
    lines = spark.read.json(str(tmp_path / "view" / "lines"))
    assert lines.filter("section = 'endpoint_comparison'").count() == 4
    assert json.loads(lines.filter("section = 'totals'").first().body)["historical_valid_records"] == 7


def test_parity_of_a_controlled_log(event_table_of):
    values = batch_stream_values(event_table_of(CONTROLLED_LOG), 300)
    checked = {row.metric: row.match for row in parity.compare_metrics(values).collect()}
    assert list(checked) and set(checked) == set(parity.COMPARABLE_METRICS) and all(checked.values())


def test_parity_shows_differences(event_table_of):
    late = log_line("GET  /x HTTP/1.1", "30/Jul/2026:09:00:00 +0000")
    values = batch_stream_values(event_table_of([*CONTROLLED_LOG, late]), 300)
    found = {(r.metric, r.key, r.field): r.outcome for r in parity.find_differences(values).collect()}
    assert found[("traffic_by_hour", "9", "")] == "missing from stream"
    assert found[("total_valid_records", "", "")] == "different"
    assert ("requests_per_endpoint", "/catalog", "") not in found


def test_percentiles_are_interpolated(spark):
    df = spark.createDataFrame([(100,), (200,), (300,), (None,)], "v BIGINT")
    assert tuple(latency.exact_percentiles(df, "v", {"p50": 0.5, "p95": 0.95}).first()) == (200.0, 290.0)


def test_percentiles_of_wide_and_skewed_values(spark):
    df = spark.range(3000).select(
        F.expr("CASE WHEN id % 3 = 0 THEN 7 ELSE pmod(xxhash64(id), 9000000000000000000) END").alias("v")
    )
    asked = {"low": 0.2, "p50": 0.5, "p95": 0.95, "top": 1.0}
    ours = latency.exact_percentiles(df, "v", asked).first()
    exact = df.agg(*[F.percentile("v", p).alias(n) for n, p in asked.items()]).first()
    for name in asked:
        assert ours[name] == pytest.approx(exact[name], rel=1e-12)
    assert tuple(latency.exact_percentiles(df.filter("false"), "v", asked).first()) == (None,) * 4


def test_stream_latency(spark):
    schema = "valid BOOLEAN, processed_at STRING, ingested_at STRING"
    rows = [
        (True, "2026-07-31 10:00:00.1", "2026-07-31 10:00:00"),
        (True, "2026-07-31 10:00:00.2", "2026-07-31 10:00:00"),
        (True, "2026-07-31 10:00:00.3", "2026-07-31 10:00:00"),
        (False, "2026-07-31 10:00:09", "2026-07-31 10:00:00"),
    ]
    df = spark.createDataFrame(rows, schema)
    df = df.withColumns({n: F.to_timestamp(n) for n in ("processed_at", "ingested_at")})
    found = latency.stream_latency(df, 2.0).first()
    assert (found.records_attempted, found.records_processed, found.invalid_records) == (4, 3, 1)
    assert found.throughput_records_per_second == 1.5
    assert (found.latency_p50_ms, found.latency_p95_ms, found.latency_mean_ms) == (200.0, 290.0, 200.0)


def test_every_nth(spark):
    assert latency.every_nth(spark.range(0, 100, 1, 4), 10).count() == 8
    assert latency.every_nth(spark.range(100), 10, F.col("id") + 1).count() == 10


def test_scaling(spark):
    runs = spark.createDataFrame([(1, 410.4), (2, 380.1), (4, 294.1)], "workers INT, elapsed_sec DOUBLE")
    found = {r.workers: (r.speedup, r.efficiency) for r in latency.scaling_efficiency(runs).collect()}
    assert found == {1: (1.0, 1.0), 2: (1.08, 0.54), 4: (1.395, 0.349)}
    alone = latency.scaling_efficiency(runs.filter("workers = 2")).first()
    assert (alone.speedup, alone.efficiency) == (1.0, 0.5)
