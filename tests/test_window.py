import json
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tidelog.functions.instants import iso_text, lenient_utc, strict_utc
from tidelog.operators import aggregates, dedup
from tidelog.operators.events import decode_payloads, validate_events
from tidelog.operators.skew import spread_join
from tidelog.operators.window import (
    endpoint_count,
    error_anomalies,
    recent_window,
    window_anomalies,
    window_summary,
)
from tidelog.plans.global_window import global_window, run_global, window_sections
from tests.samples import delta, event


def documents(spark, texts):
    rows = [(f"doc-{index:04d}", text) for index, text in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_key STRING, value STRING")


def classes(spark, texts):
    found = dedup.dedup_events(dedup.delta_events(documents(spark, texts)))
    return [
        (row.doc_key, row.position, row.event_class)
        for row in found.orderBy("doc_key", "position").collect()
    ]


def statistics(spark, texts):
    classified = dedup.dedup_events(dedup.delta_events(documents(spark, texts)))
    return dedup.aggregation_statistics(classified).first().asDict()


def test_retries_are_removed(spark):
    first = event("event-1", "2026-07-31T10:00:00+00:00")
    second = event("event-2", "2026-07-31T10:00:01+00:00", 500)
    texts = [delta([first, second]), delta([first])]
    found = statistics(spark, texts)
    assert (found["raw_events"], found["unique_events"], found["duplicate_events"]) == (3, 2, 1)
    _, window = global_window(documents(spark, texts))
    anomalies = window_anomalies(aggregates.unit_facts(window)).collect()
    assert [(a.endpoint, a.total_requests, a.error_rate) for a in anomalies] == [("/api/test", 2, 0.5)]


def test_edge_is_inside(spark):
    times = ["10:00:00", "09:54:59", "09:55:00"]
    texts = [delta([event(t, f"2026-07-31T{t}+00:00") for t in times])]
    _, window = global_window(documents(spark, texts), 300)
    summary = window_summary(aggregates.unit_facts(window), 300).first()
    assert statistics(spark, texts)["unique_events"] == 3
    assert summary.window_event_count == 2
    assert summary.window_start == "2026-07-31T09:55:00+00:00"
    assert summary.window_end == "2026-07-31T10:00:00+00:00"


def test_invalid_documents_and_events(spark):
    texts = [
        delta([], "other"),
        delta([event("a", "never"), "text", 5, None]),
        "not json",
        "[1, 2]",
        "﻿" + delta([event("b", "2026-07-31T10:00:00Z")]),
        json.dumps({"document_type": "speed_batch_delta", "events": {"a": 1}}),
        delta([]),
    ]
    assert statistics(spark, texts) == {
        "scanned_objects": 7,
        "valid_documents": 3,
        "invalid_documents": 4,
        "raw_events": 5,
        "unique_events": 1,
        "duplicate_events": 0,
        "invalid_events": 4,
    }


def test_invalid_copy_before_and_after(spark):
    good, bad = event("a", "2026-07-31T10:00:00Z"), event("a", "never")
    assert [c for _, _, c in classes(spark, [delta([bad, good, bad, good])])] == [
        "invalid", "unique", "duplicate", "duplicate"
    ]


def test_identities(spark):
    at = "2026-07-31T10:00:00Z"
    events = [
        event(" x ", at),
        event("x", at, sequence_number="other"),
        event("", at, sequence_number="s1"),
        event(None, at, sequence_number=" s1"),
        event(None, at, sequence_number=None),
        event(0, at, sequence_number=None),
        event(None, at, sequence_number=None, client_ip="10.0.0.2"),
        event(None, at, sequence_number=False, client_ip=None),
        {k: v for k, v in event(None, at, sequence_number="").items() if k != "client_ip"},
    ]
    assert [c for _, _, c in classes(spark, [delta(events)])] == [
        "unique", "duplicate", "unique", "duplicate", "unique", "duplicate", "unique", "unique", "duplicate"
    ]


def sequential(texts, window_seconds):
    """The same rules one event at a time."""
    seen, labels, accepted = set(), [], []
    for index, text in enumerate(texts):
        for position, item in enumerate(json.loads(text)["events"]):
            key = item["event_id"] or item["sequence_number"]
            if key in seen:
                label = "duplicate"
            elif item["timestamp"] == "never" or item["response_bytes"] < 0:
                label = "invalid"
            else:
                label = "unique"
                seen.add(key)
                accepted.append(item)
            labels.append((f"doc-{index:04d}", position, label))
    newest = max(datetime.fromisoformat(item["timestamp"]) for item in accepted)
    start = newest - timedelta(seconds=window_seconds)
    inside = [i for i in accepted if datetime.fromisoformat(i["timestamp"]) >= start]
    return labels, inside


@pytest.mark.parametrize("seed", [1, 2])
def test_against_a_sequential_model(spark, seed):
    """Random retries and damage, with one identity that holds a third of all events."""
    source = random.Random(seed)
    texts = []
    for _ in range(12):
        events = []
        for _ in range(source.randrange(1, 40)):
            key = "hot" if source.random() < 0.34 else f"e{source.randrange(60)}"
            time = datetime(2026, 7, 31, 10, tzinfo=timezone.utc) + timedelta(seconds=source.randrange(900))
            item = event(key, time.isoformat(), endpoint=f"/{source.randrange(4)}")
            if source.random() < 0.3:
                item["timestamp"] = "never"
            elif source.random() < 0.2:
                item["response_bytes"] = -1
            events.append(item)
        texts.append(delta(events))
    labels, inside = sequential(texts, 300)
    assert classes(spark, texts) == labels
    _, window = global_window(documents(spark, texts), 300)
    got = sorted((row.identity, row.endpoint) for row in window.collect())
    assert got == sorted((f"event_id:{i['event_id']}", i["endpoint"]) for i in inside)


def test_spread_join_splits_hot_and_null_keys(spark):
    rows = spark.range(20000).select(
        "id", F.expr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN NULL ELSE 'k' || id END").alias("key")
    )
    table = rows.filter("key IS NOT NULL").groupBy("key").agg(
        F.min("id").alias("first"), F.count("*").alias("copies")
    )
    joined = spread_join(rows, table, ["key"], ["id"])
    wrong = joined.filter("(key = 'hot' AND first <> 0) OR (key IS NULL AND first IS NOT NULL) OR (key LIKE 'k%' AND first <> id)")
    assert joined.count() == 20000 and wrong.count() == 0


def test_window_order_does_not_matter(spark, tmp_path):
    texts = [delta([event(f"e{i}", f"2026-07-31T10:{i:02d}:00Z", endpoint=f"/{i % 3}")]) for i in range(20)]
    for name, order in (("a", texts), ("b", list(reversed(texts)))):
        folder = tmp_path / name / "2026" / "07"
        folder.mkdir(parents=True)
        for index, text in enumerate(order):
            (folder / f"{index:03d}.json").write_text(text)
        (folder / "readme.txt").write_text("no document")
        run_global(spark, str(tmp_path / name), str(tmp_path / f"out-{name}"), 300)
    read = lambda name, table: sorted(
        map(tuple, spark.read.parquet(str(tmp_path / f"out-{name}" / table)).collect())
    )
    for table in ("endpoints", "window_summary", "traffic_by_hour", "status_code_distribution", "statistics"):
        assert read("a", table) == read("b", table)
    assert spark.read.parquet(str(tmp_path / "out-a" / "statistics")).first().window_event_count == 6


def test_empty_window(spark):
    nothing = spark.createDataFrame(
        [], "timestamp TIMESTAMP, endpoint STRING, status_code BIGINT, response_bytes BIGINT"
    )
    sections = window_sections(aggregates.unit_facts(recent_window(nothing, 60)), 60)
    summary = sections["window_summary"].first()
    assert (summary.window_start, summary.window_event_count, summary.total_response_bytes) == (None, 0, 0)
    assert sections["endpoints"].count() == 0


def test_limits_are_checked(spark):
    nothing = spark.createDataFrame([], "timestamp TIMESTAMP")
    with pytest.raises(ValueError):
        recent_window(nothing, 0)
    with pytest.raises(ValueError):
        error_anomalies(nothing, error_rate_threshold=1.5)
    with pytest.raises(ValueError):
        error_anomalies(nothing, minimum_requests=0)


def test_endpoint_count(spark):
    counts = spark.createDataFrame([("/a", 3)], "endpoint STRING, total_requests BIGINT")
    asked = spark.createDataFrame([("/a",), ("/b",)], "endpoint STRING")
    found = {r.endpoint: r.request_count for r in endpoint_count(counts, asked).collect()}
    assert found == {"/a": 3, "/b": 0}


TIMES = {
    "2026-07-31T10:00:00+00:00": "2026-07-31T10:00:00+00:00",
    " 2026-07-31T10:00:00Z ": "2026-07-31T10:00:00+00:00",
    "2026-07-31 10:00:00.25+02:00": "2026-07-31T08:00:00.250000+00:00",
    "2026-07-31T10:00:00,123456789Z": "2026-07-31T10:00:00.123456+00:00",
    "2026-07-31T10:00:00+0530": "2026-07-31T04:30:00+00:00",
    "2026-07-31T10:00:00-01": "2026-07-31T11:00:00+00:00",
    "2026-07-31T10:00+01:00": "2026-07-31T09:00:00+00:00",
    "20260731T100000Z": "2026-07-31T10:00:00+00:00",
    "2026-07-31T10:00:00": None,
    "2026-02-30T10:00:00Z": None,
    "2026-07-31": None,
    "31/Jul/2026:10:00:00 +0000": None,
    "never": None,
    "": None,
}


def test_event_times(spark):
    df = spark.createDataFrame([(text,) for text in TIMES], "text STRING")
    got = df.select("text", iso_text(strict_utc(F.trim("text"))).alias("t")).collect()
    assert {row.text: row.t for row in got} == TIMES


def test_document_times(spark):
    df = spark.createDataFrame([("2026-07-31T10:00:00",), ("2026-07-31T10:00:00+01:00",), ("x",), (None,)], "t STRING")
    got = [r[0] for r in df.select(iso_text(lenient_utc(F.col("t")))).collect()]
    assert got[:3] == ["2026-07-31T10:00:00+00:00", "2026-07-31T09:00:00+00:00", None]
    assert got[3] is not None


def test_event_fields(spark):
    at = "2026-07-31T10:00:00Z"
    cases = [
        (event("a", at), True),
        (event("a", at, status_code="200"), True),
        (event("a", at, status_code=200.7), True),
        (event("a", at, status_code=True), True),
        (event("a", at, status_code="200.7"), False),
        (event("a", at, status_code=None), False),
        (event("a", at, status_code=[200]), False),
        (event("a", at, response_bytes=" 12 "), True),
        (event("a", at, response_bytes=-1), False),
        (event("a", at, response_bytes=5_000_000_000), True),
        (event("a", at, endpoint=" /x "), True),
        (event("a", at, endpoint="  "), False),
        (event("a", at, endpoint=0), False),
        (event("a", at, endpoint="0"), True),
        (event("a", at, endpoint=None), False),
        (event("a", "2026-07-31T10:00:00"), False),
        (event("a", 1234567890), False),
        ({k: v for k, v in event("a", at).items() if k != "endpoint"}, False),
        ({k: v for k, v in event("a", at).items() if k != "response_bytes"}, False),
        ([1], False),
        ("text", False),
    ]
    rows = [(index, json.dumps(case)) for index, (case, _) in enumerate(cases)]
    df = spark.createDataFrame(rows, "id INT, payload STRING")
    got = validate_events(decode_payloads(df)).orderBy("id").collect()
    assert [row.valid for row in got] == [right for _, right in cases]
    assert (got[2].status_code, got[7].response_bytes, got[10].endpoint) == (200, 12, "/x")
