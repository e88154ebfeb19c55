"""The record table, versions of snapshots, compaction, latency, unique events, sources."""

from __future__ import annotations

import json
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tests.samples import event
from tests.test_stream import invocations, record, send, snapshot
from tidelog.operators.latency import exact_percentiles
from tidelog.plans.global_window import run_global
from tidelog.session import children
from tidelog.streaming.job import StreamJob
from tidelog.streaming.unique import start_unique
from tidelog.workload.frames import Frames
from tidelog.workload.queries import QUERIES

START = datetime(2026, 7, 31, 21, 30, tzinfo=timezone.utc)


def at(seconds):
    return (START + timedelta(seconds=seconds)).isoformat()


def batch(spark, numbers, shift=0, broken=0):
    records = [
        record(event(f"e{n}", at(60 * n + shift), 500 if n % 4 == 0 else 200, endpoint=f"/{n % 3}",
                     ingested_at=at(60 * n)), f"s{n}-{shift}")
        for n in numbers
    ]
    return invocations(spark, {"Records": records + [record([1], f"bad{n}") for n in range(broken)]})


@pytest.fixture
def filled(spark, tmp_path):
    """Five micro-batches over five hours, with retries and unreadable records."""
    job = StreamJob(str(tmp_path / "out"), 7200)
    draw = random.Random(2)
    for number in range(5):
        numbers = [draw.randrange(300) for _ in range(60)]
        job.process(batch(spark, dict.fromkeys(numbers), broken=number % 3), number)
    return job


def rows(table):
    return sorted(map(str, table.collect()))


def stored_window(spark, job, path):
    run_global(spark, job.deltas, path, 7200, stored=True)
    return rows(spark.read.parquet(f"{path}/endpoints")), rows(spark.read.parquet(f"{path}/statistics"))


def test_compaction_changes_no_answer(spark, tmp_path, filled):
    job = filled
    names = [column for column in job.store.read(spark).columns if column != "processed_at"]
    everything = lambda: rows(job.store.read(spark).select(*names))
    before = everything(), snapshot(spark, job), stored_window(spark, job, str(tmp_path / "g0"))
    letters, summaries = rows(job.read_dead_letters(spark)), rows(job.read_invocations(spark))
    latency = rows(job.read_latency(spark, 1.0))
    planned = job.store.read(spark).select(*names), job.read_snapshot(spark, "endpoints")
    shown = rows(planned[1])
    assert job.compact(spark) == 0
    # readers that had begun end with the old files, new ones take the compacted ones
    assert rows(planned[0]) == before[0] and rows(planned[1]) == shown
    assert (everything(), snapshot(spark, job), stored_window(spark, job, str(tmp_path / "g1"))) == before
    live = job.store.read(spark).join(spark.read.parquet(job.store.live), ["kind", "event_date", "event_hour", "batch_id"], "left_semi")
    assert live.count() == len(before[0])
    compacted = spark.read.parquet(f"{job.store.folded}/version=0")
    assert compacted.count() == len(before[0]) and compacted.rdd.getNumPartitions() < 8
    assert rows(job.read_dead_letters(spark)) == letters and rows(job.read_invocations(spark)) == summaries
    assert rows(job.read_latency(spark, 1.0)) == latency

    job.process(batch(spark, range(200, 260)), 5)
    job.process(batch(spark, range(200, 220), shift=7, broken=1), 6)
    after = everything(), snapshot(spark, job), stored_window(spark, job, str(tmp_path / "g2"))
    second = job.compact(spark)
    assert second == 1
    assert (everything(), snapshot(spark, job), stored_window(spark, job, str(tmp_path / "g3"))) == after
    assert job.compact(spark) is None  # nothing new
    job.process(batch(spark, range(290, 310)), 7)
    job.process(batch(spark, range(290, 330)), 8)
    assert job.compact(spark) == 2
    live = [name for hour in children(spark, f"{job.store.live}/kind=valid") for name in children(spark, f"{job.store.live}/kind=valid/{hour}")]
    assert live and job.read_invocations(spark).count() == 9
    first_hour = f"{job.store.live}/kind=valid/event_date=2026-07-31/event_hour=21"
    assert not [name for name in children(spark, first_hour) if int(name[9:]) <= 4]


def test_a_micro_batch_that_runs_again_after_compaction(spark, filled):
    names = [column for column in filled.store.read(spark).columns if column != "processed_at"]
    before = rows(filled.store.read(spark).select(*names))
    filled.compact(spark)
    draw = random.Random(2)
    for number in range(5):
        numbers = [draw.randrange(300) for _ in range(60)]
    filled.process(batch(spark, dict.fromkeys(numbers), broken=1), 4)
    assert rows(filled.store.read(spark).select(*names)) == before


def test_retention_gives_up_old_hours_only(spark, filled):
    newest = filled.latest(spark)["newest"]
    filled.compact(spark, keep_seconds=7200)
    kept = filled.store.read(spark, "valid")
    oldest = kept.agg(F.min(F.unix_micros("timestamp"))).first()[0]
    assert newest - 3 * 3600 * 10**6 < oldest <= newest - 7000 * 10**6
    assert filled.read_dead_letters(spark).count() > 0
    before = snapshot(spark, filled)
    filled.process(batch(spark, [1], shift=1), 5)  # a late event of an hour that was given up
    assert filled.store.read(spark, "valid").filter("batch_id = 5").count() == 1
    assert snapshot(spark, filled) == before


def test_a_snapshot_that_is_being_read_stays(spark, tmp_path):
    job = StreamJob(str(tmp_path / "out"), 600, kept_versions=7)
    job.process(batch(spark, range(5)), 0)
    lazy = job.read_snapshot(spark, "endpoints")
    shown = rows(lazy)
    for number in range(1, 6):
        job.process(batch(spark, range(5 * number, 5 * number + 5)), number)
    assert rows(lazy) == shown != rows(job.read_snapshot(spark, "endpoints"))
    for number in range(6, 9):
        job.process(batch(spark, range(5 * number, 5 * number + 5)), number)
    assert len(children(spark, f"{job.root}/snapshot")) == 7
    about = job.read_metadata(spark).first()
    assert (about.schema_version, about.layer, about.window_seconds, about.batch_id) == (1, "speed", 600, 8)
    assert about.generated_at is not None


def test_a_crash_before_the_marker_leaves_the_last_snapshot(spark, tmp_path, monkeypatch):
    job = StreamJob(str(tmp_path / "out"), 600)
    job.process(batch(spark, range(5)), 0)
    before = snapshot(spark, job)

    def crash(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(StreamJob, "_write_marker", crash)
    with pytest.raises(RuntimeError):
        job.process(batch(spark, range(5, 9)), 1)
    monkeypatch.undo()
    assert snapshot(spark, job) == before
    job.process(batch(spark, range(5, 9)), 1)
    assert job.read_snapshot(spark, "window_summary").first().window_event_count == 9
    assert job.read_invocations(spark).agg(F.sum("received_records")).first()[0] == 9


def test_latency_of_all_micro_batches(spark, filled):
    stored = filled.store.read(spark, "valid")
    micros = stored.select((F.unix_micros("processed_at") - F.unix_micros("ingested_at")).alias("v"))
    exact = exact_percentiles(micros, "v", {"p50": 0.5, "p95": 0.95}).first()
    found = filled.read_latency(spark, 10.0).first()
    assert found.latency_samples == micros.count() == found.records_processed
    assert found.records_attempted == filled.read_invocations(spark).agg(F.sum("received_records")).first()[0]
    assert (found.latency_p50_ms, found.latency_p95_ms) == (exact.p50 / 1000, exact.p95 / 1000)


def test_any_stream_with_a_value_column(spark, tmp_path):
    """The job does not ask where a stream comes from; here it is made of a rate source."""
    job = StreamJob(str(tmp_path / "out"), 3600)
    ticks = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 20).option("startTimestamp", 1_785_500_000_000).load()
    body = F.to_json(
        F.struct(
            F.concat(F.lit("e"), F.col("value") % 30).alias("event_id"),
            F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
            F.lit("/a").alias("endpoint"),
            F.lit(200).alias("status_code"),
            F.lit(10).alias("response_bytes"),
        )
    )
    data = F.regexp_replace(F.base64(F.encode(body, "UTF-8")), r"\s", "")
    kinesis = F.struct(data.alias("data"), F.col("value").cast("string").alias("sequenceNumber"))
    lines = ticks.select(F.to_json(F.struct(kinesis.alias("kinesis"))).cast("binary").alias("value"))
    query = job.start(spark, lines, str(tmp_path / "c"), every="0 seconds")
    try:
        while not query.lastProgress or query.lastProgress["batchId"] < 3:
            query.awaitTermination(0.2)
    finally:
        query.stop()
    done = job.latest(spark)
    counts = job.read_invocations(spark).orderBy("batch_id").collect()
    assert [row.received_records for row in counts] == [20] * len(counts) and len(counts) >= 3
    assert done["window_event_count"] == 30


def test_unique_events_after_an_invalid_copy_and_a_restart(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "unique")
    good = event("a", at(0))
    send(folder, "0.json", [record(event("a", "never"), "s0"), record(good, "s1"), record(good, "s2"), record(event("b", at(5)), "s3")])
    run = lambda: start_unique(spark, str(folder), out, str(tmp_path / "c"), "10 minutes").awaitTermination()
    names = lambda: sorted(row.event_id for row in spark.read.parquet(out).collect())
    run()
    assert names() == ["a", "b"]
    send(folder, "1.json", [record(good, "s4"), record(event("c", at(9)), "s5"), record(event("d", "never"), "s6")])
    run()
    assert names() == ["a", "b", "c"]
    send(folder, "2.json", [record(event("d", at(20)), "s7"), record(event("c", at(9)), "s8")])
    run()
    assert names() == ["a", "b", "c", "d"]


def test_an_empty_micro_batch(spark, tmp_path):
    job = StreamJob(str(tmp_path / "out"), 60)
    job.process(spark.createDataFrame([], "value STRING"), 0)
    assert tuple(job.read_invocations(spark).first()) == (0, 0, 0, 0, 0, 0)
    with pytest.raises(ValueError):
        job.read_snapshot(spark, "endpoints")
    job.process(invocations(spark, json.loads('{"Records": []}')), 1)
    assert job.compact(spark) is None


def test_write_delta_decodes_its_records_once_for_both_runs(spark, tmp_path, monkeypatch):
    events = spark.range(300).selectExpr("id AS event_id", "id % 7 AS user_id", "'view' AS event_type")
    events.write.parquet(f"{tmp_path}/events.parquet")
    calls, decoded = [], Frames.decoded
    monkeypatch.setattr(Frames, "decoded", lambda self: calls.append(1) or decoded(self))
    found = QUERIES["write_delta"](spark, str(tmp_path))
    assert len(calls) == 1
    valid = Frames(spark, str(tmp_path)).decoded().filter("valid")
    assert sorted(r[0] for r in found.select("event_id").collect()) == sorted(
        r[0] for r in valid.select("event_id").collect()
    )
