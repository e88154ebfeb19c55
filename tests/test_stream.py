import base64
import json
import random

import pytest
from pyspark.sql import functions as F

from tidelog.functions.keys import delta_key, partition_key, sanitize_key
from tidelog.operators import events as ops
from tidelog.operators.parse import replay_events
from tidelog.operators.replay import replay_records, replay_statistics
from tidelog.sources.envelopes import explode_records
from tidelog.sources.generator import load_events
from tidelog.sources.logs import read_replay_lines
from tidelog.plans.global_window import run_global
from tidelog.plans.serving import run_serving
from tidelog.streaming.job import StreamJob
from tidelog.streaming.replay import read_event_stream, start_replay
from tests.samples import CONTROLLED_LOG, event, log_line


def record(payload, sequence="1", event_id="shard:1", **more):
    data = base64.b64encode(payload if isinstance(payload, bytes) else json.dumps(payload).encode())
    return {
        "eventID": event_id,
        "kinesis": {"data": data.decode(), "partitionKey": "k", "sequenceNumber": sequence, **more},
    }


def invocations(spark, *values):
    return spark.createDataFrame([(json.dumps(value),) for value in values], "value STRING")


AT = "2026-07-31T10:00:00+00:00"


def test_decoding(spark):
    good = event("a", AT)
    cases = [
        (record(good, "s1"), "s1", True),
        (record(good, None, "e2"), "e2", True),
        (record(good, "", None), "record-2", True),
        (record([1], "s4"), "s4", False),
        (record(b"\xff\xfe", "s5"), "s5", False),
        (record(b"not json", "s6"), "s6", False),
        (record(good, "s7", data="***"), "s7", False),
        (record(good, "s8", data="YWJj\n"), "s8", False),
        (record(good, "s9", data=12345678), "s9", False),
        ({"eventID": "e10"}, "e10", False),
        ({"eventID": "e11", "kinesis": "text"}, "e11", False),
        ("text", "record-11", False),
        (7, "record-12", False),
        (record(event("b", "2026-07-31T10:00:00"), "s14"), "s14", False),
    ]
    lines = invocations(spark, {"Records": [case for case, _, _ in cases]})
    decoded = ops.decode_records(explode_records(lines)).persist()
    got = [(r.identifier, r.valid) for r in decoded.orderBy("record_index").collect()]
    assert got == [(identifier, valid) for _, identifier, valid in cases]
    failed = {r.item_identifier for r in ops.batch_item_failures(decoded).collect()}
    assert failed == {identifier for _, identifier, valid in cases if not valid}
    summary = ops.invocation_summary(decoded, F.lit(3), F.lit(0)).first()
    assert tuple(summary) == (14, 3, 11, 3, 0)
    decoded.unpersist()


@pytest.mark.parametrize("value", [{"Records": "none"}, {"Records": {}}, {}, [], 7])
def test_malformed_invocations_are_empty(spark, value):
    assert explode_records(invocations(spark, value)).count() == 0


def test_bare_record(spark):
    assert ops.decode_records(explode_records(invocations(spark, record(event("a", AT))))).first().valid


def test_keys(spark):
    df = spark.createDataFrame([("a b/c",), ("--x--",), ("ok_1.2",), ("///",)], "t STRING")
    got = [r[0] for r in df.select(sanitize_key(F.col("t"))).collect()]
    assert got[:3] == ["a-b-c", "x", "ok_1.2"] and len(got[3]) == 32
    clients = spark.createDataFrame([("1.2.3.4",), ("",), (None,)], "ip STRING")
    assert [r[0] for r in clients.select(partition_key(F.col("ip"))).collect()] == ["1.2.3.4", "unknown", "unknown"]
    at = F.to_timestamp(F.lit("2026-07-31 10:02:03.5"))
    key = spark.range(1).select(delta_key("/speed/batches/", at, F.lit("req 1"))).first()[0]
    assert key == "speed/batches/2026/07/31/10/20260731T100203500000Z-req-1.json"


def test_enriched_events_keep_their_fields(spark, lines_of):
    base = replay_events(lines_of(CONTROLLED_LOG))
    enriched = ops.enrich_events(base)
    assert sorted(map(str, enriched.select(*base.columns).collect())) == sorted(map(str, base.collect()))
    assert enriched.select("event_id").distinct().count() == 7
    payload = json.loads(ops.encode_events(enriched).first().payload)
    assert payload["source"] == "nginx_access_log" and payload["timestamp"] == "2027-03-17T22:59:40+00:00"
    assert len(payload) == 12


def test_equal_lines_get_stable_different_ids(spark, lines_of):
    lines = lines_of([log_line()] * 50 + ["bad"]).repartition(3)
    records = replay_records(lines, "run", 7)
    first = {r.payload.split('"event_id":"')[1][:36] for r in records.collect()}
    again = {r.payload.split('"event_id":"')[1][:36] for r in records.collect()}
    assert len(first) == 50 and first == again
    for row in records.groupBy("split", "batch").count().collect():
        assert row["count"] <= 7
    with pytest.raises(ValueError):
        replay_records(lines, "run", 501)


def written_ids(spark, path, run="run"):
    records = replay_records(read_replay_lines(spark, path), run)
    return sorted((r.sequence_number, r.payload.split('"event_id":"')[1][:36]) for r in records.collect())


def test_ids_follow_from_the_lines_alone(spark, tmp_path):
    """Other splits, other cores and other orders of the files give the same ids."""
    hot, others = log_line(), [log_line(f"GET /{n % 90} HTTP/1.1") for n in range(400)]
    lines = [hot if n % 3 == 0 else others[n] for n in range(400)]
    logs = tmp_path / "logs"
    logs.mkdir()
    (logs / "a.log").write_text("\n".join(lines) + "\n")
    (logs / "b.log").write_text("\n".join([hot] * 30) + "\n")
    found = []
    for split, partitions in (("128m", "8"), ("700b", "8"), ("4k", "3")):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            assert split == "128m" or spark.read.text(str(logs)).rdd.getNumPartitions() > 8
            found.append(written_ids(spark, str(logs)))
        finally:
            for name in ("files.maxPartitionBytes", "files.openCostInBytes"):
                spark.conf.unset(f"spark.sql.{name}")
            spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert found[0] == found[1] == found[2]
    assert len({event_id for _, event_id in found[0]}) == len(lines) + 30
    assert sorted(int(name.rsplit("-", 1)[1]) for name, _ in found[0])[-1] == len(lines) // 3
    assert not {i for _, i in found[0]} & {i for _, i in written_ids(spark, str(logs), "other run")}


def test_records_without_ids_keep_all_events(spark, tmp_path):
    """A position in a batch is no identity: it is the same in every invocation."""
    job = StreamJob(str(tmp_path / "recent"), 120)
    bare = lambda item: {"Records": [record(item, None, None)]}
    items = [event("", f"2026-07-31T10:00:0{n}+00:00", endpoint=f"/{n}") for n in range(3)]
    job.process(invocations(spark, *map(bare, items)), 0)
    job.process(invocations(spark, bare(items[1])), 1)  # sent again
    stored = job.store.read(spark).select("identity", "sequence_number").collect()
    assert len(stored) == 4 and all(row.identity.startswith("fallback:") for row in stored)
    assert {row.sequence_number for row in stored} == {""}
    assert job.read_snapshot(spark, "window_summary").first().window_event_count == 3


def test_replay_files(spark, tmp_path):
    source, out = tmp_path / "logs", str(tmp_path / "records")
    source.mkdir()
    (source / "a.log").write_text("\n".join(CONTROLLED_LOG) + "\n")
    (source / "b.log").write_bytes(log_line("GET /café HTTP/1.1").encode("latin-1") + b"\n")
    start_replay(spark, str(source), out, str(tmp_path / "checkpoint"), batch_size=3).awaitTermination()
    sent = read_event_stream(spark, out)
    lines = read_replay_lines(spark, str(source))
    counts = replay_statistics(lines, sent, 3).first().asDict()
    assert counts.pop("batches_sent") >= 3
    assert counts == {
        "total_lines": 10, "valid_records": 8, "invalid_lines": 2, "successful_records": 8, "failed_records": 0,
        "batches_fit": True,
    }
    lost = replay_statistics(lines, sent.limit(6), 2).first()
    assert (lost.successful_records, lost.failed_records) == (6, 2)
    assert not replay_statistics(lines, sent.withColumn("batch", F.lit(0)), 3).first().batches_fit
    decoded = ops.decode_records(explode_records(spark.read.text(out)))
    endpoints = {r.endpoint for r in decoded.filter("valid").collect()}
    assert "/caf�" in endpoints and len(endpoints) == 5


def test_two_replayed_logs_keep_all_events(spark, tmp_path):
    out = lambda name: str(tmp_path / name)
    for log in ("a", "b"):
        (tmp_path / log).mkdir()
        (tmp_path / log / "x.log").write_text("\n".join([log_line(f"GET /{log} HTTP/1.1")] * 2) + "\n")
        start_replay(spark, out(log), out(f"records/{log}"), out(f"c-{log}")).awaitTermination()
    decoded = ops.decode_records(explode_records(spark.read.text([out("records/a"), out("records/b")], recursiveFileLookup=True)))
    ids = [row.event_id for row in decoded.filter("valid").select("event_id").collect()]
    assert len(ids) == len(set(ids)) == 4


def test_unreadable_lines_are_invalid_records(spark, tmp_path):
    lines = spark.createDataFrame([('{"Records": []}',), ('{"Records": [{"kine',), ("garbage",)], "value STRING")
    assert [row.record_index for row in explode_records(lines).collect()] == [0, 0]
    job = StreamJob(str(tmp_path / "recent"), 120)
    job.process(lines, 0)
    summary = job.read_invocations(spark).first().asDict()
    assert summary["received_records"] == 2 and summary["invalid_records"] == 2
    assert job.read_dead_letters(spark).count() == 2


def test_load_events(spark):
    requests = spark.range(600).selectExpr("id", "concat('10.0.0.', id % 3) AS client_ip", "1700000000 + id AS sec", "'GET' AS method")
    found = load_events(requests, "/load")
    totals = found.agg(F.count_if(F.col("status_code") == 500), F.sum("response_bytes"), F.countDistinct("timestamp")).first()
    assert tuple(totals) == (30, 134700, 600)


def send(folder, name, records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps({"Records": records}) + "\n")


def snapshot(spark, job):
    rows = lambda section, *names: sorted(map(tuple, job.read_snapshot(spark, section).select(*names).collect()))
    return {
        "endpoints": rows("endpoints", "endpoint", "total_requests", "error_count", "total_response_bytes"),
        "status": rows("status_code_distribution", "status_code", "request_count"),
        "summary": rows("window_summary", "window_start", "window_end", "window_event_count"),
    }


@pytest.fixture
def arrivals():
    source = random.Random(3)
    records = []
    for index in range(60):
        minute, second = divmod(source.randrange(600), 60)
        item = event(
            f"e{index}", f"2026-07-31T10:{minute:02d}:{second:02d}+00:00",
            500 if index % 3 == 0 else 200, endpoint=f"/{index % 4}",
        )
        if index % 11 == 0:
            item["endpoint"] = ""
        records.append(record(item, f"s{index}"))
        if index % 5 == 0:
            records.append(record(item, f"s{index}"))
    source.shuffle(records)
    return records


@pytest.mark.parametrize("parts", [1, 4])
def test_any_split_gives_the_same_window(spark, tmp_path, arrivals, parts):
    folder = tmp_path / "in"
    for part in range(parts):
        send(folder, f"{part}.json", arrivals[part::parts])
    job = StreamJob(str(tmp_path / "out"), 300)
    job.start(spark, str(folder), str(tmp_path / "checkpoint"), files_per_trigger=1).awaitTermination()

    right = {}
    newest = 0
    for item in arrivals:
        fields = json.loads(base64.b64decode(item["kinesis"]["data"]))
        if fields["endpoint"]:
            seconds = int(fields["timestamp"][14:16]) * 60 + int(fields["timestamp"][17:19])
            newest = max(newest, seconds)
            right[fields["event_id"]] = (seconds, fields["endpoint"], fields["status_code"])
    inside = [value for value in right.values() if value[0] >= newest - 300]
    found = snapshot(spark, job)
    assert found["endpoints"] == sorted(
        (
            name,
            sum(1 for _, e, _ in inside if e == name),
            sum(1 for _, e, s in inside if e == name and s >= 400),
            100 * sum(1 for _, e, _ in inside if e == name),
        )
        for name in {e for _, e, _ in inside}
    )
    assert found["summary"][0][2] == len(inside)
    run_global(spark, job.deltas, str(tmp_path / "global"), 300, stored=True)
    rows = lambda table, *names: sorted(
        map(tuple, spark.read.parquet(str(tmp_path / "global" / table)).select(*names).collect())
    )
    assert found["endpoints"] == rows(
        "endpoints", "endpoint", "total_requests", "error_count", "total_response_bytes"
    )
    assert rows("statistics", "unique_events", "window_event_count") == [(len(right), len(inside))]
    counts = job.read_invocations(spark).agg(
        F.sum("received_records"), F.sum("processed_records"), F.sum("invalid_records")
    ).first()
    assert counts[0] == len(arrivals) and counts[1] + counts[2] == counts[0]
    assert job.read_dead_letters(spark).count() == counts[2]


def test_a_micro_batch_that_runs_again_changes_nothing(spark, tmp_path):
    job = StreamJob(str(tmp_path / "out"), 300)
    one = invocations(spark, {"Records": [record(event("a", AT), "s1"), record([1], "s2")]})
    two = invocations(
        spark,
        {"Records": [record(event("a", AT), "s1"), record(event("b", "2026-07-31T10:04:00Z"), "s3")]},
        {"Records": [record(event("late", "2026-07-31T09:58:59Z"), "s4")]},
    )
    job.process(one, 0)
    job.process(two, 1)
    first = snapshot(spark, job)
    stored = lambda: sorted(map(str, job.store.read(spark).drop("processed_at").collect()))
    deltas, counts = stored(), sorted(map(tuple, job.read_invocations(spark).collect()))
    job.process(two, 1)
    assert snapshot(spark, job) == first
    assert stored() == deltas
    assert sorted(map(tuple, job.read_invocations(spark).collect())) == counts
    assert len(deltas) == 5  # The late event is stored, not counted; one record is no event.
    assert first["summary"] == [("2026-07-31T09:59:00+00:00", "2026-07-31T10:04:00+00:00", 2)]
    nothing_new = invocations(spark, {"Records": [record([1], "s9")]})
    job.process(nothing_new, 2)
    assert snapshot(spark, job) == first


def test_window_over_midnight_and_hours(spark, tmp_path):
    job = StreamJob(str(tmp_path / "out"), 7200)
    times = ["2026-07-30T22:30:00Z", "2026-07-30T23:30:00Z", "2026-07-31T00:29:59Z", "2026-07-30T21:00:00Z"]
    for batch, time in enumerate(times):
        job.process(invocations(spark, {"Records": [record(event(f"e{batch}", time), f"s{batch}")]}), batch)
    assert snapshot(spark, job)["summary"][0][2] == 3


def test_nothing_written_yet(spark, tmp_path):
    with pytest.raises(ValueError):
        StreamJob(str(tmp_path / "none")).read_snapshot(spark, "endpoints")
    with pytest.raises(ValueError):
        StreamJob(str(tmp_path / "none"), window_seconds=0)


def test_a_snapshot_keeps_the_settings_of_its_writer(spark, tmp_path):
    times = [f"2026-07-31T10:0{minute}:{second:02d}+00:00" for minute, second in ((0, 5), (1, 0), (1, 20), (1, 40))]
    lines = invocations(spark, {"Records": [record(event(f"e{n}", at), f"s{n}") for n, at in enumerate(times)]})
    StreamJob(str(tmp_path / "out"), 60, 0.01, 1).process(lines, 0)
    for reader in (StreamJob(str(tmp_path / "out")), StreamJob(str(tmp_path / "out"), 60, 0.01, 1)):
        summary = reader.read_snapshot(spark, "window_summary").first()
        assert summary["window_event_count"] == 3
        assert (summary["window_seconds"], summary["recent_rpm"]) == (60, 3.0)


def test_log_files_to_serving_view(spark, tmp_path):
    """The whole way: log files, batch tables, replayed records, stream window, view."""
    from tidelog.plans.batch import run_batch

    logs, out = tmp_path / "logs", lambda name: str(tmp_path / name)
    logs.mkdir()
    (logs / "a.log").write_text("\n".join(CONTROLLED_LOG) + "\n")
    run_batch(spark, str(logs), out("batch"))
    start_replay(spark, str(logs), out("records"), out("c1")).awaitTermination()
    job = StreamJob(out("recent"), 120)
    job.start(spark, out("records") + "/*", out("c2")).awaitTermination()
    run_serving(spark, out("batch"), None, out("view"), stream=job)
    rows = {r.endpoint: r for r in spark.read.parquet(out("view") + "/endpoint_comparison").collect()}
    assert {e: (r.historical_requests, r.recent_requests) for e, r in rows.items()} == {
        "/catalog": (2, 1), "/catalog/7": (2, 1), "/cart": (2, 1), "/style.css": (1, 1)
    }
    totals = spark.read.parquet(out("view") + "/totals").first()
    assert tuple(totals) == (7, 4, 2000, 1280)
