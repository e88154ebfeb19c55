"""The incremental window gives what the job over all documents gives."""

from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

import pytest

from tests.samples import delta, event
from tests.test_window import documents
from tidelog.operators.aggregates import minute_facts
from tidelog.operators.dedup import aggregation_statistics
from tidelog.plans.global_window import global_window, window_sections
from tidelog.plans.incremental_window import IncrementalWindow
from tidelog.session import stage

START = datetime(2026, 7, 31, 22, 50, tzinfo=timezone.utc)


def random_documents(seed):
    """Retries with other times, invalid copies before and after, a hot identity."""
    draw, texts = random.Random(seed), []
    for _ in range(9):
        events = []
        for _ in range(draw.randrange(0, 25)):
            key = "hot" if draw.random() < 0.34 else f"e{draw.randrange(40)}"
            time = START + timedelta(seconds=draw.randrange(9000))
            item = event(key, time.isoformat(), draw.choice([200, 500]), endpoint=f"/{draw.randrange(4)}")
            if draw.random() < 0.2:
                item["timestamp"] = "never"
            if draw.random() < 0.1:
                item["response_bytes"] = -1
            events.append(draw.choice([item] * 9 + ["text"]))
        texts.append(draw.choice([delta(events)] * 6 + ["not json"]))
    return texts


SECTIONS = ["window_summary", "endpoints", "traffic_by_hour", "status_code_distribution", "anomalies"]


def answers(sections):
    return {name: sorted(map(str, sections(name).collect())) for name in SECTIONS}


def over_all(spark, texts, seconds):
    classified, window = global_window(documents(spark, texts), seconds)
    tables = window_sections(stage(minute_facts(window), "facts"), seconds)
    return answers(tables.__getitem__), aggregation_statistics(classified).first().asDict()


@pytest.mark.parametrize("seed, order", [(1, "given"), (2, "late"), (3, "mixed")])
def test_any_split_of_the_documents(spark, tmp_path, seed, order):
    texts = random_documents(seed)
    keyed = documents(spark, texts).collect()
    draw = random.Random(seed)
    if order == "late":
        keyed = keyed[::-1]  # every run brings earlier copies, which change the winners
    if order == "mixed":
        draw.shuffle(keyed)
    job = IncrementalWindow(str(tmp_path / "state"), 1800)
    run, seen = 0, []
    while keyed:
        size = draw.randrange(2, 5)
        now, keyed = keyed[:size], keyed[size:]
        seen += now
        frame = spark.createDataFrame(now, "doc_key STRING, value STRING")
        job.process(frame, run)
        if run == 1:
            job.process(frame, run)  # a run that is repeated changes nothing
        run += 1
        if run == 2 or not keyed:
            known = {row.doc_key for row in seen}
            so_far = [text if f"doc-{n:04d}" in known else None for n, text in enumerate(texts)]
            whole = spark.createDataFrame(
                [(f"doc-{n:04d}", text) for n, text in enumerate(so_far) if text is not None], "doc_key STRING, value STRING"
            )
            classified, window = global_window(whole, 1800)
            tables = window_sections(stage(minute_facts(window), "facts"), 1800)
            assert answers(lambda name: job.read_snapshot(spark, name)) == answers(tables.__getitem__)
            assert job.statistics(spark).first().asDict() == aggregation_statistics(classified).first().asDict()


def test_a_late_earlier_copy_takes_the_place_of_a_later_one(spark, tmp_path):
    job = IncrementalWindow(str(tmp_path / "state"), 300)
    texts = [
        delta([event("a", (START + timedelta(seconds=1000)).isoformat(), endpoint="/early")]),
        delta([event("a", (START + timedelta(seconds=1100)).isoformat(), endpoint="/later"),
               event("b", (START + timedelta(seconds=900)).isoformat(), endpoint="/b")]),
    ]
    first, second = (spark.createDataFrame([row], "doc_key STRING, value STRING") for row in documents(spark, texts).collect())
    job.process(second, 0)
    shown = lambda: sorted(row.endpoint for row in job.read_snapshot(spark, "endpoints").collect())
    assert shown() == ["/b", "/later"]
    job.process(first, 1)
    assert shown() == ["/b", "/early"]
    summary = job.read_snapshot(spark, "window_summary").first()
    assert summary.window_end.startswith("2026-07-31T23:06:40")


def test_new_files_only_are_read(spark, tmp_path):
    folder = tmp_path / "documents"
    folder.mkdir()
    job = IncrementalWindow(str(tmp_path / "state"), 300)
    run = lambda: job.start(spark, str(folder), str(tmp_path / "c"), files_per_run=2).awaitTermination()
    for part in range(3):
        (folder / f"{part}.json").write_text(delta([event(f"e{part}", START.isoformat()), event("x", START.isoformat())]))
    run()
    (folder / "0.json").write_text("changed, but handled already")
    (folder / "3.json").write_text(delta([event("e3", START.isoformat())]))
    run()
    assert job.statistics(spark).first().asDict() == {
        "scanned_objects": 4, "valid_documents": 4, "invalid_documents": 0, "raw_events": 7,
        "unique_events": 5, "duplicate_events": 2, "invalid_events": 0,
    }
    assert job.runs.read(spark).count() == 3
    with pytest.raises(ValueError):
        IncrementalWindow(str(tmp_path / "none")).read_snapshot(spark, "endpoints")


def test_documents_without_events(spark, tmp_path):
    job = IncrementalWindow(str(tmp_path / "state"), 300)
    job.process(documents(spark, ["not json", delta([])]), 0)
    assert job.read_snapshot(spark, "endpoints").count() == 0
    assert job.statistics(spark).first().invalid_documents == 1
