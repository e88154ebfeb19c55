"""The stored log: one look at the text, everything else from the table."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.samples import CONTROLLED_LOG, log_line
from tidelog.operators.parse import parse_lines, read_events, rejected_records, replay_events
from tidelog.operators.window import recent_window
from tidelog.plans.batch import line_facts, run_batch
from tidelog.plans.parity import batch_stream_values
from tidelog.sources.event_table import EventTable
from tidelog.sources.logs import read_lines

HOURS = [f"{day}/Jul/2026:{hour:02d}:{minute:02d}:00 +0000" for day in (30, 31) for hour in (0, 7, 23) for minute in (0, 59)]
ODD = [" " + log_line(), log_line() + "\t", log_line("GET /late HTTP/1.1") + "\u2028", "", "x" * 5000, "\u0085"]


def rows(table):
    return sorted(map(str, table.collect()))


def text_scans(frame):
    """How often the plan reads text files."""
    plan = frame._jdf.queryExecution().toString().partition("== Physical Plan ==")[2]
    return plan.count("FileScan text")


@pytest.fixture
def many_lines():
    draw = random.Random(4)
    lines = [log_line(f"GET /{n % 7} HTTP/1.1", draw.choice(HOURS)) for n in range(300)]
    return [*lines, *CONTROLLED_LOG, *ODD]


def test_the_table_holds_what_the_parser_finds(lines_of, event_table_of, many_lines):
    table, lines = event_table_of(many_lines), lines_of(many_lines)
    assert rows(table.events()) == rows(read_events(lines))
    assert rows(table.rejected()) == rows(rejected_records(parse_lines(lines)))
    assert rows(table.replayed()) == rows(replay_events(lines))
    hours = {(r.event_date, r.event_hour): r for r in table.hours().collect()}
    assert hours["2026-07-31", "07"].newest.minute == 59
    assert sum(r.events for r in hours.values()) == table.events().count()


@pytest.mark.parametrize("seconds", [1, 3600, 7200, 86400, 10**9])
def test_windows_are_those_of_all_events(lines_of, event_table_of, many_lines, seconds):
    table = event_table_of(many_lines)
    expected = recent_window(read_events(lines_of(many_lines)), seconds)
    assert rows(table.window(seconds)) == rows(expected)
    marked = table.split(seconds)
    assert rows(marked.filter("recent").drop("recent")) == rows(expected)
    assert marked.count() == table.events().count()


def test_a_window_reads_the_hours_it_touches(event_table_of, many_lines):
    window = event_table_of(many_lines[:300]).window(1800)
    files = {name.split("event_date=")[1].rsplit("/", 1)[0] for name in window.inputFiles()}
    assert len(files) == 6
    plan = window._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan.partition("== Physical Plan ==")[2]
    assert {r.h for r in window.select(F.hour("timestamp").alias("h")).distinct().collect()} == {23}
    metrics = window._jdf.queryExecution().executedPlan()
    window.count()
    assert "event_hour" in str(metrics)


def test_loads_replace_themselves_and_add_up(spark, tmp_path, lines_of):
    table = EventTable(spark, str(tmp_path / "log"))
    table.write(lines_of(CONTROLLED_LOG[:4]), "monday")
    table.write(lines_of(CONTROLLED_LOG[4:]), "tuesday")
    first = rows(table.events())
    table.write(lines_of(CONTROLLED_LOG[4:]), "tuesday", gather=True)
    assert rows(table.events()) == first == rows(read_events(lines_of(CONTROLLED_LOG)))
    assert table.hours().agg(F.sum("events")).first()[0] == 7


def test_a_log_without_valid_lines(event_table_of):
    table = event_table_of(["nothing", ""])
    assert table.newest() is None and table.window(60).count() == 0 == table.split(60).count()
    assert table.rejected().count() == 2
    empty = event_table_of([])
    assert empty.lines().count() == 0 and empty.window(60).count() == 0


def test_the_text_is_read_once(spark, tmp_path, many_lines):
    (tmp_path / "a.log").write_text("\n".join(many_lines) + "\n")
    lines = read_lines(spark, str(tmp_path / "a.log"))
    assert text_scans(parse_lines(lines)) == 1  # the count sees text scans
    table = EventTable(spark, str(tmp_path / "log"))
    table.write(lines)
    for frame in (table.window(300), table.replayed(), line_facts(table.lines()), batch_stream_values(table, 300)):
        assert text_scans(frame) == 0
    run_batch(spark, str(tmp_path / "a.log"), str(tmp_path / "out"))
    (tmp_path / "a.log").write_text("")  # all results are tables of their own
    assert spark.read.parquet(str(tmp_path / "out" / "rejected_sample")).count() > 3
    assert spark.read.parquet(str(tmp_path / "out" / "batch_summary")).first()[0] == table.events().count()
