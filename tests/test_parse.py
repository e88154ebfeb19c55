import random

from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st

from tidelog.operators import parse
from tidelog.schema import EVENT_SCHEMA, LOG_PATTERN
from tidelog.sources.logs import read_lines
from tests.samples import CONTROLLED_LOG, log_line


def fields(df, *names):
    return [tuple(row) for row in df.select(*names).collect()]


def test_schema_and_utc(spark, lines_of):
    got = parse.read_events(
        lines_of([log_line("GET /filter/test HTTP/1.1", "10/Oct/2000:13:55:36 -0700", "200", "1234")])
    )
    assert [f.dataType for f in got.schema] == [f.dataType for f in EVENT_SCHEMA]
    row = got.select("*", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("t")).first()
    assert row.t == "2000-10-10 20:55:36"
    assert (row.method, row.endpoint, row.protocol) == ("GET", "/filter/test", "HTTP/1.1")
    assert (row.status_code, row.response_bytes) == (200, 1234)


def test_one_reason_each(spark, lines_of):
    lines = [
        *CONTROLLED_LOG[:3],
        "no log line",
        log_line(time="99/Foo/2026:10:00:00 +0000"),
        log_line("BROKEN"),
    ]
    parsed = parse.parse_lines(lines_of(lines))
    quality = parse.data_quality(parse.count_lines(parsed)).first().asDict()
    assert quality == {
        "total_raw_lines": 6,
        "valid_records": 3,
        "invalid_records": 3,
        "invalid_format_records": 1,
        "invalid_timestamp_records": 1,
        "invalid_request_records": 1,
        "invalid_percentage": 50.0,
    }
    reasons = fields(parse.rejected_records(parsed), "rejection_reason")
    assert sorted(reasons) == [("invalid_format",), ("invalid_request",), ("invalid_timestamp",)]
    breakdown = fields(parse.rejected_breakdown(parse.count_lines(parsed)), "rejection_reason", "count")
    assert breakdown == [("invalid_format", 1), ("invalid_request", 1), ("invalid_timestamp", 1)]
    assert parse.rejected_sample(parse.rejected_records(parsed), 2).count() == 2


def test_quality_of_nothing(spark, lines_of):
    quality = parse.data_quality(parse.count_lines(parse.parse_lines(lines_of([])))).first()
    assert (quality.total_raw_lines, quality.invalid_percentage) == (0, 0.0)


def test_sizes(spark, lines_of):
    sizes = ["-", "0", "12", "3000000000", "1x", "99999999999999999999"]
    parsed = parse.parse_lines(lines_of([log_line(size=size) for size in sizes]))
    assert fields(parsed, "response_bytes") == [(0,), (0,), (12,), (3000000000,), (0,), (0,)]


def test_requests(spark, lines_of):
    requests = ["GET /a b HTTP/1.1", "GET  /x HTTP/1.1", "GET /x", "", "A B "]
    parsed = parse.parse_lines(lines_of([log_line(text) for text in requests]))
    assert fields(parsed, "method", "endpoint", "protocol", "request_valid") == [
        ("GET", "/a", "b HTTP/1.1", True),
        ("GET", "", "/x HTTP/1.1", True),
        (None, "GET /x", None, False),
        (None, "", None, False),
        ("A", "B", "", True),
    ]


def test_blanks_around_a_line(spark, lines_of):
    lines = lines_of([log_line() + " ", "\t" + log_line(), log_line()])
    assert parse.read_events(lines).count() == 1
    assert parse.replay_events(lines).count() == 3


def test_byte_order_mark_in_a_file(spark, tmp_path):
    (tmp_path / "a.log").write_bytes(("\ufeff" + log_line() + "\n" + log_line() + "\n").encode())
    assert parse.read_events(read_lines(spark, str(tmp_path))).count() == 2


def _pattern_groups(lines):
    return lines.select(
        *[
            F.regexp_extract("value", LOG_PATTERN, number).alias(name)
            for number, name in enumerate(parse.GROUPS, start=1)
        ]
    )


def test_cutting_at_quotes_equals_the_pattern(spark, lines_of):
    """Random damage to valid lines: the groups are those of the whole pattern."""
    source = random.Random(7)
    pieces = ['"', " ", "]", "[", "a", "7", "\t", "-", '" "', '] "', "\u00e9", "\x0b", "\u2028"]
    texts = []
    for _ in range(6000):
        text = source.choice(CONTROLLED_LOG)
        for _ in range(source.randrange(4)):
            place = source.randrange(len(text) + 1)
            kind = source.randrange(3)
            if kind == 0:
                text = text[:place] + source.choice(pieces) + text[place:]
            elif kind == 1:
                text = text[:place] + text[place + source.randrange(1, 4):]
            else:
                text = text[:place] + source.choice(pieces) + text[place + 1:]
        texts.append(text)
    lines = lines_of(texts)
    ours = [tuple(r) for r in parse.access_log_groups(lines).select(*parse.GROUPS).collect()]
    pattern = [tuple(r) for r in _pattern_groups(lines).collect()]
    wrong = [(t, a, b) for t, a, b in zip(texts, ours, pattern) if a != b]
    assert not wrong, wrong[:3]
    assert 500 < sum(1 for row in pattern if row[0]) < 6000


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet='ab" []7-', max_size=25), min_size=1, max_size=40))
def test_groups_of_arbitrary_text(spark, texts):
    lines = spark.createDataFrame(
        [(f'i - - [t] "{text}" 200 5 "{text[::-1]}" "u" "{text[:3]}"',) for text in texts], "value STRING"
    )
    ours = [tuple(r) for r in parse.access_log_groups(lines).select(*parse.GROUPS).collect()]
    assert ours == [tuple(r) for r in _pattern_groups(lines).collect()]
