"""Raw access-log lines to events, rejected lines and data quality."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.columns import strip, with_once
from tidelog.functions.instants import log_time
from tidelog.schema import EVENT_COLUMNS, LOG_PATTERN, REJECTED_SAMPLE_SIZE

# The part of the pattern outside the quoted texts. A line with exactly eight quotes is
# cut at them, so only its short unquoted parts are matched.
UNQUOTED = r'^(\S+) \S+ \S+ \[([^\]]+)\] " (\d{3}) (\S+) \z'


# Fixed place of each group: among the pieces between quotes or the groups matched in the
# unquoted text, and among the groups of the whole pattern.
PLACES = {
    "client_ip": ("matched[0]", "matched[0]"),
    "timestamp_raw": ("matched[1]", "matched[1]"),
    "request_raw": ("quoted[1]", "matched[2]"),
    "status_code_raw": ("matched[2]", "matched[3]"),
    "response_bytes_raw": ("matched[3]", "matched[4]"),
    "referrer": ("quoted[3]", "matched[5]"),
    "user_agent": ("quoted[5]", "matched[6]"),
    "extra": ("quoted[7]", "matched[7]"),
}
GROUPS = list(PLACES)


def _rewritten(text: Column, pattern: str, groups: int) -> Column:
    """The groups of a pattern as an array of that size; another size means no match.

    The pattern runs once: its groups are rewritten as lines of text and split. A log
    line holds no line break itself, so the break is a safe separator.
    """
    return F.split(
        F.regexp_replace(text, pattern, "\n".join(f"${n}" for n in range(1, groups + 1))), "\n", -1
    )


def access_log_groups(
    lines: DataFrame, column: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """``raw_line`` and the eight text groups, all '' for a line of another format.
    Columns named in ``keep`` stay beside them.

    With eight quotes none can lie inside an unquoted part, so cutting at the quotes
    gives the same groups as the whole pattern. More quotes need the whole pattern, and
    with fewer there is no match.
    """
    line = F.col("raw_line")
    taken = lines.select(*keep, F.col(column).alias("raw_line"))
    cut = with_once(taken, quoted=F.split(line, '"', -1))
    # The end of the pattern also matches before a last line or paragraph separator.
    at_end = F.expr("quoted[4] = ' ' AND quoted[6] = ' '") & F.expr("quoted[8]").isin(
        "", "\u0085", "\u2028", "\u2029"
    )
    unquoted = F.expr("quoted[0] || '\"' || quoted[2]")
    by_quotes = F.when(
        F.expr("size(quoted) = 9") & at_end, _rewritten(unquoted, UNQUOTED, 4)
    ).when(F.expr("size(quoted) > 9"), _rewritten(line, LOG_PATTERN, 8))
    matched = with_once(cut, matched=F.when(~F.contains(line, F.lit("\n")), by_quotes))
    return matched.selectExpr(
        *keep,
        "raw_line",
        *[
            f"CASE size(matched) WHEN 4 THEN {cut_out} WHEN 8 THEN {whole} ELSE '' END AS {name}"
            for name, (cut_out, whole) in PLACES.items()
        ],
    )


def parse_lines(
    lines: DataFrame, column: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """Every line with its typed fields and the three validity flags.

    A request that has not three parts stays whole as the endpoint. Sizes that are not
    digits only, such as ``-``, are 0.
    """
    staged = with_once(
        access_log_groups(lines, column, keep),
        timestamp=log_time(F.col("timestamp_raw")),
        request_parts=F.split("request_raw", " ", 3),
    )
    return staged.selectExpr(
        *keep,
        "raw_line",
        "client_ip",
        "timestamp",
        "CASE WHEN size(request_parts) = 3 THEN request_parts[0] END AS method",
        "CASE WHEN size(request_parts) = 3 THEN request_parts[1] ELSE request_raw END AS endpoint",
        "CASE WHEN size(request_parts) = 3 THEN request_parts[2] END AS protocol",
        "try_cast(status_code_raw AS INT) AS status_code",
        "coalesce(try_cast(CASE WHEN response_bytes_raw RLIKE '^[0-9]+$' THEN response_bytes_raw END"
        " AS BIGINT), 0L) AS response_bytes",
        "referrer",
        "user_agent",
        "client_ip <> '' AS format_valid",
        "timestamp IS NOT NULL AS timestamp_valid",
        "size(request_parts) = 3 AS request_valid",
    )


def is_valid() -> Column:
    return F.col("format_valid") & F.col("timestamp_valid") & F.col("request_valid")


def valid_events(parsed: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return parsed.filter(is_valid()).select(*keep, *EVENT_COLUMNS)


def rejection_reason() -> Column:
    """The first check a line fails; null for a valid line."""
    return (
        F.when(~F.col("format_valid"), "invalid_format")
        .when(~F.col("timestamp_valid"), "invalid_timestamp")
        .when(~F.col("request_valid"), "invalid_request")
    )


def rejected_records(parsed: DataFrame) -> DataFrame:
    return parsed.filter(~is_valid()).select("raw_line", rejection_reason().alias("rejection_reason"))


def read_events(lines: DataFrame) -> DataFrame:
    """Lines straight to valid events, the batch rule."""
    return valid_events(parse_lines(lines))


def replay_events(
    lines: DataFrame, column: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """Lines to valid events, the replay rule: blanks around a line do not matter."""
    trimmed = lines.withColumn(column, strip(F.col(column)))
    return valid_events(parse_lines(trimmed, column, keep), keep)


def count_lines(parsed: DataFrame) -> DataFrame:
    """One row per line: ``reason`` (null for a valid line) and ``requests``, 1."""
    return parsed.select(rejection_reason().alias("reason"), F.lit(1).cast("bigint").alias("requests"))


def data_quality(counts: DataFrame) -> DataFrame:
    """One row: lines, valid records, and rejected records by reason.

    ``counts`` has ``reason`` and ``requests``, a row per line or already added up.
    """
    reason = F.col("reason")
    of = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("requests"))), F.lit(0))
    counted = counts.agg(
        of(F.lit(True)).alias("total_raw_lines"),
        of(reason.isNull()).alias("valid_records"),
        of(reason.isNotNull()).alias("invalid_records"),
        of(reason == "invalid_format").alias("invalid_format_records"),
        of(reason == "invalid_timestamp").alias("invalid_timestamp_records"),
        of(reason == "invalid_request").alias("invalid_request_records"),
    )
    share = F.try_divide(
        F.col("invalid_records").cast("double"), F.col("total_raw_lines").cast("double")
    )
    return counted.withColumn(
        "invalid_percentage", F.coalesce(F.round(share * 100, 2), F.lit(0.0))
    )


def rejected_breakdown(counts: DataFrame) -> DataFrame:
    """Rejected lines by reason, from the same counts."""
    return (
        counts.filter(F.col("reason").isNotNull())
        .groupBy(F.col("reason").alias("rejection_reason"))
        .agg(F.sum("requests").alias("count"))
        .orderBy(F.desc("count"), "rejection_reason")
    )


def rejected_sample(rejected: DataFrame, size: int = REJECTED_SAMPLE_SIZE) -> DataFrame:
    """A repeatable sample of rejected lines for inspection."""
    if size < 1:
        raise ValueError("the sample size must be at least 1")
    return rejected.orderBy("rejection_reason", "raw_line").limit(size)
