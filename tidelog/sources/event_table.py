"""The parsed log as a stored table, so that every job reads the text once.

Valid events lie in partitions of their UTC day and hour, rejected lines in partitions of
their reason. A small table beside it holds a row per hour with its oldest and newest
event: a recent window takes its bound from there, as plain values, and then reads the
few hours it touches.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators.parse import parse_lines, rejection_reason, replay_events
from tidelog.schema import EVENT_COLUMNS, EVENT_SCHEMA, check_window

VALID = "valid"
LINE_SCHEMA = (
    "raw_line STRING, "
    + ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in EVENT_SCHEMA)
    + ", load STRING, kind STRING, event_date STRING, event_hour STRING"
)
HOUR_SCHEMA = "event_date STRING, event_hour STRING, events BIGINT, oldest TIMESTAMP, newest TIMESTAMP, load STRING"
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def hours_from(start: datetime) -> Column:
    """Partitions that can hold events from ``start`` on, as a filter on plain values."""
    day, hour = F.lit(f"{start:%Y-%m-%d}"), F.lit(f"{start:%H}")
    return (F.col("event_date") > day) | ((F.col("event_date") == day) & (F.col("event_hour") >= hour))


class EventTable:
    """A stored log below ``root``. Loads are added to it; one that is written again
    replaces itself, so a job that is repeated leaves no second copy."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def write(self, lines: DataFrame, load: str = "all", gather: bool = False) -> None:
        """Parse lines (``value``) and store them, in one pass over the text.

        Every task writes the hours that its lines fall in, which are few in a log that
        is about in the order of time. ``gather`` first brings the lines of an hour
        together, by size, for a log that is not.
        """
        reason = rejection_reason()
        valid = reason.isNull()
        rows = parse_lines(lines).select(
            F.when(~valid, F.col("raw_line")).alias("raw_line"),
            *[F.when(valid, F.col(name)).alias(name) for name in EVENT_COLUMNS],
            F.coalesce(reason, F.lit(VALID)).alias("kind"),
            F.when(valid, F.date_format("timestamp", "yyyy-MM-dd")).alias("event_date"),
            F.when(valid, F.date_format("timestamp", "HH")).alias("event_hour"),
        )
        if gather:
            rows = rows.hint("rebalance", "event_date", "event_hour")
        parts = rows.write.mode("overwrite").partitionBy("kind", "event_date", "event_hour")
        parts.parquet(f"{self.root}/lines/load={load}")
        stored = self.events("event_date", "event_hour", load=load)
        hours = stored.groupBy("event_date", "event_hour").agg(
            F.count("*").alias("events"),
            F.min("timestamp").alias("oldest"),
            F.max("timestamp").alias("newest"),
        )
        hours.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/hours/load={load}")

    def lines(self) -> DataFrame:
        """Every line: ``kind`` says whether it is valid or why it is not."""
        return self.spark.read.schema(LINE_SCHEMA).parquet(f"{self.root}/lines")

    def events(self, *more: str, load: str | None = None) -> DataFrame:
        """The valid events by the batch rule."""
        found = self.lines().filter(F.col("kind") == VALID)
        if load is not None:
            found = found.filter(F.col("load") == load)
        return found.select(*more, *EVENT_COLUMNS)

    def rejected(self) -> DataFrame:
        """``raw_line, rejection_reason``; only the rejected partitions are read."""
        found = self.lines().filter(F.col("kind") != VALID)
        return found.select("raw_line", F.col("kind").alias("rejection_reason"))

    def replayed(self) -> DataFrame:
        """The valid events by the replay rule, which ignores blanks around a line.

        A valid line has no blanks around it, so only rejected ones are parsed again.
        """
        again = replay_events(self.rejected().select(F.col("raw_line").alias("value")))
        return self.events().unionByName(again)

    def hours(self) -> DataFrame:
        """A row per load and hour: ``events``, ``oldest`` and ``newest``."""
        return self.spark.read.schema(HOUR_SCHEMA).parquet(f"{self.root}/hours")

    def newest(self) -> datetime | None:
        """Time of the newest valid event, null for a log without one."""
        micros = self.hours().agg(F.max(F.unix_micros("newest"))).first()[0]
        return None if micros is None else EPOCH + timedelta(microseconds=micros)

    def window(self, window_seconds: int) -> DataFrame:
        """Events from ``newest - W`` on, both ends included; older hours are not read."""
        check_window(window_seconds)
        newest = self.newest()
        if newest is None:
            return self.events().limit(0)
        start = newest - timedelta(seconds=window_seconds)
        return self.lines().filter(
            (F.col("kind") == VALID) & hours_from(start) & (F.col("timestamp") >= F.lit(start))
        ).select(*EVENT_COLUMNS)

    def split(self, window_seconds: int) -> DataFrame:
        """All events with ``recent``: inside the window or before it?"""
        check_window(window_seconds)
        newest = self.newest() or EPOCH
        start = F.lit(newest - timedelta(seconds=window_seconds))
        return self.events().withColumn("recent", F.col("timestamp") >= start)
