"""The recent-traffic job: transport records in, stored records and a window snapshot out.

Every micro-batch is decoded once and written once, valid events and the rest side by
side. Then the window is computed from the few hours it can touch, so the cost of a
trigger follows the window and not the history. There is no streaming state: late events
inside the window count, older ones are only stored.

A micro-batch that runs again replaces what it wrote the first time. Its snapshot is a new
version each time; a marker, written last, says which version is the latest, so readers
always find a complete one, and one they have begun to read stays as it is.
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass, replace
from datetime import datetime, timedelta, timezone
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelog.operators.aggregates import minute_facts
from tidelog.operators.events import decode_records
from tidelog.operators.latency import latency_report
from tidelog.operators.window import recent_window
from tidelog.plans.global_window import window_sections
from tidelog.plans.sinks import write_table
from tidelog.schema import (
    ERROR_RATE_THRESHOLD,
    MINIMUM_REQUESTS_FOR_ANOMALY,
    SNAPSHOT_LAYER,
    SNAPSHOT_SCHEMA_VERSION,
    WINDOW_SECONDS,
    check_anomaly_thresholds,
    check_window,
)
from tidelog.session import build_session, children, configure, remove
from tidelog.sources.envelopes import explode_records
from tidelog.sources.logs import stream_lines
from tidelog.streaming.batch_log import BatchLog
from tidelog.streaming.records import INVALID, RecordStore, record_rows

#: Snapshots that stay for readers, the latest included.
KEPT_VERSIONS = 20
#: What a marker holds of the settings its snapshot was made with.
SETTINGS = {"window_seconds": "bigint", "error_rate_threshold": "double", "minimum_requests": "bigint"}
SUMMARY = ["received_records", "processed_records", "invalid_records", "window_event_count", "anomaly_count"]
MARKER_FIELDS = ", ".join(
    [
        "schema_version int, layer string, generated_at timestamp, version string, newest bigint",
        *[f"{name} bigint" for name in SUMMARY],
        *[f"{name} {kind}" for name, kind in SETTINGS.items()],
    ]
)
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def first_copies(deltas: DataFrame) -> DataFrame:
    """One event per identity: the copy of the earliest micro-batch and position."""
    place = F.struct("batch_id", "position")
    fields = ["timestamp", "endpoint", "status_code", "response_bytes"]
    return (
        deltas.groupBy("identity")
        .agg(F.min_by(F.struct(*fields), place).alias("event"))
        .select("event.*")
    )


@dataclass(frozen=True)
class StreamJob:
    """Where a stream job writes and how it judges the window."""

    root: str
    window_seconds: int = WINDOW_SECONDS
    error_rate_threshold: float = ERROR_RATE_THRESHOLD
    minimum_requests: int = MINIMUM_REQUESTS_FOR_ANOMALY
    kept_versions: int = KEPT_VERSIONS

    def __post_init__(self) -> None:
        check_window(self.window_seconds)
        check_anomaly_thresholds(self.error_rate_threshold, self.minimum_requests)

    @property
    def deltas(self) -> str:
        return f"{self.root}/records"

    @property
    def store(self) -> RecordStore:
        return RecordStore(self.deltas)

    def process(self, lines: DataFrame, batch_id: int) -> None:
        """Handle one micro-batch of envelope lines (``value``)."""
        spark = lines.sparkSession
        text = lines.select(F.col("value").cast("string").alias("value"))
        decoded = decode_records(explode_records(text)).withColumn("processed_at", F.current_timestamp())
        counts = self.store.write(record_rows(decoded, batch_id), batch_id)
        known = [counts.get("newest"), self._stored_newest(spark, batch_id)]
        newest = max((time for time in known if time is not None), default=None)
        version = None if newest is None else f"{batch_id:012d}-{uuid4().hex}"
        found = {name: counts.get(name) or 0 for name in SUMMARY[:3]}
        found["window_event_count"] = 0
        anomalies = spark.range(0).agg(F.count("*").alias("anomaly_count"))
        if version is not None:
            found["window_event_count"] = self._write_snapshot(spark, version, newest)
            anomalies = self._sections(spark, version)["anomalies"].agg(F.count("*").alias("anomaly_count"))
        self._write_marker(anomalies, found, version, newest, batch_id)
        self._forget(spark)

    def _write_snapshot(self, spark: SparkSession, version: str, newest: int) -> int:
        """Write the facts of the window that ends at ``newest``; its number of events."""
        end = EPOCH + timedelta(microseconds=newest)
        near = self.store.events_between(spark, end - timedelta(seconds=self.window_seconds), end)
        in_reach = recent_window(near, self.window_seconds, newest=F.timestamp_micros(F.lit(newest)))
        count = Observation()
        facts = minute_facts(first_copies(in_reach)).observe(count, F.sum("requests").alias("events"))
        write_table(facts, f"{self.root}/snapshot/version={version}")
        return count.get["events"]

    def _write_marker(
        self, anomalies: DataFrame, found: dict, version: str | None, newest: int | None, batch_id: int
    ) -> None:
        """The summary of a micro-batch, which also makes its snapshot the latest one."""
        fixed = {name: F.lit(value).cast("bigint") for name, value in found.items()}
        marker = anomalies.select(
            F.lit(SNAPSHOT_SCHEMA_VERSION).cast("int").alias("schema_version"),
            F.lit(SNAPSHOT_LAYER).alias("layer"),
            F.current_timestamp().alias("generated_at"),
            F.lit(version).cast("string").alias("version"),
            F.lit(newest).cast("bigint").alias("newest"),
            *[fixed[name].alias(name) if name in fixed else F.col(name) for name in SUMMARY],
            *[F.lit(getattr(self, name)).cast(kind).alias(name) for name, kind in SETTINGS.items()],
        )
        self.marker_log.write(marker, batch_id)

    def _forget(self, spark: SparkSession) -> None:
        """Remove the snapshots before the last ``kept_versions``; their markers stay."""
        folder = f"{self.root}/snapshot"
        for name in children(spark, folder)[: -self.kept_versions]:
            remove(spark, f"{folder}/{name}")

    def _sections(self, spark: SparkSession, version: str) -> dict[str, DataFrame]:
        """The tables of a snapshot; what is stored are the window's facts."""
        return window_sections(
            spark.read.parquet(f"{self.root}/snapshot/version={version}"),
            self.window_seconds,
            self.error_rate_threshold,
            self.minimum_requests,
        )

    @property
    def marker_log(self) -> BatchLog:
        return BatchLog(f"{self.root}/markers", MARKER_FIELDS)

    def markers(self, spark: SparkSession) -> DataFrame:
        """One row per micro-batch: what it received, its snapshot and its settings."""
        return self.marker_log.read(spark)

    def read_invocations(self, spark: SparkSession) -> DataFrame:
        """The summary of every micro-batch."""
        return self.markers(spark).select("batch_id", *SUMMARY)

    def read_dead_letters(self, spark: SparkSession) -> DataFrame:
        """Records that could not be read, with what is needed to send them again."""
        return self.store.read(spark, INVALID).select("batch_id", "identifier", "record_index", "payload")

    def read_latency(self, spark: SparkSession, runtime_seconds: float | Column) -> DataFrame:
        """Latency and throughput of all that was stored, from the counts kept beside it."""
        return latency_report(self.store.latencies(spark), runtime_seconds)

    def _stored_newest(self, spark: SparkSession, batch_id: int) -> int | None:
        """Time (microseconds) of the newest event of the micro-batches before this one."""
        before = self.marker_log.last(spark, batch_id)
        return None if before is None else before["newest"]

    def latest(self, spark: SparkSession):
        """The marker of the latest snapshot: version, time, settings."""
        found = self.marker_log.last(spark)
        if found is None or found["version"] is None:
            raise ValueError("the stream has not written a snapshot yet")
        return found

    def read_snapshot(self, spark: SparkSession, section: str) -> DataFrame:
        """A section of the latest complete snapshot, with the settings it was made with.

        The settings of this object hold only for a marker that has none.
        """
        latest = self.latest(spark)
        written = {name: latest[name] for name in SETTINGS if latest[name] is not None}
        return replace(self, **written)._sections(spark, latest["version"])[section]

    def read_metadata(self, spark: SparkSession) -> DataFrame:
        """One row about the latest snapshot: schema version, layer, time, settings."""
        latest = self.latest(spark)
        return self.markers(spark).filter(F.col("batch_id") == latest["batch_id"])

    def compact(self, spark: SparkSession, keep_seconds: int | None = None) -> int | None:
        """Bring together the small partitions of all finished micro-batches.

        ``keep_seconds`` gives up events older than that before the newest one. What is
        no longer needed goes with the compaction after the next.
        """
        configure(spark)
        done = self.marker_log.last(spark)
        if done is None:
            return None
        keep_from = None
        if keep_seconds is not None and done["newest"] is not None:
            kept = timedelta(seconds=max(keep_seconds, self.window_seconds))
            keep_from = EPOCH + timedelta(microseconds=done["newest"]) - kept
        version = self.store.compact(spark, done["batch_id"], keep_from=keep_from)
        self.store.vacuum(spark)
        self.marker_log.fold(spark, done["batch_id"])
        return version

    def start(
        self,
        spark: SparkSession,
        source: str | DataFrame,
        checkpoint: str,
        files_per_trigger: int | None = None,
        every: str | None = None,
    ) -> StreamingQuery:
        """Follow the files under ``source``, or any stream with a column ``value``.

        Without ``every`` the job stops when all that is there has been handled.
        """
        configure(spark)
        trigger = {"processingTime": every} if every else {"availableNow": True}
        lines = stream_lines(spark, source, files_per_trigger) if isinstance(source, str) else source
        return (
            lines.select("value")
            .writeStream.foreachBatch(self.process)
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger)
            .start()
        )


def main() -> None:
    parser = argparse.ArgumentParser(description="Recent-traffic stream job")
    parser.add_argument("--input", help="files to follow; without it --compact is all that is done")
    parser.add_argument("--output", required=True)
    parser.add_argument("--checkpoint")
    parser.add_argument("--every", default=None, help="such as '10 seconds'")
    parser.add_argument("--compact", action="store_true", help="bring together what has been written")
    parser.add_argument("--keep-seconds", type=int, default=None, help="give up older events when compacting")
    parser.add_argument("--window-seconds", type=int, default=WINDOW_SECONDS)
    parser.add_argument("--error-rate-threshold", type=float, default=ERROR_RATE_THRESHOLD)
    parser.add_argument("--minimum-requests", type=int, default=MINIMUM_REQUESTS_FOR_ANOMALY)
    arguments = parser.parse_args()
    if not arguments.compact and not (arguments.input and arguments.checkpoint):
        parser.error("--input and --checkpoint are needed to follow a stream")
    job = StreamJob(
        arguments.output,
        arguments.window_seconds,
        arguments.error_rate_threshold,
        arguments.minimum_requests,
    )
    spark = build_session("tidelog-stream")
    if arguments.input:
        job.start(spark, arguments.input, arguments.checkpoint, every=arguments.every).awaitTermination()
    if arguments.compact:
        job.compact(spark, arguments.keep_seconds)


if __name__ == "__main__":
    main()
