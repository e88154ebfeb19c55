"""The global window kept up to date: every run reads new delta documents only.

What a run leaves of its documents is one row per identity, its first valid event, and the
invalid events before that, which a later answer may still need. Rows are stored by run,
day and hour. When a new run holds identities that are stored already, the rows that lose,
new ones as a rule, old ones if an earlier document comes late, are noted as beaten. So the
unique events at any time are the valid rows that are not beaten, and a window reads the
hours it touches.

Which documents have been handled is the checkpoint of a stream of files; a run that is
repeated replaces what it wrote.
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelog.operators.aggregates import minute_facts
from tidelog.operators.dedup import DUPLICATE, dedup_events, delta_events, identity_digest
from tidelog.operators.window import recent_window
from tidelog.plans.global_window import window_sections
from tidelog.plans.sinks import write_table
from tidelog.schema import (
    ERROR_RATE_THRESHOLD,
    MINIMUM_REQUESTS_FOR_ANOMALY,
    WINDOW_SECONDS,
    check_anomaly_thresholds,
    check_window,
)
from tidelog.session import build_session, children, configure, remove, stage
from tidelog.sources.event_table import hours_from
from tidelog.streaming.batch_log import BatchLog

NO_TIME = "none"
FIELDS = ["identity", "doc_key", "position", "valid", "timestamp", "endpoint", "status_code", "response_bytes"]
STATE_SCHEMA = (
    "identity STRING, doc_key STRING, position INT, valid BOOLEAN, timestamp TIMESTAMP, "
    "endpoint STRING, status_code BIGINT, response_bytes BIGINT, run BIGINT, "
    "event_date STRING, event_hour STRING"
)
BEATEN_SCHEMA = (
    "identity STRING, doc_key STRING, position INT, valid BOOLEAN, beaten_in BIGINT, "
    "event_date STRING, event_hour STRING"
)
PLACE = ["identity", "doc_key", "position"]
COUNTS = ["scanned_objects", "valid_documents", "invalid_documents", "raw_events", "without_identity"]
RUN_FIELDS = ", ".join(
    [*[f"{name} BIGINT" for name in (*COUNTS, "stored_valid", "beaten_valid", "stored_invalid", "beaten_invalid")], "version STRING"]
)
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def document_counts(decoded: DataFrame) -> DataFrame:
    """One row of counts over the documents and elements of a run."""
    documents = decoded.groupBy("doc_key").agg(
        F.bool_and("valid_document").alias("valid_document"),
        F.count("position").alias("raw"),
        F.count_if(F.col("position").isNotNull() & F.col("identity").isNull()).alias("nameless"),
    )
    return documents.agg(
        F.count("*").alias("scanned_objects"),
        F.count_if("valid_document").alias("valid_documents"),
        F.count_if(~F.col("valid_document")).alias("invalid_documents"),
        F.coalesce(F.sum("raw"), F.lit(0)).alias("raw_events"),
        F.coalesce(F.sum("nameless"), F.lit(0)).alias("without_identity"),
    )


def needed_rows(classified: DataFrame) -> DataFrame:
    """The rows that a later answer can depend on: all but duplicates and nameless ones."""
    kept = F.col("identity").isNotNull() & (F.col("event_class") != DUPLICATE)
    hour = lambda form: F.coalesce(F.date_format("timestamp", form), F.lit(NO_TIME))
    return classified.filter(kept).select(
        *[F.when(F.col("valid"), F.col(n)).alias(n) if n in FIELDS[4:] else n for n in FIELDS],
        F.when(F.col("valid"), hour("yyyy-MM-dd")).otherwise(F.lit(NO_TIME)).alias("event_date"),
        F.when(F.col("valid"), hour("HH")).otherwise(F.lit(NO_TIME)).alias("event_hour"),
    )


@dataclass(frozen=True)
class IncrementalWindow:
    """Where the state lies and how the window is judged."""

    root: str
    window_seconds: int = WINDOW_SECONDS
    error_rate_threshold: float = ERROR_RATE_THRESHOLD
    minimum_requests: int = MINIMUM_REQUESTS_FOR_ANOMALY
    kept_versions: int = 20

    def __post_init__(self) -> None:
        check_window(self.window_seconds)
        check_anomaly_thresholds(self.error_rate_threshold, self.minimum_requests)

    @property
    def runs(self) -> BatchLog:
        return BatchLog(f"{self.root}/runs", RUN_FIELDS)

    def state(self, spark: SparkSession) -> DataFrame:
        """The stored rows of all runs that are not beaten."""
        rows = spark.read.schema(STATE_SCHEMA).parquet(f"{self.root}/state")
        return rows.join(self._beaten(spark), PLACE, "left_anti")

    def _beaten(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        if not children(spark, f"{self.root}/beaten"):
            return spark.createDataFrame([], BEATEN_SCHEMA)
        rows = spark.read.schema(BEATEN_SCHEMA).parquet(f"{self.root}/beaten")
        return rows if before is None else rows.filter(F.col("beaten_in") < before)

    def process(self, documents: DataFrame, run: int) -> None:
        """Handle new documents (``doc_key, value``) and write the window they lead to."""
        spark = documents.sparkSession
        decoded = stage(delta_events(documents), "decoded")
        self._replace(needed_rows(dedup_events(decoded)), "state", "run", run)
        self._replace(self._losers(spark, run), "beaten", "beaten_in", run)
        counts = document_counts(decoded).crossJoin(self._stored(spark, run))  # one row by one row
        version = self._write_snapshot(spark, run)
        self.runs.write(counts.withColumn("version", F.lit(version)), run)
        for name in children(spark, f"{self.root}/snapshot")[: -self.kept_versions]:
            remove(spark, f"{self.root}/snapshot/{name}")

    def _replace(self, rows: DataFrame, table: str, part: str, run: int) -> None:
        """Write the rows of a run, by hour, in place of an earlier attempt."""
        rows = rows.drop("run", part).hint("rebalance", "event_date", "event_hour")
        parts = rows.write.mode("overwrite").partitionBy("event_date", "event_hour")
        parts.parquet(f"{self.root}/{table}/{part}={run}")

    def _losers(self, spark: SparkSession, run: int) -> DataFrame:
        """Rows, new and old, of identities in the new run that come after a valid one.

        The old rows are searched by the digest of the new identities, from three narrow
        columns; only rows that match are compared.
        """
        stored = spark.read.schema(STATE_SCHEMA).parquet(f"{self.root}/state").filter(F.col("run") <= run)
        keyed = stored.withColumn("digest", identity_digest(F.col("identity")))
        new = keyed.filter(F.col("run") == run)
        old = keyed.filter(F.col("run") < run).join(new.select("digest").distinct(), "digest", "left_semi")
        old = stage(old.join(self._beaten(spark, run), PLACE, "left_anti"), "old-copies")
        again = new.join(old.select("digest").distinct(), "digest", "left_semi")
        both = stage(old.unionByName(again).drop("digest"), "copies")
        lost = dedup_events(both).filter(F.col("event_class") == DUPLICATE)
        return lost.select(*PLACE, "valid", "event_date", "event_hour")

    def _stored(self, spark: SparkSession, run: int) -> DataFrame:
        """How many valid and invalid rows the run stored, and how many it beat."""
        rows = spark.read.schema(STATE_SCHEMA).parquet(f"{self.root}/state").filter(F.col("run") == run)
        beaten = self._beaten(spark).filter(F.col("beaten_in") == run)
        count = lambda name: (F.count_if("valid").alias(f"{name}_valid"), F.count_if(~F.col("valid")).alias(f"{name}_invalid"))
        return rows.agg(*count("stored")).crossJoin(beaten.agg(*count("beaten")))  # one row by one row

    def _newest(self, spark: SparkSession) -> datetime | None:
        """Time of the newest unique event: the newest hours are looked at first.

        Hours are plain partitions. All but always the first one holds an event that is
        not beaten.
        """
        rows = self.state(spark).filter(F.col("valid"))
        stored = spark.read.schema(STATE_SCHEMA).parquet(f"{self.root}/state").filter(F.col("event_date") != NO_TIME)
        last: Column = F.lit(True)
        while True:
            at = stored.filter(last).agg(F.max(F.struct("event_date", "event_hour"))).first()[0]
            if at is None:
                return None
            day, hour = at
            inside = (F.col("event_date") == day) & (F.col("event_hour") == hour)
            newest = rows.filter(inside).agg(F.max(F.unix_micros("timestamp"))).first()[0]
            if newest is not None:
                return EPOCH + timedelta(microseconds=newest)
            last = (F.col("event_date") < day) | ((F.col("event_date") == day) & (F.col("event_hour") < hour))

    def window(self, spark: SparkSession) -> DataFrame:
        """The unique events of the window, from the hours it touches."""
        newest = self._newest(spark)
        if newest is None:
            return spark.createDataFrame([], STATE_SCHEMA)
        start = newest - timedelta(seconds=self.window_seconds)
        rows = spark.read.schema(STATE_SCHEMA).parquet(f"{self.root}/state")
        near = rows.filter(F.col("valid") & hours_from(start) & (F.col("event_date") != NO_TIME))
        beaten = self._beaten(spark).filter(hours_from(start) & (F.col("event_date") != NO_TIME))
        unique = near.join(beaten, PLACE, "left_anti")
        return recent_window(unique, self.window_seconds, newest=F.lit(newest))

    def _write_snapshot(self, spark: SparkSession, run: int) -> str:
        version = f"{run:012d}-{uuid4().hex}"
        write_table(minute_facts(self.window(spark)), f"{self.root}/snapshot/version={version}")
        return version

    def read_snapshot(self, spark: SparkSession, section: str) -> DataFrame:
        """A section of the latest window."""
        latest = self.runs.last(spark)
        if latest is None:
            raise ValueError("no documents have been handled yet")
        facts = spark.read.parquet(f"{self.root}/snapshot/version={latest['version']}")
        return window_sections(facts, self.window_seconds, self.error_rate_threshold, self.minimum_requests)[section]

    def statistics(self, spark: SparkSession) -> DataFrame:
        """Counts over all documents so far, as a job over all of them would give."""
        total = lambda name: F.coalesce(F.sum(name), F.lit(0))
        unique = total("stored_valid") - total("beaten_valid")
        invalid = total("without_identity") + total("stored_invalid") - total("beaten_invalid")
        return self.runs.read(spark).agg(
            *[total(name).alias(name) for name in COUNTS[:4]],
            unique.alias("unique_events"),
            (total("raw_events") - unique - invalid).alias("duplicate_events"),
            invalid.alias("invalid_events"),
        )

    def start(
        self,
        spark: SparkSession,
        source: str,
        checkpoint: str,
        pattern: str = "*.json",
        files_per_run: int | None = None,
        every: str | None = None,
    ) -> StreamingQuery:
        """Follow the documents below ``source``; without ``every`` stop when all are done."""
        configure(spark)
        reader = spark.readStream.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
        if files_per_run:
            reader = reader.option("maxFilesPerTrigger", files_per_run)
        files = reader.text(source, wholetext=True)
        trigger = {"processingTime": every} if every else {"availableNow": True}
        return (
            files.select(F.col("_metadata.file_path").alias("doc_key"), "value")
            .writeStream.foreachBatch(self.process)
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger)
            .start()
        )


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--every", default=None, help="such as '10 minutes'")
    parser.add_argument("--window-seconds", type=int, default=WINDOW_SECONDS)
    parser.add_argument("--error-rate-threshold", type=float, default=ERROR_RATE_THRESHOLD)
    parser.add_argument("--minimum-requests", type=int, default=MINIMUM_REQUESTS_FOR_ANOMALY)
    arguments = parser.parse_args()
    job = IncrementalWindow(
        arguments.output, arguments.window_seconds, arguments.error_rate_threshold, arguments.minimum_requests
    )
    spark = build_session("tidelog-incremental-window")
    job.start(spark, arguments.input, arguments.checkpoint, every=arguments.every).awaitTermination()


if __name__ == "__main__":
    main()
