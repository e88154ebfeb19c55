"""A stream of unique valid events, for consumers that want events and not a window.

Retries are recognised for as long as the watermark keeps an identity: the state holds the
identities of the last ``delay`` of event time and no more. Events without any valid copy
never enter the state, so an invalid first copy does not hide a valid second one. What is
older than the watermark when it arrives is dropped; the window job, which has no
watermark, is the one that counts late events.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelog.operators.events import decode_records
from tidelog.schema import DELTA_EVENT_FIELDS
from tidelog.session import build_session, configure
from tidelog.sources.envelopes import explode_records
from tidelog.sources.logs import stream_lines

DELAY = "1 hour"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def unique_events_stream(lines: DataFrame, delay: str = DELAY) -> DataFrame:
    """The first valid copy of every event of a stream of envelope lines (``value``)."""
    text = lines.select(F.col("value").cast("string").alias("value"))
    valid = decode_records(explode_records(text)).filter("valid")
    return (
        valid.select(*DELTA_EVENT_FIELDS, "identity")
        .withWatermark("timestamp", delay)
        .dropDuplicatesWithinWatermark(["identity"])
    )


def start_unique(
    spark: SparkSession,
    source: str | DataFrame,
    output: str,
    checkpoint: str,
    delay: str = DELAY,
    files_per_trigger: int | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Write unique events to a table by day. The state is kept outside the Java heap.

    A restart goes on from the checkpoint and writes no event again.
    """
    configure(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    lines = stream_lines(spark, source, files_per_trigger) if isinstance(source, str) else source
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        unique_events_stream(lines, delay)
        .withColumn("event_date", F.date_format("timestamp", "yyyy-MM-dd"))
        .writeStream.format("parquet")
        .partitionBy("event_date")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def main() -> None:
    parser = argparse.ArgumentParser(description="Stream of unique events")
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--delay", default=DELAY, help="how long after an event its retries may come")
    parser.add_argument("--every", default=None, help="such as '10 seconds'")
    arguments = parser.parse_args()
    start_unique(
        build_session("tidelog-unique"),
        arguments.input,
        arguments.output,
        arguments.checkpoint,
        arguments.delay,
        every=arguments.every,
    ).awaitTermination()


if __name__ == "__main__":
    main()
