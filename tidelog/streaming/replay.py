"""Replaying access-log files as transport records, file by file as they arrive."""

from __future__ import annotations

import argparse
import hashlib
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelog.operators.replay import as_envelopes, replay_records
from tidelog.schema import SEND_BATCH_SIZE, check_batch_size
from tidelog.session import build_session, configure
from tidelog.sources.logs import stream_lines


def write_event_stream(
    lines: DataFrame, path: str, run_id: str, batch_size: int = SEND_BATCH_SIZE
) -> None:
    """Write the records of a set of lines. Writing the same run again replaces it."""
    records = as_envelopes(replay_records(lines, run_id, batch_size))
    records.write.mode("overwrite").json(path)


def read_event_stream(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(
        "eventID STRING, kinesis STRUCT<data STRING, partitionKey STRING, "
        "sequenceNumber STRING>, split BIGINT, batch BIGINT"
    ).json(path)


def start_replay(
    spark: SparkSession,
    source: str,
    output: str,
    checkpoint: str,
    name: str | None = None,
    batch_size: int = SEND_BATCH_SIZE,
    every: str | None = None,
) -> StreamingQuery:
    """Every micro-batch replaces its own folder, so a retried one leaves no copies.

    ``name`` goes into the ids of all events, so replays that are read together need
    different names. By default it follows from the folders of the replay: another log or
    another output gets another name, a restart from its checkpoint the same. The rest of
    an id follows from the file and its lines; a file is never split over micro-batches,
    so neither their number nor their size matters.
    """
    check_batch_size(batch_size)
    configure(spark)
    folders = "\n".join(os.path.abspath(path) if "://" not in path else path for path in (source, output, checkpoint))
    name = name or f"replay-{hashlib.md5(folders.encode()).hexdigest()}"

    def send(lines: DataFrame, batch_id: int) -> None:
        write_event_stream(lines, f"{output}/batch_id={batch_id}", name, batch_size)

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        stream_lines(spark, source)
        .select(F.make_valid_utf8("value").alias("value"), F.col("_metadata.file_path").alias("file"))
        .writeStream.foreachBatch(send)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--every", default=None, help="such as '10 seconds'")
    parser.add_argument("--name", default=None, help="part of all ids; follows from the folders if not given")
    parser.add_argument("--batch-size", type=int, default=SEND_BATCH_SIZE)
    arguments = parser.parse_args()
    start_replay(
        build_session("tidelog-replay"),
        arguments.input,
        arguments.output,
        arguments.checkpoint,
        arguments.name,
        batch_size=arguments.batch_size,
        every=arguments.every,
    ).awaitTermination()


if __name__ == "__main__":
    main()
