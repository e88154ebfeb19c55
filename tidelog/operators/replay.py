"""Replaying an access log as a stream of transport records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.operators.events import encode_events, enrich_events
from tidelog.operators.parse import is_valid, parse_lines, replay_events
from tidelog.functions.columns import strip
from tidelog.schema import SEND_BATCH_SIZE, check_batch_size
from tidelog.session import stage

# monotonically_increasing_id puts the partition above these bits and the row below.
ROW_BITS = 33
ROW_MASK = (1 << ROW_BITS) - 1


def _as_uuid(digest: Column) -> Column:
    return F.regexp_replace(digest, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def line_copies(rows: DataFrame) -> DataFrame:
    """(row, copy) of every row that has an equal one before it: its number among them.

    Equal rows have the same ``line``. They are numbered inside their input split first;
    then the splits of a line are put one after the other by their counts. So the rows of
    one line meet in pieces no larger than a split, however many there are.
    """
    slim = rows.select("line", "row", F.shiftright("row", ROW_BITS).alias("split"))
    before = Window.partitionBy("line").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    counts = slim.groupBy("line", "split").agg(F.count("*").alias("own"))
    earlier = counts.withColumn("earlier", F.sum("own").over(before)).filter("earlier > 0")
    inside = F.row_number().over(Window.partitionBy("line", "split").orderBy("row")) - 1
    placed = slim.withColumn("inside", inside).join(
        earlier.select("line", "split", "earlier"), ["line", "split"], "left"
    )
    copy = F.col("inside") + F.coalesce("earlier", F.lit(0))
    return placed.select("row", copy.cast("bigint").alias("copy")).filter("copy > 0")


def replay_records(
    lines: DataFrame, run_id: str, batch_size: int = SEND_BATCH_SIZE
) -> DataFrame:
    """Valid lines as enriched records in delivery batches of their input split.

    An id follows from the run, the file (column ``file``, if there is one), the line and
    its number among the equal lines of that file, and from nothing else: a log that is
    read again in other splits or on other cores gives the same ids, and equal lines get
    different ones. Which of two equal lines has which id makes no difference. The events
    are written once, so that the splits stay as they are while lines are counted; only
    rows that repeat a line are joined back, by their own number.
    """
    check_batch_size(batch_size)
    file = F.col("file") if "file" in lines.columns else F.lit("")
    keyed = lines.select("value", F.md5(F.concat_ws("\n", file, "value")).alias("line"))
    valid = replay_events(keyed, keep=["line"])
    rows = stage(valid.withColumn("row", F.monotonically_increasing_id()), "replay")
    numbered = rows.join(line_copies(rows), "row", "left")
    sequence = F.concat_ws("-", F.lit(run_id), "line", F.coalesce("copy", F.lit(0)).cast("string"))
    kept = ["row", "sequence_number"]
    enriched = enrich_events(
        numbered.withColumn("sequence_number", sequence), _as_uuid(F.md5(sequence)), keep=kept
    )
    return encode_events(enriched, keep=kept).select(
        F.shiftright("row", ROW_BITS).alias("split"),
        F.floor(F.col("row").bitwiseAND(F.lit(ROW_MASK)) / batch_size).alias("batch"),
        "sequence_number",
        "partition_key",
        "payload",
    )


def as_envelopes(records: DataFrame) -> DataFrame:
    """Records in the form a consumer receives them, one JSON object per row."""
    data = F.base64(F.encode("payload", "UTF-8"))
    return records.select(
        F.concat(F.lit("replay:"), "sequence_number").alias("eventID"),
        F.struct(
            F.regexp_replace(data, r"\s", "").alias("data"),
            F.col("partition_key").alias("partitionKey"),
            F.col("sequence_number").alias("sequenceNumber"),
        ).alias("kinesis"),
        "split",
        "batch",
    )


def replay_statistics(
    lines: DataFrame, delivered: DataFrame, batch_size: int = SEND_BATCH_SIZE
) -> DataFrame:
    """One row of counts: what the log holds, what of it is in the written table.

    A valid line without a record of its own has failed. ``largest_batch`` is counted in
    the table, not derived from the size that was asked for.
    """
    check_batch_size(batch_size)
    trimmed = lines.withColumn("value", strip(F.col("value")))
    counted = parse_lines(trimmed).agg(
        F.count("*").alias("total_lines"), F.count_if(is_valid()).alias("valid_records")
    )
    batches = delivered.groupBy("split", "batch").agg(F.count("*").alias("records"))
    sent = batches.agg(
        F.coalesce(F.sum("records"), F.lit(0)).alias("successful_records"),
        F.count("*").alias("batches_sent"),
        F.coalesce(F.max("records"), F.lit(0)).alias("largest_batch"),
    )
    return counted.crossJoin(sent).select(  # one row by one row
        "total_lines",
        "valid_records",
        (F.col("total_lines") - F.col("valid_records")).alias("invalid_lines"),
        "successful_records",
        (F.col("valid_records") - F.col("successful_records")).alias("failed_records"),
        "batches_sent",
        (F.col("largest_batch") <= F.lit(batch_size)).alias("batches_fit"),
    )
