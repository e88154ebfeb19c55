"""Stream events: enrichment, decoding, validation and partial failures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.columns import strip, with_once
from tidelog.functions.documents import field, is_object, parse_document, present_text, whole_number
from tidelog.functions.instants import iso_text, strict_utc
from tidelog.functions.keys import event_identity, partition_key
from tidelog.schema import EVENT_COLUMNS, EVENT_SOURCE


def enrich_events(
    events: DataFrame, event_id: Column | None = None, keep: list[str] | None = None
) -> DataFrame:
    """Add id, ingest time and source; the nine base fields stay as they are."""
    return events.select(
        *(keep or []),
        *EVENT_COLUMNS,
        (F.uuid() if event_id is None else event_id).alias("event_id"),
        F.current_timestamp().alias("ingested_at"),
        F.lit(EVENT_SOURCE).alias("source"),
    )


def encode_events(enriched: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Compact JSON ``payload`` and its ``partition_key``, the two parts of a record."""
    keep = keep or []
    printed = enriched.withColumns(
        {
            "timestamp": iso_text(F.col("timestamp")),
            "ingested_at": iso_text(F.col("ingested_at")),
        }
    )
    fields = [name for name in printed.columns if name not in keep]
    body = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return printed.select(
        *keep, partition_key(F.col("client_ip")).alias("partition_key"), body.alias("payload")
    )


def strict_base64(text: Column) -> Column:
    """Decoded bytes; null unless the whole text is padded base64 without other characters."""
    well_formed = text.rlike(r"^[A-Za-z0-9+/]*={0,2}$") & (F.length(text) % 4 == 0)
    return F.when(well_formed, F.try_to_binary(text, F.lit("base64")))


def decode_envelopes(records: DataFrame) -> DataFrame:
    """``identifier`` of every record and its ``payload`` text, null when unreadable.

    The data must be a JSON string: a number that happens to be base64 is refused.
    """
    return _decode_envelopes(records).drop("transport_id")


def _decode_envelopes(records: DataFrame) -> DataFrame:
    record = F.col("record")
    data = field(record, "kinesis.data", "variant")
    text = F.when(
        F.schema_of_variant(data) == "STRING", field(record, "kinesis.data", "string")
    )
    decoded = with_once(records, payload_bytes=strict_base64(text))
    return decoded.select(
        *[name for name in records.columns if name != "record"],
        transport_id(record).alias("transport_id"),
        record_identifier(record, F.col("record_index")).alias("identifier"),
        F.try_validate_utf8(F.col("payload_bytes").cast("string")).alias("payload"),
    )


def transport_id(record: Column) -> Column:
    """Sequence number, else event id; null when the transport gave neither."""
    sequence = F.nullif(present_text(record, "kinesis.sequenceNumber"), F.lit(""))
    return F.coalesce(sequence, F.nullif(present_text(record, "eventID"), F.lit("")))


def record_identifier(record: Column, index: Column) -> Column:
    """The transport's id, else the position in the batch.

    A position names a record to the sender of its batch. It is the same in every batch,
    so it is no identity of an event.
    """
    return F.coalesce(transport_id(record), F.concat(F.lit("record-"), index.cast("string")))


def decode_payloads(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """Add ``event``, the JSON object in the payload, null when it is anything else."""
    parsed = with_once(payloads, parsed_payload=parse_document(F.col(column)))
    event = F.col("parsed_payload")
    return parsed.withColumn("event", F.when(is_object(event), event)).drop("parsed_payload")


def validate_events(events: DataFrame, column: str = "event") -> DataFrame:
    """Replace the VARIANT event by typed fields and ``valid``.

    The fields have the checked, normalised values; ``event_id`` and
    ``sequence_number`` are trimmed text, '' when missing.
    """
    event = F.col(column)
    read = with_once(
        events,
        event_id=present_text(event, "event_id"),
        sequence_number=present_text(event, "sequence_number"),
        time_text=strip(field(event, "timestamp", "string")),
        client_ip=field(event, "client_ip", "string"),
        method=field(event, "method", "string"),
        endpoint=present_text(event, "endpoint"),
        status_code=whole_number(event, "status_code"),
        response_bytes=whole_number(event, "response_bytes"),
        source=field(event, "source", "string"),
        ingest_text=strip(field(event, "ingested_at", "string")),
    )
    typed = with_once(
        read,
        timestamp=strict_utc(F.col("time_text")),
        ingested_at=strict_utc(F.col("ingest_text")),
    ).drop("time_text", "ingest_text")
    valid = (
        event.isNotNull()
        & F.col("timestamp").isNotNull()
        & (F.col("endpoint") != "")
        & F.col("status_code").isNotNull()
        & F.coalesce(F.col("response_bytes") >= 0, F.lit(False))
    )
    return typed.withColumn("valid", valid)


def with_identity(events: DataFrame, column: str = "event") -> DataFrame:
    """Add ``identity`` to validated events that still carry their VARIANT."""
    event = F.col(column)
    others = F.struct(
        *[
            field(event, name, "variant").alias(name)
            for name in (
                "client_ip",
                "endpoint",
                "method",
                "response_bytes",
                "source",
                "status_code",
                "timestamp",
            )
        ]
    )
    identity = event_identity(F.col("event_id"), F.col("sequence_number"), others)
    return events.withColumn("identity", F.when(event.isNotNull(), identity))


def decode_records(records: DataFrame) -> DataFrame:
    """Transport records to validated events with their ``identity``.

    The transport's id becomes the sequence number. Events without any id are told apart
    by their fields.
    """
    validated = validate_events(decode_payloads(_decode_envelopes(records)))
    numbered = validated.withColumn("sequence_number", F.coalesce("transport_id", F.lit("")))
    return with_identity(numbered).drop("transport_id")


def batch_item_failures(decoded: DataFrame) -> DataFrame:
    """Identifiers of the records that could not be processed."""
    return decoded.filter(~F.col("valid")).select(
        *[name for name in decoded.columns if name in ("batch", "record_index")],
        F.col("identifier").alias("item_identifier"),
    )


def invocation_summary(
    decoded: DataFrame, window_event_count: Column, anomaly_count: Column
) -> DataFrame:
    """One row: records received, processed and invalid, and the state of the window."""
    return decoded.agg(
        F.count("*").alias("received_records"),
        F.count_if("valid").alias("processed_records"),
        F.count_if(~F.col("valid")).alias("invalid_records"),
    ).withColumns({"window_event_count": window_event_count, "anomaly_count": anomaly_count})


def validation_profile(events: DataFrame) -> DataFrame:
    """What decoded events look like: ``item, value, events``.

    One row says how many there are, one whether all have an id; then comes a row per
    source and a row per endpoint.
    """
    has_id = F.coalesce(F.col("event_id") != "", F.lit(False))
    grouped = events.groupingSets([["source"], ["endpoint"], []], "source", "endpoint").agg(
        F.grouping_id().alias("level"),
        F.count("*").alias("n"),
        F.count_if(~has_id).alias("without_id"),
    )
    entry = lambda item, value, count: F.struct(
        F.lit(item).alias("item"), value.cast("string").alias("value"), count.alias("events")
    )
    n, without = F.col("n"), F.col("without_id")
    totals = F.array(
        entry("decoded_events", n, n), entry("event_ids_present", without == 0, n - without)
    )
    # A set bit of the level marks a column that is grouped away.
    entries = (
        F.when(F.col("level") == 0b01, F.array(entry("source", F.col("source"), n)))
        .when(F.col("level") == 0b10, F.array(entry("endpoint", F.col("endpoint"), n)))
        .otherwise(totals)
    )
    return grouped.select(F.inline(entries)).filter(F.col("value") != "")
