"""Keys and identities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelog.functions.columns import blank_to_null


def partition_key(client_ip: Column) -> Column:
    return F.coalesce(blank_to_null(client_ip), F.lit("unknown"))


def sanitize_key(text: Column) -> Column:
    """Only letters, digits, dot, underscore and dash; a random name when none is left."""
    cleaned = F.btrim(F.regexp_replace(text, r"[^A-Za-z0-9._-]+", "-"), F.lit("-"))
    return F.coalesce(blank_to_null(cleaned), F.replace(F.uuid(), F.lit("-"), F.lit("")))


def event_identity(event_id: Column, sequence_number: Column, other: Column) -> Column:
    """Identity of an event over its retries.

    The producer's id, else the transport's sequence number, else a digest of the
    remaining fields (``other``, a struct). Both ids are trimmed; '' means missing.
    """
    digest = F.sha2(F.to_json(other, {"ignoreNullFields": "false"}), 256)
    return F.coalesce(
        F.concat(F.lit("event_id:"), blank_to_null(event_id)),
        F.concat(F.lit("sequence_number:"), blank_to_null(sequence_number)),
        F.concat(F.lit("fallback:"), digest),
    )


def delta_key(prefix: str, generated_at: Column, request_id: Column) -> Column:
    """Object name of a delta document, grouped by UTC hour."""
    folder = prefix.strip("/")
    return F.concat(
        F.lit(f"{folder}/"),
        F.date_format(generated_at, "yyyy/MM/dd/HH/"),
        F.date_format(generated_at, "yyyyMMdd'T'HHmmssSSSSSS'Z-'"),
        sanitize_key(request_id),
        F.lit(".json"),
    )
