"""Timestamp parsing and printing, always UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelog.schema import LOG_TIME_FORMAT

_ZONE = r"(Z|[+-]\d{2}(:?\d{2}(:?\d{2}([.]\d+)?)?)?)"
_EXTENDED = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}([.,]\d+)?"
_SHORT = r"^(\d{4}-?\d{2}-?\d{2}).(\d{2})(:?(\d{2}))?(:?(\d{2})([.,]\d+)?)?"


def log_time(text: Column) -> Column:
    """The bracketed time of an access-log line; null when it cannot be read."""
    return F.try_to_timestamp(text, F.lit(LOG_TIME_FORMAT))


def _spelled_out(text: Column, zone: str) -> Column:
    """Trimmed ISO 8601 text in the one spelling Spark reads: dashes, colons, seconds, a dot."""
    complete = text.rlike(_EXTENDED + zone + "$")
    date = F.regexp_replace(
        F.regexp_extract(text, _SHORT, 1), r"^(\d{4})-?(\d{2})-?(\d{2})$", "$1-$2-$3"
    )
    part = lambda group: F.coalesce(
        F.nullif(F.regexp_extract(text, _SHORT, group), F.lit("")), F.lit("00")
    )
    fraction = F.regexp_extract(text, _SHORT, 7)
    offset = F.regexp_extract(text, _SHORT + zone + "$", 8)
    rebuilt = F.concat(
        date, F.lit("T"), part(2), F.lit(":"), part(4), F.lit(":"), part(6), fraction, offset
    )
    loose = F.when(text.rlike(_SHORT + zone + "$"), rebuilt)
    return F.translate(F.when(complete, text).otherwise(loose), ",", ".")


def strict_utc(text: Column) -> Column:
    """An event time, trimmed: ISO 8601 with ``Z`` or an offset. Anything else is null."""
    return F.try_to_timestamp(_spelled_out(text, _ZONE))


def lenient_utc(text: Column) -> Column:
    """A document time: as above, but without a zone it is UTC; missing means now."""
    read = F.try_to_timestamp(_spelled_out(text, _ZONE + "?"))
    return F.when(text.isNull(), F.current_timestamp()).otherwise(read)


def iso_text(timestamp: Column) -> Column:
    """``2024-01-01T00:00:00+00:00``, with six decimals only when they are not zero."""
    whole = F.date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(timestamp, ".SSSSSS")
    return F.concat(
        whole, F.when(micros == ".000000", "").otherwise(micros), F.lit("+00:00")
    )
