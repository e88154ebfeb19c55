"""Removing retried events over all delta documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.operators.events import validate_events, with_identity
from tidelog.operators.skew import spread_join
from tidelog.session import stage
from tidelog.sources.documents import delta_elements, parse_delta_documents
from tidelog.functions.documents import is_object

UNIQUE, DUPLICATE, INVALID = "unique", "duplicate", "invalid"


def delta_events(documents: DataFrame) -> DataFrame:
    """Every element of every document with its fields, ``valid`` and ``identity``.

    An element that is not an object has no identity and is not valid. A document
    without elements, such as an unreadable one, keeps one row with no position.
    """
    elements = delta_elements(parse_delta_documents(documents))
    objects = elements.withColumn("event", F.when(is_object(F.col("event")), F.col("event")))
    return with_identity(validate_events(objects)).drop("event")


def identity_digest(identity: Column) -> Column:
    """A number that equal identities share; different ones may share it too."""
    return F.xxhash64(identity)


def repeated_identities(events: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """``identity``, the place of its first valid event and its number of copies, for the
    identities that may occur twice.

    Most identities occur once. A count of their digests, which are plain numbers, finds
    the few that do not, and only their events are looked at by place. A digest that two
    identities share keeps a few single ones in, which does no harm.
    """
    at = F.struct("doc_key", "position")
    named = events.filter(F.col("identity").isNotNull())
    keyed = named.withColumn("digest", digest(F.col("identity")))
    repeated = keyed.groupBy("digest").agg(F.count("*").alias("seen")).filter("seen > 1")
    places = keyed.select("digest", "identity", "valid", at.alias("at"))
    return (
        places.join(repeated.select("digest"), "digest", "left_semi")
        .groupBy("identity")
        .agg(
            F.min(F.when(F.col("valid"), F.col("at"))).alias("first_valid"),
            F.count("*").alias("copies"),
            F.lit(True).alias("repeats"),
        )
    )


def dedup_events(
    events: DataFrame, digest: Callable[[Column], Column] = identity_digest
) -> DataFrame:
    """Add ``event_class``: unique, duplicate or invalid.

    In document order, the first valid event of an identity is unique and everything
    after it is a duplicate, valid or not. What comes before it is invalid. So one
    position per identity decides, and no identity's events have to come together: the
    position is a combined aggregate over the identities that repeat, and the join back
    spreads them. An identity that occurs once needs no position.
    """
    at = F.struct("doc_key", "position")
    firsts = stage(repeated_identities(events, digest), "repeated-identities")
    placed = spread_join(events, firsts, ["identity"], salt_on=["doc_key", "position"])
    first = F.col("first_valid")
    single = F.col("identity").isNull() | F.col("repeats").isNull()
    event_class = (
        F.when(F.col("position").isNull(), None)
        .when(single, F.when(F.col("valid"), UNIQUE).otherwise(INVALID))
        .when(first.isNull() | (at < first), INVALID)
        .when(at > first, DUPLICATE)
        .otherwise(UNIQUE)
    )
    return placed.withColumn("event_class", event_class).drop("first_valid", "repeats")


def unique_events(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("event_class") == UNIQUE)


def aggregation_statistics(classified: DataFrame) -> DataFrame:
    """One row of counts over documents and events."""
    each = classified.groupBy("doc_key").agg(
        F.bool_and("valid_document").alias("valid_document"),
        F.count("position").alias("raw"),
        *[
            F.count_if(F.col("event_class") == kind).alias(kind)
            for kind in (UNIQUE, DUPLICATE, INVALID)
        ],
    )
    total = lambda name: F.coalesce(F.sum(name), F.lit(0)).alias(f"{name}_events")
    return each.agg(
        F.count("*").alias("scanned_objects"),
        F.count_if("valid_document").alias("valid_documents"),
        F.count_if(~F.col("valid_document")).alias("invalid_documents"),
        *map(total, ("raw", UNIQUE, DUPLICATE, INVALID)),
    )
