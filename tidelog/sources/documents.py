"""JSON documents: event deltas, metric documents and baselines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.columns import strip, with_once
from tidelog.functions.documents import (
    as_list,
    as_map,
    field,
    is_object,
    parse_parts,
    parse_small,
    real_number,
    whole_number,
)
from tidelog.functions.traffic import usable_rate
from tidelog.schema import DELTA_DOCUMENT_TYPE

COUNT_METRICS = ["requests_per_endpoint", "response_byte_totals", "status_code_distribution"]


def read_documents(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """Every matching file below ``path`` as one row: ``doc_key``, ``value``."""
    files = (
        spark.read.option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .text(path, wholetext=True)
    )
    return files.select(F.col("_metadata.file_path").alias("doc_key"), "value")


def parse_delta_documents(documents: DataFrame) -> DataFrame:
    """``doc_key``, ``valid_document``, ``events`` (list of VARIANT, null if invalid).

    A document too large for a VARIANT is read element by element.
    """
    value = F.col("value")
    parsed = with_once(documents, document=parse_small(value))
    split = with_once(
        parsed, parts=parse_parts(value, F.col("document"), "document_type VARIANT, events ARRAY<VARIANT>")
    )
    document, parts = F.col("document"), F.col("parts")
    of_type = lambda kind: F.try_variant_get(kind, "$", "string") == DELTA_DOCUMENT_TYPE
    small = F.when(of_type(field(document, "document_type", "variant")), as_list(document, "$.events"))
    large = F.when(of_type(parts["document_type"]), parts["events"])
    return with_once(split, events=F.coalesce(small, large)).select(
        "doc_key", F.col("events").isNotNull().alias("valid_document"), "events"
    )


def delta_elements(parsed_documents: DataFrame) -> DataFrame:
    """Elements of all event lists in document order: ``doc_key, valid_document,
    position, event``. A document without elements keeps one row with no position, so
    that counts over documents and over events come from the same rows.
    """
    return parsed_documents.select(
        "doc_key", "valid_document", F.posexplode_outer("events").alias("position", "event")
    )


def _first_object(document: Column, names: list[str]) -> Column:
    """The first named member that is an object, else the document itself."""
    members = [field(document, name, "variant") for name in names]
    return F.coalesce(*[F.when(is_object(member), member) for member in members], document)


# Members of a metric document: maps from a key to a number or object, and single values.
MAP_MEMBERS = [*COUNT_METRICS, "error_rates"]
SINGLE_MEMBERS = [
    "total_valid_records",
    "window_event_count",
    "total_response_bytes",
    "window_seconds",
    "window_start",
    "window_end",
    "baseline_rpm",
]
ROOT_MEMBERS = [*SINGLE_MEMBERS, "generated_at", "anomalies"]


def _parts_schema(names: list[str]) -> str:
    """Schema of a large metric document whose metrics may lie in one of the members."""
    maps = [f"{name} MAP<STRING, VARIANT>" for name in MAP_MEMBERS]
    single = [f"{name} VARIANT" for name in SINGLE_MEMBERS]
    inner = ", ".join(f"{text.replace(' ', ': ', 1)}" for text in (*maps, *single))
    nested = [f"{name} STRUCT<{inner}>" for name in names]
    return ", ".join([*nested, *maps, *[f"{name} VARIANT" for name in ROOT_MEMBERS]])


def parse_metric_documents(documents: DataFrame, layer: str) -> DataFrame:
    """Metric documents of one layer (``batch`` or ``speed``), one row each.

    ``root`` is the document, ``metrics`` the object that holds the metrics. Text that
    is not a JSON object gives null in both. Of a document too large for a VARIANT both
    hold the single values, and ``maps`` holds its maps.
    """
    names = {"batch": ["batch_metrics", "metrics", "snapshot"], "speed": ["snapshot"]}[layer]
    value = F.col("value")
    parsed = with_once(documents, parsed=parse_small(value))
    split = with_once(parsed, parts=parse_parts(value, F.col("parsed"), _parts_schema(names)))
    parts = F.col("parts")
    own = F.struct(*[parts[name].alias(name) for name in (*MAP_MEMBERS, *SINGLE_MEMBERS)])
    taken = with_once(
        split,
        root=F.when(is_object(F.col("parsed")), F.col("parsed")),
        part=F.when(parts.isNotNull(), F.coalesce(*[parts[name] for name in names], own)),
    )
    part = F.col("part")
    single = lambda of, members: F.to_variant_object(F.struct(*[of[name].alias(name) for name in members]))
    small_metrics = _first_object(F.col("root"), names)
    return taken.select(
        "doc_key",
        F.when(parts.isNotNull(), single(parts, ROOT_MEMBERS)).otherwise(F.col("root")).alias("root"),
        F.when(parts.isNotNull(), single(part, SINGLE_MEMBERS)).otherwise(small_metrics).alias("metrics"),
        F.when(parts.isNotNull(), F.struct(*[part[name].alias(name) for name in MAP_MEMBERS])).alias("maps"),
    )


def _members(documents: DataFrame, metrics: list[str]) -> DataFrame:
    """Members of the named maps: ``doc_key, metric, key, item``; a document is read once."""
    maps = F.array(
        *[
            F.struct(
                F.lit(metric).alias("metric"),
                F.coalesce(as_map(F.col("metrics"), f"$.{metric}"), F.col("maps")[metric]).alias("members"),
            )
            for metric in metrics
        ]
    )
    listed = documents.select("doc_key", F.inline(maps))
    return listed.select("doc_key", "metric", F.explode("members").alias("key", "item"))


def sanitize_counts(documents: DataFrame, metric: str) -> DataFrame:
    """A count map as rows ``doc_key, key, value``; values that are no integers are left out."""
    counted = _members(documents, [metric]).select(
        "doc_key", "key", F.try_variant_get("item", "$", "bigint").alias("value")
    )
    return counted.filter(F.col("value").isNotNull())


def _rate_of(item: Column) -> Column:
    """A rate stands alone or is the ``error_rate`` of an object."""
    return F.when(is_object(item), real_number(item, "error_rate")).otherwise(real_number(item))


def sanitize_rates(documents: DataFrame, metric: str = "error_rates") -> DataFrame:
    """A rate map as rows; values that are no numbers are left out."""
    rated = _members(documents, [metric]).select(
        "doc_key", "key", _rate_of(F.col("item")).alias("value")
    )
    return rated.filter(F.col("value").isNotNull())


def metric_rows(documents: DataFrame) -> DataFrame:
    """All per-key metrics of the documents in long form: ``doc_key, metric, key`` and
    ``count``, or ``rate`` for error rates."""
    is_rate = F.col("metric") == "error_rates"
    rows = _members(documents, MAP_MEMBERS).select(
        "doc_key",
        "metric",
        "key",
        F.when(~is_rate, F.try_variant_get("item", "$", "bigint")).alias("count"),
        F.when(is_rate, _rate_of(F.col("item"))).alias("rate"),
    )
    return rows.filter(F.coalesce(F.col("count").cast("double"), F.col("rate")).isNotNull())


def document_totals(documents: DataFrame) -> DataFrame:
    """Scalar members: totals, window length and bounds, null where missing."""
    metrics, root = F.col("metrics"), F.col("root")
    return documents.select(
        "doc_key",
        whole_number(metrics, "total_valid_records").alias("total_valid_records"),
        whole_number(metrics, "window_event_count").alias("window_event_count"),
        whole_number(metrics, "total_response_bytes").alias("total_response_bytes"),
        real_number(metrics, "window_seconds").alias("window_seconds"),
        field(metrics, "window_start", "string").alias("window_start"),
        field(metrics, "window_end", "string").alias("window_end"),
        field(root, "generated_at", "string").alias("generated_at"),
        baseline_scalar(baseline_value(metrics, root)).alias("baseline_scalar"),
    )


def baseline_value(metrics: Column, root: Column) -> Column:
    return F.coalesce(
        field(metrics, "baseline_rpm", "variant"), field(root, "baseline_rpm", "variant")
    )


def baseline_scalar(value: Column) -> Column:
    return real_number(value)


def _either(item: Column, *names: str) -> Column:
    """The first of the named members that exists."""
    return F.coalesce(*[field(item, name, "variant") for name in names])


def read_baselines(documents: DataFrame, column: str = "baseline") -> DataFrame:
    """Baseline rates as ``doc_key, endpoint, baseline_rpm``.

    A baseline is a map of numbers, a map of objects, or a list of rows. Rates that are
    negative, infinite or no numbers are left out, endpoints are trimmed, and the last
    entry of an endpoint wins.
    """
    value = F.col(column)
    members = F.transform(
        F.map_entries(as_map(value, "$")),
        lambda entry: F.struct(
            entry["key"].alias("endpoint"), entry["value"].alias("value"), F.lit(False).alias("row")
        ),
    )
    rows = F.transform(
        as_list(value, "$"),
        lambda row: F.struct(
            field(row, "endpoint", "string").alias("endpoint"),
            field(row, "value", "variant").alias("value"),
            F.lit(True).alias("row"),
        ),
    )
    listed = documents.select(
        "doc_key", as_list(value, "$").alias("raw"), F.coalesce(members, rows).alias("entries")
    )
    entries = listed.select(
        "doc_key", "raw", F.posexplode("entries").alias("position", "entry")
    ).select("doc_key", "position", "entry.*", F.get("raw", F.col("position")).alias("source_row"))
    given = F.col("value")
    names = ("avg_requests_per_minute", "baseline_rpm")
    missing = given.isNull() | F.is_variant_null(given)
    candidate = (
        F.when(is_object(given), _either(given, *names))
        .when(missing & F.col("row"), _either(F.col("source_row"), *names))
        .otherwise(given)
    )
    rated = entries.select(
        "doc_key",
        "position",
        strip(F.col("endpoint")).alias("endpoint"),
        usable_rate(real_number(candidate)).alias("rate"),
    ).filter(F.col("rate").isNotNull() & (F.col("endpoint") != ""))
    return rated.groupBy("doc_key", "endpoint").agg(
        F.max_by("rate", "position").alias("baseline_rpm")
    )
