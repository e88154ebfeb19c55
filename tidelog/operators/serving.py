"""Historical and recent traffic side by side.

``history`` and ``recent`` are per-endpoint tables with ``endpoint, requests,
response_bytes, error_rate``; history also has ``baseline_rpm``. Any value may be null.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.columns import rate
from tidelog.functions.instants import iso_text
from tidelog.functions.traffic import endpoint_traffic, recent_rpm, traffic_level, usable_rate
from tidelog.operators.ranking import with_rank
from tidelog.schema import (
    MINIMUM_REQUESTS_FOR_SPIKE,
    TRAFFIC_SPIKE_RATIO,
    VIEW_NOTE,
    VIEW_SCHEMA_VERSION,
    VIEW_TYPE,
    check_spike_thresholds,
)
from tidelog.session import stage

SPIKE_COLUMNS = [
    "endpoint",
    "recent_requests",
    "historical_baseline_rpm",
    "recent_rpm",
    "rpm_difference",
    "recent_to_baseline_ratio",
    "traffic_status",
]


def endpoint_metrics(summary: DataFrame) -> DataFrame:
    """The columns used here from an ``endpoint_summary``."""
    return summary.select(
        "endpoint",
        F.col("total_requests").alias("requests"),
        F.col("total_response_bytes").alias("response_bytes"),
        "error_rate",
        F.col("avg_requests_per_minute").alias("baseline_rpm"),
    )


def document_metrics(rows: DataFrame, baselines: DataFrame) -> DataFrame:
    """The same from metric documents: their long rows and baselines, one grouping."""
    base = baselines.select(
        "doc_key",
        F.lit("baseline_rpm").alias("metric"),
        F.col("endpoint").alias("key"),
        F.lit(None).cast("bigint").alias("count"),
        F.col("baseline_rpm").alias("rate"),
    )
    of = lambda metric, value: F.max(F.when(F.col("metric") == metric, F.col(value)))
    return (
        rows.filter(F.col("metric") != "status_code_distribution")
        .unionByName(base)
        .groupBy("doc_key", F.col("key").alias("endpoint"))
        .agg(
            of("requests_per_endpoint", "count").alias("requests"),
            of("response_byte_totals", "count").alias("response_bytes"),
            of("error_rates", "rate").alias("error_rate"),
            of("baseline_rpm", "rate").alias("baseline_rpm"),
        )
    )


def endpoint_universe(*tables: DataFrame) -> DataFrame:
    """All endpoints that occur in any of the tables, in order."""
    names = [table.select("endpoint") for table in tables]
    return reduce(DataFrame.union, names).distinct().orderBy("endpoint")


def single_endpoint_baseline(
    universe: DataFrame, scalar: DataFrame, by: list[str]
) -> DataFrame:
    """Give a scalar baseline to the endpoint of every document that knows only one.

    ``universe`` has distinct ``by, endpoint``; ``scalar`` has ``by, baseline_scalar``.
    """
    known = universe.groupBy(*by).agg(
        F.count("*").alias("endpoints"), F.min("endpoint").alias("endpoint")
    )
    return (
        known.filter(F.col("endpoints") == 1)
        .join(scalar, by)
        .filter(F.col("baseline_scalar").isNotNull())
        .select(*by, "endpoint", F.col("baseline_scalar").alias("baseline_rpm"))
    )


def compare_endpoints(
    history: DataFrame,
    recent: DataFrame,
    window_seconds: Column,
    ratio: float = TRAFFIC_SPIKE_RATIO,
    minimum_requests: int = MINIMUM_REQUESTS_FOR_SPIKE,
) -> DataFrame:
    """Every endpoint of either side: counts, traffic classification and error rates.

    Missing counts are 0, missing rates null. Both sides have one row per endpoint.
    """
    check_spike_thresholds(ratio, minimum_requests)
    past, now = history.alias("past"), recent.alias("now")
    joined = past.join(now, F.col("past.endpoint") == F.col("now.endpoint"), "full")
    count = lambda name: F.coalesce(F.col(name), F.lit(0)).cast("bigint")
    sides = joined.select(
        F.coalesce("past.endpoint", "now.endpoint").alias("endpoint"),
        count("past.requests").alias("historical_requests"),
        count("now.requests").alias("recent_requests"),
        F.col("past.baseline_rpm").alias("baseline"),
        F.col("past.error_rate").alias("historical_error_rate"),
        F.col("now.error_rate").alias("recent_error_rate"),
        count("past.response_bytes").alias("historical_response_bytes"),
        count("now.response_bytes").alias("recent_response_bytes"),
    )
    difference = F.col("recent_error_rate") - F.col("historical_error_rate")
    return sides.select(
        "endpoint",
        "historical_requests",
        "recent_requests",
        *endpoint_traffic(
            F.col("baseline"), F.col("recent_requests"), window_seconds, ratio, minimum_requests
        ),
        "historical_error_rate",
        "recent_error_rate",
        F.round(difference, 6).alias("error_rate_difference"),
        "historical_response_bytes",
        "recent_response_bytes",
    )


def traffic_spikes(compared: DataFrame) -> DataFrame:
    """Endpoints with a significant increase."""
    return compared.filter("significant_increase").select(*SPIKE_COLUMNS)


def spike_order() -> list[Column]:
    """Largest ratio first; without a ratio (baseline 0) before all others."""
    return [F.desc_nulls_first("recent_to_baseline_ratio"), F.desc("recent_rpm"), F.asc("endpoint")]


def ranked_spikes(spikes: DataFrame) -> DataFrame:
    """Spikes with their ``rank``, 1 for the largest. They are sorted over all tasks."""
    return with_rank(spikes, spike_order())


def spike_summary(
    compared: DataFrame,
    ratio: float = TRAFFIC_SPIKE_RATIO,
    minimum_requests: int = MINIMUM_REQUESTS_FOR_SPIKE,
) -> DataFrame:
    """One row: thresholds and how many endpoints had a baseline, were compared, spiked.

    The spiking endpoints themselves are the rows of ``ranked_spikes``.
    """
    check_spike_thresholds(ratio, minimum_requests)
    return compared.agg(
        F.lit(float(ratio)).alias("traffic_spike_ratio"),
        F.lit(int(minimum_requests)).alias("minimum_requests_for_traffic_spike"),
        F.count("historical_baseline_rpm").alias("endpoint_baselines_available"),
        F.count_if("comparison_available").alias("endpoints_compared"),
        F.count_if("significant_increase").alias("significant_increase_count"),
    )


def _shares(distribution: DataFrame) -> DataFrame:
    """Adds ``share``, the part of all (non-negative) counts, six decimals."""
    positive = F.greatest(F.col("request_count"), F.lit(0))
    total = distribution.agg(F.sum(positive)).scalar()
    return distribution.select(
        F.col("status_code").cast("string").alias("status_code"),
        "request_count",
        F.round(rate(positive, total), 6).alias("share"),
    )


def compare_status_codes(history: DataFrame, recent: DataFrame) -> DataFrame:
    """Counts and shares of every status code of either side."""
    past, now = _shares(history).alias("past"), _shares(recent).alias("now")
    joined = past.join(now, F.col("past.status_code") == F.col("now.status_code"), "full")
    part = lambda name, zero: F.coalesce(F.col(name), F.lit(zero))
    past_share, now_share = part("past.share", 0.0), part("now.share", 0.0)
    return joined.select(
        F.coalesce("past.status_code", "now.status_code").alias("status_code"),
        part("past.request_count", 0).alias("historical_count"),
        part("now.request_count", 0).alias("recent_count"),
        past_share.alias("historical_share"),
        now_share.alias("recent_share"),
        F.round(now_share - past_share, 6).alias("share_difference"),
    )


def side_totals(metrics: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """One row with ``records``, ``response_bytes`` and ``baseline`` of a side.

    Totals a document states come first; otherwise the endpoints are added up.
    """
    summed = metrics.agg(
        F.coalesce(F.sum("requests"), F.lit(0)).alias("records"),
        F.coalesce(F.sum("response_bytes"), F.lit(0)).alias("response_bytes"),
        F.round(F.sum(usable_rate(F.col("baseline_rpm"))), 6).alias("baseline"),
    )
    if totals is None:
        return summed
    stated = lambda name: totals.select(name).scalar()
    return summed.select(
        F.coalesce(
            stated("total_valid_records"), stated("window_event_count"), "records"
        ).alias("records"),
        F.coalesce(stated("total_response_bytes"), "response_bytes").alias("response_bytes"),
        F.coalesce(stated("baseline_scalar"), "baseline").alias("baseline"),
    )


def serving_totals(history: DataFrame, recent: DataFrame) -> DataFrame:
    """Record and byte totals of both sides from two ``side_totals`` rows."""
    return history.select(
        F.col("records").alias("historical_valid_records"),
        recent.select("records").scalar().alias("recent_valid_records"),
        F.col("response_bytes").alias("historical_response_bytes"),
        recent.select("response_bytes").scalar().alias("recent_response_bytes"),
    )


def overall_traffic(history: DataFrame, recent: DataFrame, window_seconds: Column) -> DataFrame:
    """The overall recent rate against the overall baseline, one row."""
    rates = history.select(
        F.col("baseline").alias("baseline_rpm"),
        recent_rpm(recent.select("records").scalar(), window_seconds).alias("recent_rpm"),
    )
    baseline, now = F.col("baseline_rpm"), F.col("recent_rpm")
    difference = now - baseline
    comparable = baseline.isNotNull() & now.isNotNull()
    ratio = F.when(baseline > 0, F.try_divide(now, baseline))
    return rates.select(
        "baseline_rpm",
        "recent_rpm",
        comparable.alias("comparison_available"),
        F.round(difference, 6).alias("rpm_difference"),
        F.round(ratio, 6).alias("recent_to_baseline_ratio"),
        F.when(comparable, traffic_level(difference))
        .otherwise("baseline unavailable")
        .alias("traffic_status"),
    )


def combined_view(
    history: DataFrame,
    recent: DataFrame,
    history_status: DataFrame,
    recent_status: DataFrame,
    window: DataFrame,
    anomalies: DataFrame,
    ratio: float = TRAFFIC_SPIKE_RATIO,
    minimum_requests: int = MINIMUM_REQUESTS_FOR_SPIKE,
    history_totals: DataFrame | None = None,
    recent_totals: DataFrame | None = None,
    snapshot_generated_at: Column | None = None,
) -> dict[str, DataFrame]:
    """All sections of the serving view, each a table. ``about`` is one row about the view
    itself and the time its snapshot was made, if that is known.

    ``window`` is one row with ``window_seconds, window_start, window_end``. Nothing is
    folded into a single document: the number of endpoints has no bound. The comparison
    of endpoints feeds all sections about them and is written to the shared folder first.
    """
    seconds = window.select("window_seconds").scalar()
    compared = stage(
        compare_endpoints(history, recent, seconds, ratio, minimum_requests), "compared"
    )
    side = lambda name, baseline: compared.select(
        F.col(f"{name}_requests").alias("requests"),
        F.col(f"{name}_response_bytes").alias("response_bytes"),
        baseline.alias("baseline_rpm"),
    )
    past = side_totals(side("historical", F.col("historical_baseline_rpm")), history_totals)
    now = side_totals(side("recent", F.lit(None)), recent_totals)
    overall = overall_traffic(past, now, seconds)
    summary = spike_summary(compared, ratio, minimum_requests)
    made = F.lit(None).cast("string") if snapshot_generated_at is None else snapshot_generated_at
    return {
        "about": window.sparkSession.range(1).select(
            F.lit(VIEW_SCHEMA_VERSION).alias("schema_version"),
            F.lit(VIEW_TYPE).alias("view_type"),
            iso_text(F.current_timestamp()).alias("generated_at"),
            made.alias("speed_snapshot_generated_at"),
            F.lit(VIEW_NOTE).alias("comparison_note"),
        ),
        "window": window.select(
            F.col("window_seconds").cast("double").alias("recent_window_seconds"),
            F.col("window_start").alias("recent_window_start"),
            F.col("window_end").alias("recent_window_end"),
        ),
        "totals": serving_totals(past, now),
        "traffic_comparison": overall.withColumn("row", F.lit(0))
        .join(summary.withColumn("row", F.lit(0)), "row")
        .drop("row"),
        "endpoint_comparison": compared,
        "traffic_spikes": ranked_spikes(traffic_spikes(compared)),
        "status_code_comparison": compare_status_codes(history_status, recent_status),
        "recent_anomalies": anomalies,
    }


# The column that names a row of a section; sections with one row have none.
SECTION_KEYS = {
    "endpoint_comparison": "endpoint",
    "traffic_spikes": "endpoint",
    "status_code_comparison": "status_code",
    "recent_anomalies": "endpoint",
}


def view_lines(view: dict[str, DataFrame]) -> DataFrame:
    """The whole view as JSON rows: ``section, key, body``."""
    parts = []
    for section, table in view.items():
        key = F.col(SECTION_KEYS[section]) if section in SECTION_KEYS else F.lit("")
        body = F.to_json(F.struct(*sorted(table.columns)), {"ignoreNullFields": "false"})
        parts.append(table.select(F.lit(section).alias("section"), key.alias("key"), body.alias("body")))
    return reduce(DataFrame.unionByName, parts)
