"""Requests per minute and the rules that compare them with a baseline."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelog.schema import check_spike_thresholds


def usable_rate(value: Column) -> Column:
    """A finite rate of zero or more, else null."""
    number = value.cast("double")
    return F.when((number >= 0) & ~F.isnan(number) & (number != float("inf")), number)


def recent_rpm(requests: Column, window_seconds: Column) -> Column:
    """Requests per minute, six decimals; null without a positive window."""
    window = usable_rate(window_seconds)
    per_minute = F.greatest(requests, F.lit(0)) * F.lit(60.0) / window
    return F.when(window > 0, F.round(per_minute, 6))


def traffic_level(difference: Column) -> Column:
    return (
        F.when(difference > 0, "above baseline")
        .when(difference < 0, "below baseline")
        .otherwise("equal to baseline")
    )


def endpoint_traffic(
    baseline: Column,
    requests: Column,
    window_seconds: Column,
    ratio_threshold: float,
    minimum_requests: int,
) -> list[Column]:
    """Output columns comparing an endpoint's recent rate with its baseline.

    The ratio is tested before it is rounded; the recent rate is already rounded.
    """
    check_spike_thresholds(ratio_threshold, minimum_requests)
    base = usable_rate(baseline)
    recent = recent_rpm(requests, window_seconds)
    difference = recent - base
    ratio = F.when(base > 0, F.try_divide(recent, base))
    enough = F.greatest(requests, F.lit(0)) >= minimum_requests
    comparable = recent.isNotNull() & base.isNotNull()
    significant = (
        comparable
        & enough
        & (difference > 0)
        & ((base == 0) | F.coalesce(ratio >= ratio_threshold, F.lit(False)))
    )
    status = (
        F.when(recent.isNull(), "recent rate unavailable")
        .when(base.isNull(), "baseline unavailable")
        .when(significant, "significant increase")
        .otherwise(traffic_level(difference))
    )
    return [
        base.alias("historical_baseline_rpm"),
        recent.alias("recent_rpm"),
        comparable.alias("comparison_available"),
        F.round(difference, 6).alias("rpm_difference"),
        F.round(ratio, 6).alias("recent_to_baseline_ratio"),
        status.alias("traffic_status"),
        F.coalesce(significant, F.lit(False)).alias("significant_increase"),
        F.lit(float(ratio_threshold)).alias("spike_ratio_threshold"),
        F.lit(int(minimum_requests)).alias("minimum_requests_threshold"),
        enough.alias("minimum_requests_met"),
    ]
