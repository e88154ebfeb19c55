"""Do two ways of computing the metrics agree, key by key?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.columns import rate
from tidelog.schema import ERROR_STATUS

# The metrics that are compared and the tolerances.
COMPARABLE_METRICS = [
    "total_valid_records",
    "total_response_bytes",
    "requests_per_endpoint",
    "error_rates",
    "traffic_by_hour",
    "status_code_distribution",
    "response_byte_totals",
]
RELATIVE_TOLERANCE = 1e-9
ABSOLUTE_TOLERANCE = 1e-12


def metric_values(facts: DataFrame) -> DataFrame:
    """All comparable metrics in long form: ``metric, key, field, value``.

    One pass: the facts are grouped by endpoint, by hour, by status and as a whole at once.
    """
    keyed = facts.select("endpoint", F.hour("minute").alias("hour"), "status_code", "requests", "response_bytes")
    errors = F.when(F.col("status_code") >= ERROR_STATUS, F.col("requests")).otherwise(F.lit(0))
    keyed = keyed.withColumn("errors", errors)
    grouped = keyed.groupingSets(
        [["endpoint"], ["hour"], ["status_code"], []], "endpoint", "hour", "status_code"
    ).agg(
        F.grouping_id().alias("level"),
        F.sum("requests").alias("requests"),
        F.sum("errors").alias("errors"),
        F.sum("response_bytes").alias("response_bytes"),
    )

    def entry(metric: str, value: Column, key: Column | None = None, field: str = "") -> Column:
        return F.struct(
            F.lit(metric).alias("metric"),
            (F.lit("") if key is None else key.cast("string")).alias("key"),
            F.lit(field).alias("field"),
            value.cast("double").alias("value"),
        )

    endpoint, hour, status = F.col("endpoint"), F.col("hour"), F.col("status_code")
    requests, size = F.col("requests"), F.col("response_bytes")
    by_endpoint = F.array(
        entry("requests_per_endpoint", requests, endpoint),
        entry("error_rates", requests, endpoint, "total_requests"),
        entry("error_rates", F.col("errors"), endpoint, "error_count"),
        entry("error_rates", rate(F.col("errors"), requests), endpoint, "error_rate"),
        entry("response_byte_totals", size, endpoint),
    )
    whole = F.array(
        entry("total_valid_records", F.coalesce(requests, F.lit(0))),
        entry("total_response_bytes", F.coalesce(size, F.lit(0))),
    )
    # A set bit of the level marks a column that is grouped away.
    entries = (
        F.when(F.col("level") == 0b011, by_endpoint)
        .when(F.col("level") == 0b101, F.array(entry("traffic_by_hour", requests, hour)))
        .when(F.col("level") == 0b110, F.array(entry("status_code_distribution", requests, status)))
        .otherwise(whole)
    )
    return grouped.select(F.inline(entries))


def _close(left: Column, right: Column) -> Column:
    allowed = F.greatest(
        F.lit(RELATIVE_TOLERANCE) * F.greatest(F.abs(left), F.abs(right)), F.lit(ABSOLUTE_TOLERANCE)
    )
    return F.abs(left - right) <= allowed


def compare_values(batch: DataFrame, stream: DataFrame) -> DataFrame:
    """Both sides of every value and an ``outcome``."""
    keys = ["metric", "key", "field"]
    left = batch.select(*keys, F.col("value").alias("batch_value"))
    right = stream.select(*keys, F.col("value").alias("stream_value"))
    in_batch, in_stream = F.col("batch_value"), F.col("stream_value")
    outcome = (
        F.when(in_batch.isNull(), "missing from batch")
        .when(in_stream.isNull(), "missing from stream")
        .when(_close(in_batch, in_stream), "equal")
        .otherwise("different")
    )
    return left.join(right, keys, "full").withColumn("outcome", outcome)


def find_differences(compared: DataFrame) -> DataFrame:
    return compared.filter(F.col("outcome") != "equal")


def compare_metrics(compared: DataFrame) -> DataFrame:
    """One row per metric: does it match, and how many values differ."""
    wanted = F.explode(F.array(*[F.lit(name) for name in COMPARABLE_METRICS]))
    names = compared.sparkSession.range(1).select(wanted.alias("metric"))
    counted = compared.groupBy("metric").agg(
        F.count_if(F.col("outcome") != "equal").alias("differing")
    )
    return names.join(counted, "metric", "left").select(
        "metric",
        (F.coalesce("differing", F.lit(0)) == 0).alias("match"),
        F.coalesce("differing", F.lit(0)).alias("differences"),
    )
