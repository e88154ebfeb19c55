"""Latency and scaling figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.session import stage

DIGIT_BITS = 16
DIGIT_SHIFTS = (48, 32, 16, 0)


def value_counts(values: DataFrame, column: str) -> DataFrame:
    """``v`` and ``n``, how often each value occurs, written to the shared folder."""
    counted = values.groupBy(F.col(column).alias("v")).agg(F.count("*").alias("n"))
    return stage(counted, "counts")


def exact_percentiles(values: DataFrame, column: str, probabilities: dict[str, float]) -> DataFrame:
    return percentiles_of_counts(value_counts(values, column), probabilities)


def percentiles_of_counts(counts: DataFrame, probabilities: dict[str, float]) -> DataFrame:
    """Exact percentiles of non-negative whole numbers, linearly interpolated, one row.

    The usual exact aggregate gathers all distinct values in one task. Here the values
    are counted, and the wanted ranks are found digit by digit: 16 bits at a time, so
    that no step handles more than 65,536 counts for a rank, however many values exist.
    """
    spark = counts.sparkSession
    counts = counts.filter(F.col("v").isNotNull()).select("v", "n")
    last = counts.agg(F.sum("n")).scalar() - 1
    asked = []
    for name, probability in probabilities.items():
        place = last * F.lit(float(probability))
        lower = F.floor(place)
        for side, rank in (("low", lower), ("high", F.least(lower + 1, last))):
            asked.append(
                F.struct(
                    F.lit(name).alias("name"),
                    F.lit(side).alias("side"),
                    rank.cast("bigint").alias("rank"),
                    (place - lower).alias("fraction"),
                )
            )
    targets = spark.range(1).select(F.inline(F.array(*asked)))
    targets = targets.filter(F.col("rank").isNotNull()).withColumn("prefix", F.lit(0).cast("bigint"))
    order = Window.partitionBy("name", "side").orderBy("digits")
    for shift in DIGIT_SHIFTS:
        digits = F.shiftright("v", shift)
        above = F.lit(0).cast("bigint") if shift == DIGIT_SHIFTS[0] else F.shiftright("v", shift + DIGIT_BITS)
        histogram = (
            counts.select(digits.alias("digits"), above.alias("prefix"), "n")
            .join(F.broadcast(targets), "prefix")
            .groupBy("name", "side", "rank", "fraction", "digits")
            .agg(F.sum("n").alias("n"))
        )
        through = F.sum("n").over(order)
        found = histogram.withColumn("through", through).withColumn(
            "before", F.col("through") - F.col("n")
        )
        targets = found.filter(
            (F.col("before") <= F.col("rank")) & (F.col("rank") < F.col("through"))
        ).select(
            "name",
            "side",
            (F.col("rank") - F.col("before")).alias("rank"),
            "fraction",
            F.col("digits").alias("prefix"),
        )
    at = lambda name, side: F.max(
        F.when((F.col("name") == name) & (F.col("side") == side), F.col("prefix"))
    )
    part = lambda name: F.max(F.when(F.col("name") == name, F.col("fraction")))
    return targets.agg(
        *[
            (at(name, "low") + (at(name, "high") - at(name, "low")) * part(name)).alias(name)
            for name in probabilities
        ]
    )


def latency_micros(processed_at: Column, ingested_at: Column) -> Column:
    """Time between ingest and processing; null when unknown or negative."""
    passed = F.unix_micros(processed_at) - F.unix_micros(ingested_at)
    return F.when(passed >= 0, passed)


def latency_counts(decoded: DataFrame) -> DataFrame:
    """``valid, v, n``: how often each latency (microseconds) occurs among events that
    carry ``processed_at`` and ``ingested_at``. Counts of several tables can be added up."""
    micros = F.when(F.col("valid"), latency_micros(F.col("processed_at"), F.col("ingested_at")))
    return decoded.groupBy("valid", micros.alias("v")).agg(F.count("*").alias("n"))


def stream_latency(decoded: DataFrame, runtime_seconds: float | Column) -> DataFrame:
    """One row about validated events that carry ``processed_at`` and ``ingested_at``.

    The events are read once, to count how often each latency occurs.
    """
    return latency_report(stage(latency_counts(decoded), "latencies"), runtime_seconds)


def latency_report(counts: DataFrame, runtime_seconds: float | Column) -> DataFrame:
    """The same row from ``latency_counts``, exact to the digit."""
    runtime = runtime_seconds if isinstance(runtime_seconds, Column) else F.lit(float(runtime_seconds))
    millis = lambda value: value / F.lit(1000.0)
    valid, value, n = F.col("valid"), F.col("v"), F.col("n")
    total = lambda amount: F.coalesce(F.sum(amount), F.lit(0))
    overall = counts.agg(
        total(n).alias("records_attempted"),
        total(F.when(valid, n)).alias("records_processed"),
        total(F.when(~valid, n)).alias("invalid_records"),
        total(F.when(value.isNotNull(), n)).alias("latency_samples"),
        millis(F.min(value)).alias("latency_min_ms"),
        millis(F.try_divide(F.sum(value * n), F.sum(F.when(value.isNotNull(), n)))).alias(
            "latency_mean_ms"
        ),
        millis(F.max(value)).alias("latency_max_ms"),
        F.lit(0).alias("row"),
    )
    quantiles = percentiles_of_counts(counts, {"p50": 0.5, "p95": 0.95}).withColumn("row", F.lit(0))
    throughput = F.when(runtime > 0, F.col("records_processed") / runtime).otherwise(F.lit(0.0))
    return overall.join(quantiles, "row").select(
        "records_attempted",
        "records_processed",
        "invalid_records",
        runtime.alias("runtime_seconds"),
        throughput.alias("throughput_records_per_second"),
        "latency_samples",
        "latency_min_ms",
        "latency_mean_ms",
        millis(F.col("p50")).alias("latency_p50_ms"),
        millis(F.col("p95")).alias("latency_p95_ms"),
        "latency_max_ms",
    )


def every_nth(lines: DataFrame, every: int, line_number: Column | None = None) -> DataFrame:
    """Every Nth line. Without a line number the lines of each input split are counted."""
    if every < 1:
        raise ValueError("the sampling step must be at least 1")
    if line_number is None:
        in_split = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
        line_number = in_split + 1
    return lines.filter(line_number % every == 0)


def scaling_efficiency(runs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Speedup over the one-worker run and efficiency, three decimals.

    ``runs`` has ``workers, elapsed_sec``; with ``by`` there is a baseline per group.
    Without a one-worker run the speedup is 1.
    """
    by = by or []
    base = runs.filter(F.col("workers") == 1).groupBy(*by).agg(F.max("elapsed_sec").alias("base"))
    if by:
        joined = runs.join(base, by, "left")
    else:
        joined = runs.withColumn("base", base.scalar())
    speedup = F.coalesce(F.try_divide("base", "elapsed_sec"), F.lit(1.0))
    return joined.select(
        *by,
        "workers",
        "elapsed_sec",
        F.round(speedup, 3).alias("speedup"),
        F.round(speedup / F.col("workers"), 3).alias("efficiency"),
    )
