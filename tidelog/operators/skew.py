"""Joins that stay balanced when a few keys hold most of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECES_PER_PARTITION = 4


def spread_join(
    rows: DataFrame, table: DataFrame, keys: list[str], salt_on: list[str]
) -> DataFrame:
    """Add the columns of ``table`` to ``rows``; rows without a match stay, with nulls.

    ``table`` has one row per key and a column ``copies``, the number of ``rows`` with
    that key. A key with more copies than a piece, a quarter of an average shuffle
    partition, is split into pieces by salt. There are fewer such keys than pieces in
    all, so the list of them is small enough to broadcast whatever the data size. Rows
    with a null key match nothing and are spread over all pieces.
    """
    spark = rows.sparkSession
    pieces = PIECES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = rows.agg(F.count("*")).scalar()
    filled = F.ceil(F.try_divide(F.col("copies") * F.lit(pieces), total))
    salted = table.withColumn("salts", F.greatest(filled, F.lit(1)).cast("int"))

    hot = salted.filter(F.col("salts") > 1).select(*keys, "salts")
    null_key = reduce(Column.__or__, [F.col(key).isNull() for key in keys])
    ways = F.when(null_key, F.lit(pieces)).otherwise(F.coalesce("salts", F.lit(1)))
    marked = (
        rows.join(F.broadcast(hot), keys, "left")
        .withColumn("salt", F.pmod(F.xxhash64(*salt_on), ways).cast("int"))
        .drop("salts")
    )
    spread = salted.withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))
    ).drop("salts", "copies")
    return marked.join(spread, [*keys, "salt"], "left").drop("salt")
