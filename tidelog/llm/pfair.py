"""Mixing sources to target weights with Pfair scheduling.

The documents of a source are cut into blocks. Block k of a source with weight w may not
be placed before slot floor(k / w) and must be placed before slot ceil((k + 1) / w).
Serving the released block with the earliest deadline meets all deadlines, and then no
source is ever a whole block away from its share.

Weights are fractions with one denominator, so the schedule repeats after that many
slots. Only one period is computed on the driver; it does not grow with the data. The
slot of every block follows from its number by arithmetic.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.llm.common import Scratch, read_table

BLOCK_ROWS = 64
PERIOD = 1000
#: Rows of a source are numbered in so many pieces, so that none is sorted in one task.
PIECES = 1024
#: Without given weights, a source weighs as its number of rows to this power.
FLATTEN = 0.7


def whole_shares(weights: Mapping[str, float], period: int) -> dict[str, int]:
    """Slots of a period for each source, at least one, closest to the weights.

    The period is made longer if it has fewer than four slots a source. Remainders go to
    the largest fractions, ties to the first name.
    """
    period = max(period, 4 * len(weights))
    total = sum(weights.values())
    exact = {name: weight / total * period for name, weight in weights.items()}
    shares = {name: max(1, int(share)) for name, share in exact.items()}
    by_need = sorted(exact, key=lambda name: (shares[name] - exact[name], name))
    spare = period - sum(shares.values())
    for name in by_need[: max(0, spare)]:
        shares[name] += 1
    while sum(shares.values()) > period:
        largest = max(shares, key=lambda name: (shares[name], name))
        shares[largest] -= 1
    return shares


def one_period(shares: Mapping[str, int]) -> list[tuple[str, int, int, int, int]]:
    """(source, block, release, deadline, slot) of each block of one period."""
    period = sum(shares.values())
    waiting = [
        (block * period // share, -(-(block + 1) * period // share), name, block)
        for name, share in shares.items()
        for block in range(share)
    ]
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int, int]] = []
    placed = []
    for slot in range(period):
        while waiting and waiting[0][0] <= slot:
            release, deadline, name, block = heapq.heappop(waiting)
            heapq.heappush(ready, (deadline, name, block, release))
        deadline, name, block, release = heapq.heappop(ready)
        placed.append((name, block, release, deadline, slot))
    return placed


def flattened_weights(docs: DataFrame, power: float = FLATTEN) -> dict[str, float]:
    """Target weights from the sizes of the sources, smaller sources weigh more."""
    sizes = docs.groupBy(source_name().alias("source")).count().collect()  # a row a source
    return {row["source"]: row["count"] ** power for row in sizes}


def source_name():
    """Rows without a source are a source of their own."""
    return F.coalesce(F.col("source").cast("string"), F.lit(""))


def pieced(docs: DataFrame, *keep: Column) -> DataFrame:
    """Every row with ``doc_id, source``, a hash and its piece of the source, and ``keep``.

    Rows are taken in the order of the hash of the id; of rows without an id it is the
    hash of the text.
    """
    spread = F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.col("text")))
    piece = F.pmod(F.shiftrightunsigned(spread, 20), F.lit(PIECES)).cast("int")
    return docs.select(
        *keep, "doc_id", source_name().alias("source"), spread.alias("spread"), piece.alias("piece")
    )


def placed_in_source(rows: DataFrame, slim: DataFrame) -> DataFrame:
    """Rows of pieced() with ``place``, their number in their source. They are numbered
    within pieces of the hash, then piece after piece; ``slim`` are the same rows."""
    pieces = slim.groupBy("source", "piece").agg(F.count("*").alias("rows"))
    earlier = Window.partitionBy("source").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select("source", "piece", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("source", "piece").orderBy("spread", "doc_id"))
    numbered = rows.withColumn("inside", inside).join(starts, ["source", "piece"])
    return numbered.withColumn("place", F.col("start") + F.col("inside") - 1).drop("inside", "start", "spread", "piece")


def mix(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    block_rows: int = BLOCK_ROWS,
    period: int = PERIOD,
) -> DataFrame:
    """(doc_id, source, weight, block, place_in_block, release, deadline, slot) of every row.

    weights: target weight of each source, default flattened_weights(). A source that has
    no weight or one of 0 is placed after all others, in slot -1 of none (null release
    and deadline). Every row is placed once: where a source has no more blocks its slots
    stay empty. Rows are taken in the order of a hash of the id, those without an id of the
    text; rows that repeat an id follow each other. Rows without a source form the source "".
    """
    scratch = Scratch(docs.sparkSession, "mix")
    rows = scratch.write(pieced(docs), "rows")
    return scheduled(placed_in_source(rows, rows), docs, weights, block_rows, period)


def scheduled(
    rows: DataFrame, docs: DataFrame, weights: Mapping[str, float] | None, block_rows: int, period: int
) -> DataFrame:
    """Rows with ``source`` and ``place`` as mix() gives them, with their other columns."""
    spark = docs.sparkSession
    targets = {k: float(v) for k, v in (weights or flattened_weights(docs)).items() if v > 0}
    plan = one_period(whole_shares(targets, period)) if targets else []
    shares: dict[str, int] = {}
    for name, *_ in plan:
        shares[name] = shares.get(name, 0) + 1
    table = spark.createDataFrame(
        [(*row, shares[row[0]], len(plan)) for row in plan],
        "source STRING, turn LONG, first_release LONG, first_deadline LONG, first_slot LONG,"
        " share LONG, period LONG",
    )
    share_of = table.select("source", "share", "period").distinct()  # a row a source
    more = [name for name in rows.columns if name not in ("doc_id", "source", "place")]
    blocks = rows.select(
        *more,
        "doc_id",
        "source",
        F.expr(f"place DIV {block_rows}").alias("block"),
        F.pmod("place", F.lit(block_rows)).alias("place_in_block"),
    ).join(F.broadcast(share_of), "source", "left")
    turned = blocks.withColumn("turn", F.pmod("block", "share")).withColumn(
        "passed", F.expr("block DIV share") * F.col("period")
    )
    placed = turned.join(F.broadcast(table.drop("share", "period")), ["source", "turn"], "left")
    return placed.select(
        *more,
        "doc_id",
        "source",
        (F.col("share") / F.col("period")).alias("weight"),
        "block",
        "place_in_block",
        (F.col("passed") + F.col("first_release")).alias("release"),
        (F.col("passed") + F.col("first_deadline")).alias("deadline"),
        F.coalesce(F.col("passed") + F.col("first_slot"), F.lit(-1)).alias("slot"),
    )


def mixed_order(docs: DataFrame, weights: Mapping[str, float] | None = None) -> DataFrame:
    """The rows of ``docs`` in the order of the schedule, all columns as they are.

    Every row has a slot of its own, also one that repeats an id or has none. Sources
    without a weight come last. Each file of the written result is one stretch of the
    schedule.
    """
    row = "row of the input"
    placed = placed_in_source(pieced(docs, F.struct("*").alias(row)), pieced(docs))
    slots = scheduled(placed, docs, weights, BLOCK_ROWS, PERIOD)
    last = F.when(F.col("slot") < 0, F.lit(1 << 62)).otherwise(F.col("slot"))
    return slots.orderBy(last, "source", "block", "place_in_block", "doc_id").select(f"`{row}`.*")


def op5_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents"))
