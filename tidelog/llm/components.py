"""Connected components of a graph that is too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import Scratch


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b BIGINT); root: the smallest node.

    Alternates two steps until nothing changes: every node hands its larger neighbours
    to the smallest node it sees, then its smaller neighbours (large-star, small-star).
    The edges of each round are a written table, so the plan stays short and a lost
    executor repeats only its own tasks. No edges give no rows.
    """
    stars = scratch.write(
        edges.filter("a <> b")
        .select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
        .distinct(),
        "edges",
    )
    seen = _mark(stars)
    while seen[0]:
        turned = scratch.write(_small_star(_large_star(stars)), "edges")
        scratch.drop(stars)
        stars, now = turned, _mark(turned)
        if now == seen:
            break
        seen = now
    roots = stars.select(F.col("root").alias("node"), "root").distinct()
    return stars.unionByName(roots)


def _mark(stars: DataFrame) -> tuple:
    """Equal for equal sets of edges; rounds go on until it stays the same."""
    return tuple(stars.agg(F.count("*"), F.bit_xor(F.xxhash64("node", "root"))).first())


def _large_star(stars: DataFrame) -> DataFrame:
    both = stars.select("node", F.col("root").alias("near")).unionByName(
        stars.select(F.col("root").alias("node"), F.col("node").alias("near"))
    )
    least = both.groupBy("node").agg(F.min("near").alias("low"))
    return (
        both.join(least, "node")
        .filter("near > node")
        .select(F.col("near").alias("node"), F.least("node", "low").alias("root"))
        .distinct()
    )


def _small_star(stars: DataFrame) -> DataFrame:
    least = stars.groupBy("node").agg(F.min("root").alias("low"))
    handed = (
        stars.join(least, "node")
        .filter("root <> low")
        .select(F.col("root").alias("node"), F.col("low").alias("root"))
    )
    kept = least.select("node", F.col("low").alias("root"))
    return kept.unionByName(handed).distinct()
