"""Texts that are similar by their word shingles, candidates by MinHash bands.

A text is the set of its shingles. Of each of many random orders the smallest shingle is
kept; two sets have the same one with a probability of their Jaccard similarity. Some of
these values are a band, and texts that share a band are candidates. A pair of similarity
0.8 shares none of the bands with a probability of 7e-6, a more similar one with less.
Candidates are compared on all their shingles.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import Scratch, words_of
from tidelog.llm.components import connected_components
from tidelog.operators.skew import spread_join

SHINGLE_WORDS = 5
BANDS = 30
BAND_ROWS = 5
#: Bands by which rows are first compared.
BANDS_AT_ONCE = 10
#: Numbers of rows that are sent to all tasks at most, eight bytes each.
BROADCAST_ROWS = 2_000_000
#: Pairs of texts that a Python process holds at once.
PAIRS_AT_ONCE = 250
#: Shingles whose random orders are computed at once.
AT_ONCE = 2000
DRAW = np.random.default_rng(11)
FACTORS = DRAW.integers(0, 1 << 63, BANDS * BAND_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = DRAW.integers(0, 1 << 63, BANDS * BAND_ROWS, dtype=np.uint64)


def shingle_set(text: str | None) -> set[str]:
    """A text with fewer words than a shingle has one, all its words; one without words none."""
    words = words_of(text or "")
    size = min(SHINGLE_WORDS, len(words))
    return {" ".join(words[at : at + size]) for at in range(len(words) - size + 1)} if words else set()


def band_keys(shingles: set[str]) -> list[int]:
    """A 64-bit number for each band; none without words."""
    if not shingles:
        return []
    hashes = np.fromiter((xxhash.xxh64_intdigest(one.encode("utf-8", "replace")) for one in shingles), np.uint64)
    least = np.full(len(FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(hashes), AT_ONCE):
        some = hashes[start : start + AT_ONCE, None] * FACTORS + OFFSETS
        least = np.minimum(least, some.min(axis=0))
    rows = least.reshape(BANDS, BAND_ROWS)
    keys = np.array([xxhash.xxh64_intdigest(row.tobytes(), band) for band, row in enumerate(rows)], np.uint64)
    return keys.view(np.int64).tolist()


def jaccard(text: str | None, other: str | None) -> float:
    a, b = shingle_set(text), shingle_set(other)
    return len(a & b) / len(a | b) if a or b else 1.0


def sketch_column(text: Column) -> Column:
    """``n``, the number of shingles, and ``keys``, the bands, of a text column."""

    @F.pandas_udf("n INT, keys ARRAY<LONG>")
    def sketch(texts: pd.Series) -> pd.DataFrame:
        sets = map(shingle_set, texts)
        found = [(len(shingles), band_keys(shingles)) for shingles in sets]
        return pd.DataFrame(found, columns=["n", "keys"])

    return sketch(text)


def of_entries(rows: DataFrame, entries: DataFrame, how: str) -> DataFrame:
    """Rows with, or without, one of the ``entries`` (written, different). As many as
    BROADCAST_ROWS are sent to all tasks, so that the rows need not move; more are not."""
    few = entries.count() <= BROADCAST_ROWS
    return rows.join(F.broadcast(entries) if few else entries, "entry", how)


def similar_pairs(pairs: DataFrame, rows: DataFrame, scratch: Scratch, similarity: float) -> DataFrame:
    """The pairs (entry, to_entry) whose texts are similar enough, written.

    ``rows`` (entry, text) are read once; only texts of a pair are moved.
    """

    @F.pandas_udf("double")
    def found(texts: pd.Series, others: pd.Series) -> pd.Series:
        return pd.Series([jaccard(a, b) for a, b in zip(texts, others, strict=True)], dtype="float64")

    both = pairs.select("entry").unionByName(pairs.select(F.col("to_entry").alias("entry")))
    wanted = scratch.write(both.distinct(), "wanted")
    texts = scratch.write(of_entries(rows.select("entry", "text"), wanted, "left_semi"), "texts")
    copies = pairs.groupBy("to_entry").agg(F.count("*").alias("copies"))
    others = texts.select(F.col("entry").alias("to_entry"), F.col("text").alias("to_text")).join(copies, "to_entry")
    joined = spread_join(pairs.join(texts, "entry"), others, ["to_entry"], ["entry"])
    similar = joined.filter(found("text", "to_text") >= similarity - 1e-9).select("entry", "to_entry")
    found_pairs = scratch.write(similar, "similar", PAIRS_AT_ONCE)
    scratch.drop(texts, wanted)
    return found_pairs


def similar_groups(sketches: DataFrame, rows: DataFrame, scratch: Scratch, similarity: float) -> DataFrame:
    """(entry, root) of the rows that links of similar texts connect with others.

    ``sketches`` (entry, n, keys) and ``rows`` (entry, text) are written. Some bands at a
    time, every row is compared with the first row of one of its bands, and rows that are
    similar to it need no further comparison of that kind: in a group of many near copies
    this connects nearly all, with about one pair a row. In the end all rows that share a
    band and are not connected yet are compared, if their sizes allow the similarity. So
    no link between groups is lost, and a large group does not give all its pairs.
    """
    links: list[DataFrame] = []
    connected: list[DataFrame] = []
    for start in range(1, BANDS + 1, BANDS_AT_ONCE):
        some = F.slice("keys", F.lit(start), F.lit(BANDS_AT_ONCE))
        left = of_entries(sketches, reduce(DataFrame.unionByName, connected), "left_anti") if connected else sketches
        posted = left.select("entry", F.explode(some).alias("key"))
        heads = posted.groupBy("key").agg(F.min("entry").alias("head"), F.count("*").alias("members"))
        near = posted.join(heads.filter("members > 1").drop("members"), "key").filter("entry <> head")
        pairs = scratch.write(near.groupBy("entry").agg(F.min("head").alias("to_entry")), "pairs")
        found = similar_pairs(pairs, rows, scratch, similarity)
        links.append(found)
        connected.append(scratch.write(found.select("entry").distinct(), "connected"))
    edges = lambda pairs: pairs.select(F.col("entry").alias("a"), F.col("to_entry").alias("b"))
    known = scratch.write(reduce(DataFrame.unionByName, links), "links")
    parts = scratch.write(connected_components(edges(known), scratch), "parts")

    placed = sketches.join(parts.withColumnRenamed("node", "entry"), "entry", "left")
    members = scratch.write(placed.select("entry", "n", "keys", F.coalesce("root", "entry").alias("part")), "members")
    posted = members.select("entry", "n", "part", F.explode("keys").alias("key"))
    apart = posted.groupBy("key").agg(F.min("part").alias("p"), F.max("part").alias("q")).filter("p <> q")
    meeting = scratch.write(posted.join(apart.select("key"), "key"), "apart")
    other = meeting.select("key", *[F.col(name).alias(f"to_{name}") for name in ("entry", "n", "part")])
    allowed = F.least("n", "to_n") >= F.lit(similarity - 1e-9) * F.greatest("n", "to_n")
    meet = (
        (meeting["key"] == other["key"])
        & (F.col("part") != F.col("to_part"))
        & (F.col("entry") < F.col("to_entry"))
        & allowed
    )
    between = scratch.write(meeting.join(other, meet).select("entry", "to_entry").distinct(), "between")
    more = similar_pairs(between, rows, scratch, similarity)
    scratch.drop(members, meeting)
    return connected_components(edges(known.unionByName(more)), scratch).withColumnRenamed("node", "entry")
