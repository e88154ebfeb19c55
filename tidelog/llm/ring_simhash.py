"""Near duplicates by SimHash fingerprints, candidates by pigeonring filtering.

A fingerprint is cut into five segments on a ring. If two fingerprints differ in at most
four bits, some segment starts a chain in which the first segment has no difference, the
first two at most one, the first three at most two, and so on: every chain stays within
its share of the budget. Candidates are looked up by the first segment of such a chain,
equal, together with equal parts of the segments behind it: of three parts of the next
two, which have two differences at most, one is equal. For more fingerprints keys take
more parts. A candidate must pass the chain before all bits are compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import Scratch, read_table, words_of
from tidelog.llm.components import connected_components
from tidelog.llm.shingle_join import of_entries, similar_groups, sketch_column
from tidelog.operators.skew import spread_join

SHINGLE_WORDS = 4
SEED = 42
MOST_BITS = 4
SEGMENTS = MOST_BITS + 1
#: Shingles that are hashed at once.
SHINGLES_AT_ONCE = 100_000
#: Widths of lookup keys, from 20 bits in 15 lookups to 36 bits in 280.
WIDTHS = [(3, 3), (4, 5), (4, 6), (4, 8)]
#: Texts that a Python process holds at once, next to their fingerprints and sketches.
TEXTS_AT_ONCE = 500
#: Members of a bucket that all others are linked to first.
LEADERS = 3
BITS = np.arange(64, dtype=np.uint64)


def shingles(words: list[str], size: int, start: int, count: int) -> Iterator[str]:
    some = words[start : start + count + size - 1]
    return map(" ".join, zip(*(some[at:] for at in range(size)), strict=False))


def fingerprint(text: str | None, size: int = SHINGLE_WORDS) -> int:
    """64 bits; a bit is 1 if it is set in over half the hashes of all word shingles.

    A text with fewer words than a shingle has one, all its words; without words the
    fingerprint is 0.
    """
    words = words_of(text or "")
    if not words:
        return 0
    size = min(size, len(words))
    total, hash_of = len(words) - size + 1, xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for start in range(0, total, SHINGLES_AT_ONCE):
        hashes = np.fromiter(
            (hash_of(s.encode("utf-8", "replace"), SEED) for s in shingles(words, size, start, SHINGLES_AT_ONCE)),
            "<u8",
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int((np.uint64(1) << BITS[counts * 2 > total]).sum(dtype=np.uint64))


def fingerprint_column(text: Column, size: int = SHINGLE_WORDS) -> Column:
    """Fingerprint of a text column as BIGINT of the same bits."""

    @F.pandas_udf("long")
    def found(texts: pd.Series) -> pd.Series:
        values = np.array([fingerprint(text, size) for text in texts], np.uint64)
        return pd.Series(values.view(np.int64))

    return found(text)


def segments(most_bits: int = MOST_BITS) -> list[tuple[int, int]]:
    """(first bit, bits) of each segment, one more than differing bits."""
    edges = [64 * at // (most_bits + 1) for at in range(most_bits + 2)]
    return [(low, high - low) for low, high in zip(edges, edges[1:], strict=False)]


def mask_of(bits: list[int]) -> int:
    """Mask of these bits as a signed 64-bit number."""
    mask = sum(1 << bit for bit in bits)
    return mask - (1 << 64) if mask >> 63 else mask


def chain_masks(start: int, most_bits: int = MOST_BITS) -> list[int]:
    """Masks of the first 1, 2, ... segments from ``start`` on around the ring."""
    ring = segments(most_bits)
    masks, bits = [], []
    for step in range(len(ring)):
        low, size = ring[(start + step) % len(ring)]
        bits = [*bits, *range(low, low + size)]
        masks.append(mask_of(bits))
    return masks


def lookups(most_bits: int = MOST_BITS, width: tuple[int, int] = (3, 3)) -> list[tuple[int, int]]:
    """(start of the chain, mask of the bits that must be equal) of every lookup.

    width: segments of the chain that a key looks at, and parts that the segments behind
    the first one are cut into. These segments differ in at most ``budget`` bits, so all
    but ``budget`` parts are equal; there is a lookup for each choice of them.
    """
    ring, found = segments(most_bits), []
    length, parts = min(width[0], len(ring)), width[1]
    equal_parts = max(1, parts - chain_budget(length, most_bits))
    parts = equal_parts + chain_budget(length, most_bits)
    for start in range(len(ring)):
        own, *others = [ring[(start + step) % len(ring)] for step in range(length)]
        first = list(range(own[0], sum(own)))
        rest = [bit for low, size in others for bit in range(low, low + size)]
        cut = [rest[len(rest) * part // parts : len(rest) * (part + 1) // parts] for part in range(parts)]
        for chosen in combinations(cut, equal_parts):
            found.append((start, mask_of(first + [bit for part in chosen for bit in part])))
    return found


def key_width(prints: int, most_bits: int = MOST_BITS) -> tuple[int, int]:
    """The width for so many fingerprints: the first whose keys have about as many values.

    Chance brings together as many prints as there are for each value of a key, so keys
    must become wider as the prints become more; the groups found are the same.
    """
    for width in WIDTHS:
        narrowest = min((mask % (1 << 64)).bit_count() for _, mask in lookups(most_bits, width))
        if prints <= 8 << narrowest:
            break
    return width


def chain_budget(length: int, most_bits: int = MOST_BITS) -> int:
    return length * most_bits // (most_bits + 1)


def close(a: Column, b: Column, start: Column, most_bits: int = MOST_BITS) -> Column:
    """Whether the chain from ``start`` stays within its budgets, and then all bits."""
    difference = a.bitwiseXOR(b)

    def differing(mask: int) -> Column:
        return F.bit_count(difference.bitwiseAND(F.lit(mask)))

    chains = F.lit(False)
    for number in range(most_bits + 1):
        steps = [
            differing(mask) <= chain_budget(length, most_bits)
            for length, mask in enumerate(chain_masks(number, most_bits), 1)
        ]
        chains = chains | ((start == number) & reduce(Column.__and__, steps))
    return chains & (F.bit_count(difference) <= most_bits)


def near_roots(
    prints: DataFrame, scratch: Scratch, most_bits: int = MOST_BITS, width: tuple[int, int] | None = None
) -> DataFrame:
    """(node, root) of the fingerprints that have another within ``most_bits`` bits.

    ``prints`` (node): different fingerprints. width: of the lookup keys, by default that
    for the number of prints. In each bucket of a lookup the members are
    first linked to a few of them only. What these links connect is not compared again;
    members of parts that are still apart are all compared. So no link between parts is
    lost, and a bucket of many near copies does not give all their pairs.
    """
    found = lookups(most_bits, width or key_width(prints.count(), most_bits))
    keys = F.array(
        *[
            F.struct(
                F.lit(number).cast("short").alias("lookup"),
                F.lit(start).cast("byte").alias("start"),
                F.col("node").bitwiseAND(F.lit(mask)).alias("bits"),
            )
            for number, (start, mask) in enumerate(found)
        ]
    )
    bucket = ["lookup", "bits"]
    posted = scratch.write(prints.select("node", F.explode(keys).alias("key")).select("node", "key.*"), "postings")
    leaders = [F.min_by("node", F.xxhash64("node", F.lit(turn))).alias(f"leader_{turn}") for turn in range(LEADERS)]
    crowds = posted.groupBy(*bucket).agg(F.count("*").alias("members"), *leaders).filter("members > 1")
    crowded = scratch.write(posted.join(crowds, bucket), "crowds")
    scratch.drop(posted)

    leader = F.explode(F.array_distinct(F.array(*[f"leader_{turn}" for turn in range(LEADERS)])))
    stars = scratch.write(
        crowded.select("node", "start", leader.alias("leader"))
        .filter((F.col("node") != F.col("leader")) & close(F.col("node"), F.col("leader"), F.col("start"), most_bits))
        .select(F.col("node").alias("a"), F.col("leader").alias("b"))
        .distinct(),
        "stars",
    )
    parts = scratch.write(connected_components(stars, scratch), "parts")

    members = crowded.join(parts, "node", "left").select(
        *bucket, "start", "node", F.coalesce("root", "node").alias("part")
    )
    apart = members.groupBy(*bucket).agg(F.min("part").alias("p"), F.max("part").alias("q")).filter("p <> q")
    left = scratch.write(members.join(apart.select(*bucket), bucket), "apart")
    right = left.select(*bucket, F.col("node").alias("other"), F.col("part").alias("other_part"))
    between = (
        left.join(right, bucket)
        .filter((F.col("node") < F.col("other")) & (F.col("part") != F.col("other_part")))
        .filter(close(F.col("node"), F.col("other"), F.col("start"), most_bits))
        .select(F.least("part", "other_part").alias("a"), F.greatest("part", "other_part").alias("b"))
        .distinct()
    )
    joins = scratch.write(connected_components(scratch.write(between, "between"), scratch), "joins")
    alone = between_only(joins, parts)
    whole = parts.join(joins.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left")
    return whole.select("node", F.coalesce("top", "root").alias("root")).unionByName(alone)


def between_only(joins: DataFrame, parts: DataFrame) -> DataFrame:
    """Parts of one fingerprint, which no first link has reached."""
    return joins.join(parts, "node", "left_anti")


def grouped_prints(prints: DataFrame, scratch: Scratch, most_bits: int = MOST_BITS) -> DataFrame:
    """(fingerprint, root, copies, first_id) of every different fingerprint."""
    different = scratch.write(
        prints.groupBy("fingerprint").agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_id")),
        "different",
    )
    roots = near_roots(different.select(F.col("fingerprint").alias("node")), scratch, most_bits)
    return different.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("root"), "copies", "first_id"
    )


def near_duplicates(docs: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    Two fingerprints link when they differ in at most ``most_bits`` bits; component_id is
    the smallest id that can be reached over links, the own one included. Null, empty
    and blank texts have fingerprint 0 and link like any other. Rows without an id take
    part; a group of only such rows has no component_id. Repeated rows give repeated
    results.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    prints = scratch.write(docs.select("doc_id", fingerprint_column(F.col("text")).alias("fingerprint")), "prints")
    groups = scratch.write(grouped_prints(prints, scratch, most_bits), "groups")
    ids = groups.groupBy("root").agg(F.min("first_id").alias("component_id"))
    table = groups.join(ids, "root").select("fingerprint", "copies", "component_id")
    return spread_join(prints, table, ["fingerprint"], ["doc_id"]).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(
    docs: DataFrame, most_bits: int = MOST_BITS, similarity: float | None = None
) -> DataFrame:
    """One row of each group, with all columns: that of the smallest id.

    With a similarity, the rows that stay are grouped once more: those with that Jaccard
    similarity of five-word shingles link, however many bits their fingerprints differ in,
    and one row of each group stays.

    Rows are written once with their fingerprint and a number, so that just one of rows
    that repeat an id stays; rows without an id stay only in groups that have no id. What
    goes is sent to the rows by number, so their texts do not move again.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    sketch = [] if similarity is None else [sketch_column(F.col("text")).alias("sketch")]
    numbered = scratch.write(
        docs.select(
            F.struct("*").alias("row"),
            F.col("doc_id").alias("doc_id"),
            fingerprint_column(F.col("text")).alias("fingerprint"),
            *sketch,
            F.monotonically_increasing_id().alias("entry"),
        ),
        "rows",
        TEXTS_AT_ONCE,
    )
    prints = numbered.select("doc_id", "fingerprint", "entry")
    groups = scratch.write(grouped_prints(prints, scratch, most_bits), "groups")
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "entry")
    firsts = prints.groupBy("fingerprint").agg(F.min(place).alias("place"))
    stays = firsts.join(groups, "fingerprint").groupBy("root").agg(F.min("place").alias("place"))
    kept = scratch.write(stays.select("place.entry"), "kept")
    gone = scratch.write(prints.select("entry").join(kept, "entry", "left_anti"), "gone")
    if similarity is not None:
        left = of_entries(numbered, gone, "left_anti")
        texts = left.select("entry", F.col("row.text").alias("text"))
        roots = similar_groups(left.select("entry", "sketch.n", "sketch.keys"), texts, scratch, similarity)
        ranked = prints.join(roots, "entry")
        best = ranked.groupBy("root").agg(F.min(place).alias("place")).select("place.entry")
        gone = scratch.write(gone.unionByName(roots.select("entry").join(best, "entry", "left_anti")), "all-gone")
    return of_entries(numbered, gone, "left_anti").select("row.*")


def op9_simhash_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))
