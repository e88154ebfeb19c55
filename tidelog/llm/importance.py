"""Quality by importance resampling.

Two generative models of hashed word n-grams, one of target texts and one of all texts,
give each document the log ratio of its probabilities. Documents are drawn without
replacement in proportion to these weights: add Gumbel noise to the log weight and keep
the largest. The noise is a hash of the id, so a run can be repeated.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import Scratch, read_table, words_of

BUCKETS = 1 << 16
SMOOTH = 1.0
#: At most so many labelled documents make the target model.
TARGET_DOCUMENTS = 20_000
KEEP_SHARE = 0.75
#: The mean log ratio of an n-gram counts as this many n-grams.
EVIDENCE = 64.0
FEW_GRAMS = 16
#: Draws are compared in steps of this size.
DRAW_STEPS = 1e12
NO_SIGN = -(1 << 63)
KNOWN_WORDS = 200_000
PIECE_WORDS = 200_000
MIX = np.uint64(0x9E3779B97F4A7C15)


class Buckets:
    """Buckets of the one- and two-word grams of texts; hashes of words are kept, and
    forgotten when they are many."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def hashes(self, words: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > KNOWN_WORDS:
            known.clear()
        for word in set(words).difference(known):
            known[word] = zlib.crc32(word.encode("utf-8", "replace"))
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    def of(self, text: str | None) -> Iterator[np.ndarray]:
        """Buckets of all grams, some at a time."""
        words = words_of(text or "")
        for at in range(0, len(words), PIECE_WORDS):
            hashes = self.hashes(words[at : at + PIECE_WORDS + 1])
            ones = (hashes[:PIECE_WORDS] * MIX) >> np.uint64(48)
            twos = ((hashes[:-1] * np.uint64(31) + hashes[1:] + np.uint64(1)) * MIX) >> np.uint64(48)
            yield np.concatenate([ones, twos]).astype(np.int64)


def gram_counts(texts: DataFrame) -> np.ndarray:
    """Count of each bucket over all rows of ``texts`` (text); a row a bucket is gathered."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        buckets, sums = Buckets(), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch["text"]:
                for own in buckets.of(text):
                    sums += np.bincount(own, minlength=BUCKETS)
        used = np.flatnonzero(sums)
        yield pd.DataFrame({"bucket": used, "n": sums[used]})

    summed = texts.select("text").mapInPandas(count, "bucket LONG, n LONG").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = np.zeros(BUCKETS, np.int64)
    for row in summed.collect():  # at most BUCKETS rows
        found[row["bucket"]] = row["n"]
    return found


def log_ratios(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Log ratio of the smoothed shares of each bucket."""
    share = lambda counts: (counts + SMOOTH) / (counts.sum() + SMOOTH * len(counts))
    return np.log(share(target)) - np.log(share(raw))


def target_texts(docs: DataFrame, labels: DataFrame, most: int = TARGET_DOCUMENTS) -> DataFrame:
    """Texts of documents that are labelled good and never bad; of more than ``most`` of
    them those with the smallest hash of the id."""
    good = (
        labels.filter(F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .filter("quality = 1")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
        .select("doc_id")
    )
    return docs.select("doc_id", "text").join(F.broadcast(good), "doc_id", "left_semi")


def kth_largest(table: DataFrame, column: str, k: int) -> int:
    """The k-th largest of at least k values of a BIGINT column, found 16 bits at a time.

    Each pass gathers at most 2 ** 16 counts, so neither all values nor a share of them
    meet in one place.
    """
    ordered = table.select(F.col(column).bitwiseXOR(F.lit(NO_SIGN)).alias("bits"))
    prefix, wanted = 0, k
    for shift in (48, 32, 16, 0):
        digit = F.shiftrightunsigned("bits", shift).bitwiseAND(F.lit(0xFFFF))
        inside = ordered
        if shift < 48:
            inside = ordered.filter(F.shiftrightunsigned("bits", shift + 16) == F.lit(prefix))
        counts = {row["digit"]: row["count"] for row in inside.groupBy(digit.alias("digit")).count().collect()}
        for value in sorted(counts, reverse=True):
            if counts[value] >= wanted:
                break
            wanted -= counts[value]
        prefix = prefix << 16 | value
    return prefix + NO_SIGN


def log_weights(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """(doc_id, n_grams, log_weight) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios)  # 8 bytes a bucket

    @F.pandas_udf("n_grams LONG, log_weight DOUBLE")
    def weigh(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        buckets, table = Buckets(), shared.value
        for texts in batches:
            rows = []
            for text in texts:
                grams, total = 0, 0.0
                for own in buckets.of(text):
                    grams += len(own)
                    total += float(table[own].sum())
                rows.append((grams, EVIDENCE * total / (grams + FEW_GRAMS)))
            yield pd.DataFrame(rows, columns=["n_grams", "log_weight"])

    return docs.select("doc_id", weigh(F.col("text")).alias("found")).select("doc_id", "found.*")


def resample(docs: DataFrame, labels: DataFrame, keep_share: float = KEEP_SHARE, seed: int = 1) -> DataFrame:
    """(doc_id, n_grams, log_weight, draw, kept) for every row of ``docs``.

    kept: the share ``keep_share`` of all rows, rounded up, with the largest draws; rows
    with the same draw as the last of them are kept too. log_weight is the mean log ratio
    of the n-grams, scaled; few n-grams pull it to 0, which is the weight of null, empty
    and blank texts. Repeated rows have the same draw. Without target texts all weights
    are equal up to smoothing and the draw is uniform.
    """
    scratch = Scratch(docs.sparkSession, "importance")
    target, raw = gram_counts(target_texts(docs, labels)), gram_counts(docs)
    ratios = log_ratios(target, raw) if target.any() else np.zeros(BUCKETS)
    uniform = (F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))
    draw = F.col("log_weight") - F.log(-F.log(uniform))
    weighed = scratch.write(
        log_weights(docs, ratios)
        .withColumn("draw", draw)
        .withColumn("place", F.floor(F.col("draw") * F.lit(DRAW_STEPS)).cast("long")),
        "weights",
    )
    k = -int(-weighed.count() * keep_share // 1)
    last = kth_largest(weighed, "place", k) if k else 0
    return weighed.select(
        "doc_id", "n_grams", "log_weight", "draw", (F.col("place") >= F.lit(last)).alias("kept")
    )


def op2_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
