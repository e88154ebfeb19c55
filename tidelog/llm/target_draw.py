"""Target-distribution importance resampling with Arrow kernels.

Texts become words by Arrow's own kernels, words become the indices of a dictionary, and
shifted indices become runs of words. Only different words and pairs of runs and words are
hashed; counts, gains and weights are array operations on whole batches.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import Scratch, read_table

#: Fixed value of the contract: what separates words, after A to Z were lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bytes of texts whose words are in memory at once, or one text.
BYTES_AT_ONCE = 4_000_000
#: Words whose checksums a task keeps; all are forgotten when there are more.
KNOWN_WORDS = 300_000
ORDER_BITS = 33


@dataclass(frozen=True)
class Draw:
    """Runs of 1 to ``longest`` words in ``buckets`` buckets; of the documents with at
    least ``min_words`` words, ``percent`` in a hundred are drawn."""

    longest: int = 1
    buckets: int = 10_000
    min_words: int = 20
    percent: int = 10
    seed: int = 2024


class Features:
    """Buckets of the runs of words in the texts of a batch."""

    def __init__(self, draw: Draw):
        self.draw = draw
        self.known: dict[str, int] = {}

    def words(self, texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
        """All words of the texts, and the text that each stands in."""
        lists = pc.split_pattern_regex(pc.ascii_lower(texts), SEPARATORS)
        flat, owner = pc.list_flatten(lists), pc.list_parent_indices(lists)
        real = pc.not_equal(pc.binary_length(flat), 0)
        return flat.filter(real).dictionary_encode(), owner.filter(real).to_numpy().astype(np.int64)

    def checksums(self, words: list[str]) -> np.ndarray:
        if len(self.known) + len(words) > KNOWN_WORDS:
            self.known.clear()
        known = self.known
        for word in words:
            if word not in known:
                known[word] = zlib.crc32(word.encode())
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def of(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(bucket, text) of all runs, first those of one word, then of two, and so on.

        Texts come in slices whose runs fit in memory; a run of n words is a pair of a
        run of n - 1 words and the word behind it, and each pair is hashed once.
        """
        coded, owner = self.words(texts)
        words = coded.dictionary.to_pylist()
        word = coded.indices.to_numpy().astype(np.int64)
        code, sums = word, self.checksums(words)
        yield sums[code] % self.draw.buckets, owner
        for length in range(2, self.draw.longest + 1):
            inside = np.flatnonzero(owner[length - 1 :] == owner[: len(owner) - length + 1])
            pairs = code[inside] * len(words) + word[inside + length - 1]
            distinct, back = np.unique(pairs, return_inverse=True)
            before, after = np.divmod(distinct, max(1, len(words)))
            sums = np.array(
                [
                    zlib.crc32(b" " + words[last].encode(), int(start))
                    for start, last in zip(sums[before], after.tolist(), strict=True)
                ],
                np.int64,
            )
            code = np.full(len(owner), 0, np.int64)
            code[inside] = back
            yield sums[back] % self.draw.buckets, owner[inside]


def slices(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """The texts in order, some at a time, and the number of those before."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    piece = np.cumsum(size) // BYTES_AT_ONCE
    starts = np.flatnonzero(np.diff(piece, prepend=-1))
    for start, end in zip(starts, [*starts[1:], len(texts)], strict=True):
        yield int(start), texts.slice(start, end - start)


def bucket_counts(texts: DataFrame, draw: Draw) -> np.ndarray:
    """Features of each bucket over all rows of ``texts`` (text); a row a bucket is gathered."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, sums = Features(draw), np.zeros(draw.buckets, np.int64)
        for batch in batches:
            for _, some in slices(batch.column("text")):
                for bucket, _ in features.of(some):
                    sums += np.bincount(bucket, minlength=draw.buckets)
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sums[used])], ["bucket", "n"])

    own = texts.select("text").mapInArrow(count, "bucket LONG, n LONG")
    found = np.zeros(draw.buckets, np.int64)
    for row in own.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most draw.buckets rows
        found[row["bucket"]] = row["n"]
    return found


def gains(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """A thousand times the log ratio of the smoothed shares of each bucket, rounded down."""
    buckets = len(raw)
    t_all, s_all = float(target.sum() + buckets), float(raw.sum() + buckets)
    return np.array(
        [
            math.floor(1000 * math.log((float(t + 1) * s_all) / (float(s + 1) * t_all)))
            for t, s in zip(target.tolist(), raw.tolist(), strict=True)
        ],
        np.int64,
    )


def weights(docs: DataFrame, gain: np.ndarray, draw: Draw) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # 8 bytes a bucket
    kind = docs.schema["doc_id"].dataType
    names = ["n_words", "n_features", "weight"]
    schema = T.StructType([T.StructField("doc_id", kind), *[T.StructField(n, T.LongType()) for n in names]])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, table = Features(draw), shared.value
        for batch in batches:
            found = np.zeros((3, batch.num_rows), np.int64)
            for start, some in slices(batch.column("text")):
                own = found[:, start : start + len(some)]
                for length, (bucket, text) in enumerate(features.of(some), 1):
                    ends = np.searchsorted(text, np.arange(len(some) + 1))
                    total = np.append(0, np.cumsum(table[bucket]))
                    own[0] += np.diff(ends) * (length == 1)
                    own[1] += np.diff(ends)
                    own[2] += total[ends[1:]] - total[ends[:-1]]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, found)], ["doc_id", *names])

    return docs.select("doc_id", "text").mapInArrow(weigh, schema)


def noise(doc_id: Column, seed: int) -> Column:
    """A thousand times a Gumbel draw that follows from the id, rounded down."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    digits = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    uniform = (digits + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000) * F.log(-F.log(uniform))).cast("long")


def ranked(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows with ``place``, their number in the order of eligible, score and id.

    Rows are sorted over all tasks; a task's rows are then counted after those of the
    tasks before it. Equal rows are spread by their own numbers.
    """
    order = [F.col("eligible").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("entry")]
    sorted_rows = scratch.write(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()),
        "sorted",
    )
    task = F.shiftrightunsigned("at", ORDER_BITS)
    counts = sorted_rows.groupBy(task.alias("task")).count().orderBy("task").collect()  # a row a task
    starts, total = [], 0
    for row in counts:
        starts.append((row["task"], total))
        total += row["count"]
    first = sorted_rows.sparkSession.createDataFrame(starts, "task LONG, start LONG")
    inside = F.col("at").bitwiseAND(F.lit((1 << ORDER_BITS) - 1))
    return (
        sorted_rows.withColumn("task", task)
        .join(F.broadcast(first), "task")
        .withColumn("place", F.col("start") + inside + 1)
        .drop("task", "start", "at")
    )


def draw_documents(docs: DataFrame, target: DataFrame, draw: Draw = Draw()) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of ``docs``.

    target: texts (text) whose features are wanted. rank: 1, 2, 3 ... of the drawn rows,
    the highest score first, then the smaller id, rows without an id last; null for all
    others. Rows that repeat an id have the same noise, as have all rows without an id,
    whose id counts as empty text. Null, empty and wordless texts have no features and
    weight 0. Without target texts all gains follow from the smoothing alone.
    """
    scratch = Scratch(docs.sparkSession, "draw")
    gain = gains(bucket_counts(target, draw), bucket_counts(docs, draw))
    weighed = scratch.write(
        weights(docs, gain, draw)
        .withColumn("score", F.col("weight") + noise(F.col("doc_id"), draw.seed))
        .withColumn("eligible", F.col("n_words") >= F.lit(draw.min_words))
        .withColumn("entry", F.monotonically_increasing_id()),
        "weights",
    )
    drawn = draw.percent * weighed.filter("eligible").count() // 100
    rank = F.when(F.col("eligible") & (F.col("place") <= F.lit(drawn)), F.col("place"))
    return ranked(weighed, scratch).select("doc_id", "n_features", "weight", "score", rank.cast("long").alias("rank"))


def op13_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return draw_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


#: Checksums of words by a table of the 256 bytes, which is made from its polynomial.
EXPECTED = r"""
WITH crc_table AS (
    SELECT list(list_reduce([i] || range(8),
        lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS crc
    FROM range(256) r(i)
), words_of AS (
    SELECT doc_id, entry, word FROM (
        SELECT doc_id, row_number() OVER () AS entry, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
        FROM documents)
), target_words AS (
    SELECT unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
    FROM benchmark
), bytes_of AS (
    SELECT word, list_transform(range(1, 2 * octet_length(encode(word)) + 1, 2),
        lambda p: CAST('0x' || substr(hex(encode(word)), p, 2) AS BIGINT)) AS bytes
    FROM (SELECT DISTINCT word FROM (SELECT word FROM words_of UNION ALL SELECT word FROM target_words))
), bucket_of AS (
    SELECT word, xor(list_reduce([4294967295] || bytes,
        lambda c, b: xor(c >> 8, crc[1 + xor(c & 255, b)])), 4294967295) % 10000 AS bucket
    FROM bytes_of, crc_table
), s AS (
    SELECT bucket, count(*) AS n FROM words_of JOIN bucket_of USING (word) GROUP BY bucket
), t AS (
    SELECT bucket, count(*) AS n FROM target_words JOIN bucket_of USING (word) GROUP BY bucket
), gain AS (
    SELECT s.bucket, CAST(floor(1000 * ln(
        (CAST(coalesce(t.n, 0) + 1 AS DOUBLE) * CAST((SELECT sum(n) FROM s) + 10000 AS DOUBLE))
        / (CAST(s.n + 1 AS DOUBLE) * CAST((SELECT coalesce(sum(n), 0) FROM t) + 10000 AS DOUBLE)))) AS BIGINT) AS gain
    FROM s LEFT JOIN t ON s.bucket = t.bucket
), weight AS (
    SELECT entry, count(*) AS n, CAST(sum(gain) AS BIGINT) AS weight
    FROM words_of JOIN bucket_of USING (word) JOIN gain USING (bucket) GROUP BY entry
), scored AS (
    SELECT d.doc_id, d.entry, coalesce(n, 0) AS n_features, coalesce(w.weight, 0) AS weight,
        coalesce(w.weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(CAST(
            '0x' || substr(sha256('2024:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 8)
            AS BIGINT) AS DOUBLE) + 0.5) / 4294967296))) AS BIGINT) AS score
    FROM (SELECT doc_id, row_number() OVER () AS entry FROM documents) d LEFT JOIN weight w USING (entry)
), placed AS (
    SELECT *, row_number() OVER (ORDER BY n_features >= 20 DESC, score DESC, doc_id NULLS LAST) AS place,
        count(*) FILTER (n_features >= 20) OVER () * 10 // 100 AS drawn
    FROM scored
)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score,
    CASE WHEN n_features >= 20 AND place <= drawn THEN CAST(place AS BIGINT) END AS rank
FROM placed
"""
