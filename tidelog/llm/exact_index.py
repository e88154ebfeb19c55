"""Exact duplicates, found with an extendible hash index kept as shared files.

The directory is a list of key prefixes. It starts with one bucket and doubles until no
bucket is overfull. The index is a table of chains, sorted by bucket and key, with one link
for each different text of a key; the task that owns a range of buckets compares the texts
of its keys byte by byte, so texts that share a key without being equal are links of one
chain. Keys that occur once have nothing to compare: their texts are not moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import BLANKS, Scratch, read_table
from tidelog.operators.skew import spread_join

#: Different keys of a bucket, and the doublings a directory may begin with.
CAPACITY = 20_000
FIRST_DEPTH = 6
#: A prefix must leave a bit of the key.
DEEPEST = 62
#: Rows that are sent to all tasks at most, some tens of bytes each.
BROADCAST_ROWS = 1_000_000


def normalised(text: Column) -> Column:
    """Text with every run of blanks as one space; null is the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def text_key(text: Column) -> Column:
    return F.xxhash64(text)


def prefix_of(key: Column, depth: int) -> Column:
    """The first bits of a 64-bit key."""
    return F.shiftrightunsigned(key, 64 - depth)


def small(table: DataFrame) -> DataFrame:
    """A written table, sent to all tasks if its size allows it."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def directory(entries: DataFrame, scratch: Scratch, capacity: int = CAPACITY) -> tuple[DataFrame, int]:
    """(prefix, depth, bucket) for every prefix that has keys, and the bits of a prefix.

    A prefix belongs to the bucket of the smallest depth that holds at most ``capacity``
    different keys; copies of one key need no room. While some bucket of the full depth
    is overfull the directory is doubled; 64-bit keys that are different differ in some
    bit, so there is always a depth that is enough. bucket: the first prefix that it
    covers.
    """
    keys = scratch.write(entries.select("key").distinct(), "distinct-keys")
    depth = FIRST_DEPTH + (keys.count() // capacity).bit_length()
    while True:
        cells = scratch.write(
            keys.groupBy(prefix_of(F.col("key"), depth).alias("prefix")).agg(F.count("*").alias("keys")), "cells"
        )
        if depth >= DEEPEST or not cells.filter(F.col("keys") > capacity).limit(1).count():
            break
        depth = min(DEEPEST, depth + FIRST_DEPTH)
    doubled = cells.withColumn("depth", F.explode(F.sequence(F.lit(0), F.lit(depth)))).withColumn(
        "cell", F.expr(f"shiftright(prefix, {depth} - depth)")
    )
    held = doubled.groupBy("depth", "cell").agg(F.sum("keys").alias("held"))
    first_fit = (
        doubled.join(held, ["depth", "cell"])
        .filter((F.col("held") <= capacity) | (F.col("depth") == depth))
        .groupBy("prefix")
        .agg(F.min("depth").alias("depth"))
    )
    low = F.expr(f"shiftleft(shiftright(prefix, {depth} - depth), {depth} - depth)")
    table = scratch.write(first_fit.select("prefix", "depth", low.alias("bucket")), "directory")
    return table, depth


def write_index(keyed: DataFrame, texts: DataFrame, scratch: Scratch) -> DataFrame:
    """The chains (bucket, key, text_sha256, group_size, keep_id) of the keys that occur
    more than once, as files sorted by bucket and key.

    ``keyed`` (key, doc_id) is written, ``texts`` (key, text, doc_id) are the same rows
    with their texts. Copies are combined before they move, so a text that a third of all
    rows share is sent once by each task.
    """
    table, depth = directory(keyed, scratch)
    repeated = keyed.groupBy("key").agg(F.count("*").alias("rows")).filter("rows > 1").select("key")
    placed = scratch.write(
        repeated.withColumn("prefix", prefix_of(F.col("key"), depth)).join(small(table), "prefix").select("key", "bucket"),
        "repeated-keys",
    )
    links = (
        texts.join(small(placed), "key")
        .groupBy("bucket", "key", "text")
        .agg(F.count("*").alias("group_size"), F.min("doc_id").alias("keep_id"))
    )
    chains = links.select("bucket", "key", F.unhex(F.sha2("text", 256)).alias("text_sha256"), "group_size", "keep_id")
    return scratch.write(
        chains.repartitionByRange("bucket", "key", "text_sha256").sortWithinPartitions("bucket", "key"), "chains"
    )


def keyed_rows(docs: DataFrame, *keep: Column) -> DataFrame:
    """(doc_id, key, text_sha256, entry) and ``keep`` of every row; entry tells rows apart."""
    text = normalised(F.col("text"))
    return docs.select(
        *keep,
        "doc_id",
        text_key(text).alias("key"),
        F.unhex(F.sha2(text, 256)).alias("text_sha256"),
        F.monotonically_increasing_id().alias("entry"),
    )


def keyed_texts(docs: DataFrame) -> DataFrame:
    text = normalised(F.col("text"))
    return docs.select("doc_id", text_key(text).alias("key"), text.alias("text"))


def first_entries(keyed: DataFrame, chains: DataFrame) -> DataFrame:
    """Chains of more than one row, with ``first``: the entry of the row that stays."""
    repeated = chains.filter("group_size > 1").withColumn("copies", F.col("group_size"))
    same_row = (
        (keyed["key"] == repeated["key"])
        & (keyed["text_sha256"] == repeated["text_sha256"])
        & keyed["doc_id"].eqNullSafe(repeated["keep_id"])
    )
    firsts = (
        keyed.join(repeated, same_row)
        .groupBy(keyed["key"], keyed["text_sha256"])
        .agg(F.min("entry").alias("first"))
    )
    return repeated.join(firsts, ["key", "text_sha256"])


def exact_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256, bucket) for every row of ``docs``.

    Texts are equal when they are the same after replacing each run of blanks by one
    space; null is the empty text. Of equal texts the row with the smallest id stays,
    rows without an id only if no row of the group has one. Of rows that repeat that id
    just one stays, so every group keeps one row. bucket: null for a text that occurs once.
    """
    scratch = Scratch(docs.sparkSession, "exact")
    keyed = scratch.write(keyed_rows(docs), "keys")
    chains = write_index(keyed.select("key", "doc_id"), keyed_texts(docs), scratch)
    alone = F.col("group_size").isNull()
    return spread_join(keyed, first_entries(keyed, chains), ["key", "text_sha256"], ["entry"]).select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("entry") == F.col("first"), F.lit(True)).alias("kept"),
        F.lower(F.hex("text_sha256")).alias("text_sha256"),
        "bucket",
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, by the same index and rule
    as in exact_groups().

    Rows are written once with their key and number; the numbers of what goes are sent to
    them, so the rows that stay do not move.
    """
    scratch = Scratch(docs.sparkSession, "exact")
    rows = scratch.write(keyed_rows(docs, F.struct("*").alias("row")), "rows")
    keyed = rows.select("doc_id", "key", "text_sha256", "entry")
    texts = rows.select("doc_id", "key", normalised(F.col("row.text")).alias("text"))
    chains = write_index(keyed.select("key", "doc_id"), texts, scratch)
    firsts = first_entries(keyed, chains).select("key", "text_sha256", "first", "copies")
    placed = spread_join(keyed, firsts, ["key", "text_sha256"], ["entry"])
    gone = scratch.write(placed.filter("entry <> first").select("entry"), "gone")
    return rows.join(small(gone), "entry", "left_anti").select("row.*")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(read_table(spark, sf_dir, "documents")).drop("bucket")


EXPECTED = """
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS plain
  FROM documents
), keys AS (
  SELECT doc_id, plain, sha256(plain) AS text_sha256 FROM texts
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY plain) AS keep_id,
       count(*) OVER (PARTITION BY plain) AS group_size,
       row_number() OVER (PARTITION BY plain ORDER BY doc_id NULLS LAST) = 1 AS kept,
       text_sha256
FROM keys
"""
