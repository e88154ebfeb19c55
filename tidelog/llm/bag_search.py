"""Ranked lexical search that scores each class of equal bags once.

A document's score depends on two things only: how often it has each term of the items,
and its length class m. Documents are cut down to the terms of the items, and those with
the same counts and the same m are one class, found by a hash and compared in full. Classes
are scored once; the best ones stand for their members, taken by ascending id.

Items are searched in blocks, so that the terms of a block, which every task holds, have a
fixed bound whatever the number of items.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.llm.common import LOWER_AZ, Scratch, read_table

#: Fixed value of the contract: a term, in a text as it is.
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
NO_TERM = re.compile(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
#: Terms of a block of items, counted once an item. An item with more is a block itself.
TERMS_AT_ONCE = 100_000
#: Cells of the matrix of terms and classes that a task scores at once.
CELLS_AT_ONCE = 2_000_000
CHARACTERS_AT_ONCE = 1_000_000
#: The best rows of an item are found in so many parts first.
PARTS = 64


@dataclass(frozen=True)
class Ranking:
    """The best ``top`` documents of each item; b_percent: what the length counts for."""

    top: int = 10
    b_percent: int = 90


def terms_of(text: str) -> Iterator[list[str]]:
    """The terms of a text, some at a time; long texts are cut where no term is."""
    start = 0
    while start < len(text):
        border = NO_TERM.search(text, start + CHARACTERS_AT_ONCE) if len(text) - start > CHARACTERS_AT_ONCE else None
        end = border.start() if border else len(text)
        yield TERM.findall(text[start:end].translate(LOWER_AZ))
        start = end


def items_of(queries: DataFrame, scratch: Scratch) -> DataFrame:
    """(item, item_id, terms, block): distinct terms of each different row of the queries."""

    @F.pandas_udf("array<string>")
    def distinct_terms(texts: pd.Series) -> pd.Series:
        return pd.Series([sorted(set(chain.from_iterable(terms_of(text or "")))) for text in texts], dtype=object)

    rows = scratch.write(
        queries.select("item_id", "text")
        .distinct()
        .select("item_id", distinct_terms("text").alias("terms"))
        .filter(F.size("terms") > 0)
        .withColumn("item", F.monotonically_increasing_id()),
        "items",
    )
    total = rows.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("n")).first()["n"]
    blocks = -(-total // (TERMS_AT_ONCE // 2)) if total > TERMS_AT_ONCE else 1
    return rows.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)))


@dataclass
class Block:
    """Items of a block: their terms as numbers, one item after the other."""

    items: np.ndarray
    starts: np.ndarray
    terms: np.ndarray
    number: dict[str, int]


def read_block(rows: DataFrame) -> Block:
    """Gather a block: about TERMS_AT_ONCE terms or one item."""
    items, starts, terms, number = [], [], [], {}
    for row in rows.select("item", "terms").orderBy("item").collect():
        items.append(row["item"])
        starts.append(len(terms))
        terms.extend(number.setdefault(term, len(number)) for term in row["terms"])
    return Block(np.array(items, np.int64), np.array(starts, np.int64), np.array(terms, np.int64), number)


def bags(docs: DataFrame, block: Block) -> DataFrame:
    """(doc_id, n, bag) of every row: its terms with repeats, and how often it has each
    term of the block, as pairs of integers (term, count) in ascending order."""
    shared = docs.sparkSession.sparkContext.broadcast(block.number)  # TERMS_AT_ONCE terms

    def bag_of(text: str, number: dict[str, int]) -> tuple[int, bytes]:
        n, held = 0, Counter()
        for terms in terms_of(text):
            n += len(terms)
            held.update(terms)
        pairs = sorted((number[term], count) for term, count in held.items() if term in number)
        return n, np.array(pairs, "<i4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        for batch in batches:
            found = [bag_of(text.as_py() or "", number) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([n for n, _ in found], pa.int64()),
                    pa.array([bag for _, bag in found], pa.binary()),
                ],
                ["doc_id", "n", "bag"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(cut, "doc_id LONG, n LONG, bag BINARY")


def term_weights(rows: DataFrame, terms: int, n_docs: int) -> np.ndarray:
    """Weight of each term of the block by the number of rows that hold it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(terms, np.int64)
        for batch in batches:
            pairs = np.frombuffer(b"".join(batch.column("bag").to_pylist()), "<i4").reshape(-1, 2)
            held += np.bincount(pairs[:, 0], minlength=terms)
        used = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(held[used])], ["term", "df"])

    counts = rows.select("bag").mapInArrow(count, "term LONG, df LONG").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(F.lit(1000) * F.log((F.lit(2.0 * n_docs + 2)) / (F.lit(2) * F.col("df") + F.lit(1.0))))
    found = np.zeros(terms, np.int64)
    for row in counts.select("term", weight.cast("long").alias("w")).collect():  # a row a term of the block
        found[row["term"]] = row["w"]
    return found


def classes(rows: DataFrame, n_docs: int, n_terms: int, ranking: Ranking) -> DataFrame:
    """(bag, m, members) of each class of rows with a term of the block.

    A class is known by its hash and told apart by its bag and m. members: its smallest
    ids, ranking.top at most, those without an id last. Each task keeps so many of a class
    before they meet, so that the size of a class does not matter.
    """
    b = ranking.b_percent
    m = F.expr(f"{100 - b} + ({b} * n * {n_docs}L) DIV {max(1, n_terms)}L")
    keyed = (
        rows.filter(F.length("bag") > 0)
        .select("doc_id", "bag", m.cast("long").alias("m"))
        .withColumn("hash", F.xxhash64("bag", "m"))
    )
    by_id = F.col("doc_id").asc_nulls_last()
    place = F.row_number().over(Window.partitionBy("hash", "m", "bag").orderBy(by_id))
    first = keyed.withColumn("place", place).filter(F.col("place") <= F.lit(ranking.top))
    member = F.struct("place", "doc_id")
    return (
        first.groupBy("hash", "m", "bag")
        .agg(F.sort_array(F.collect_list(member)).alias("members"))
        .select("bag", "m", F.col("members.doc_id").alias("members"))
    )


def class_scores(bag: list[bytes], m: np.ndarray, block: Block, weight: np.ndarray) -> np.ndarray:
    """Score of each class for each item: rows are items, columns are classes."""
    pairs = np.frombuffer(b"".join(bag), "<i4").reshape(-1, 2).astype(np.int64)
    owner = np.repeat(np.arange(len(bag)), [len(own) // 8 for own in bag])
    term, tf = pairs[:, 0], pairs[:, 1]
    cells = np.zeros((len(weight), len(bag)), np.int64)
    cells[term, owner] = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[owner]))
    return np.add.reduceat(cells[block.terms], block.starts, axis=0)


def best_rows(found: pd.DataFrame, top: int) -> pd.DataFrame:
    """The best rows of each item among (item, score, doc_id)."""
    order = found.sort_values(["item", "score", "doc_id"], ascending=[True, False, True], na_position="last")
    return order[order.groupby("item").cumcount() < top]


def scored(table: DataFrame, block: Block, weight: np.ndarray, ranking: Ranking) -> DataFrame:
    """(item, score, doc_id): the best rows of each item in each task.

    A class that is not among the best of its task, by score and first member, has no
    member that is: the first members of those before it come first.
    """
    shared = table.sparkSession.sparkContext.broadcast((block, weight))  # TERMS_AT_ONCE terms
    top = ranking.top

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, weight = shared.value
        width = max(1, CELLS_AT_ONCE // max(1, len(weight), len(block.terms)))
        kinds = {"item": "int64", "score": "int64", "doc_id": "Int64"}
        best = pd.DataFrame({name: pd.Series(dtype=kind) for name, kind in kinds.items()})
        floor = np.zeros(len(block.items), np.int64)
        for batch in batches:
            bag, m = batch.column("bag").to_pylist(), batch.column("m").to_numpy()
            members = batch.column("members").to_pylist()
            for at in range(0, len(bag), width):
                found = class_scores(bag[at : at + width], m[at : at + width], block, weight)
                item, column = np.nonzero((found >= floor[:, None]) & (found > 0))
                if not len(item):
                    continue
                item, column = few(found, item, column, top)
                own = [members[at + c] for c in column.tolist()]
                sizes = [len(ids) for ids in own]
                rows = pd.DataFrame(
                    {
                        "item": np.repeat(item, sizes),
                        "score": np.repeat(found[item, column], sizes),
                        "doc_id": pd.array(list(chain.from_iterable(own)), dtype="Int64"),
                    }
                )
                best = best_rows(pd.concat([best, rows]), top)
                held = best.groupby("item")["score"].agg(["size", "min"])
                full = held[held["size"] == top]
                floor[full.index.to_numpy(np.int64)] = full["min"].to_numpy()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(block.items[best["item"].to_numpy(np.int64)], pa.int64()),
                pa.array(best["score"].to_numpy(np.int64)),
                pa.array(best["doc_id"], pa.int64()),
            ],
            ["item", "score", "doc_id"],
        )

    return table.mapInArrow(score, "item LONG, score LONG, doc_id LONG")


def few(found: np.ndarray, item: np.ndarray, column: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the (item, class) places, those with one of the ``top`` largest scores of the
    item, and all with as much as the last of them."""
    values = found[item, column]
    order = np.lexsort((-values, item))
    item, column, values = item[order], column[order], values[order]
    starts = np.flatnonzero(np.diff(item, prepend=-1))
    sizes = np.diff(starts, append=len(item))
    last = values[np.minimum(starts + top - 1, starts + sizes - 1)]
    stays = values >= np.repeat(last, sizes)
    return item[stays], column[stays]


def search(docs: DataFrame, queries: DataFrame, ranking: Ranking = Ranking()) -> DataFrame:
    """(item_id, rank, doc_id, score): the best rows of ``docs`` for each item.

    queries: (item_id, text). Equal rows of it are one item, rows that share an id but not
    the text are items of their own, each with its own ranks. Every row of ``docs`` is a
    document, also rows that repeat an id or have none; equal scores go by ascending id,
    rows without an id last. Null, empty and wordless texts and items have no terms and no
    results, nor has an empty table.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "search")
    items = items_of(queries, scratch)
    numbers = [row["block"] for row in items.select("block").distinct().orderBy("block").collect()]  # a row a block
    results = []
    for number in numbers:
        block = read_block(items.filter(F.col("block") == F.lit(number)))
        rows = scratch.write(bags(docs, block), "bags")
        sums = rows.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        weight = term_weights(rows, len(block.number), sums["docs"])
        table = classes(rows, sums["docs"], sums["terms"], ranking)
        results.append(scratch.write(scored(table, block, weight, ranking), "best"))
        scratch.drop(rows)
    found = reduce(DataFrame.unionByName, results, spark.createDataFrame([], "item LONG, score LONG, doc_id LONG"))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    part = F.pmod(F.xxhash64("doc_id"), F.lit(PARTS))
    in_part = F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))
    overall = F.row_number().over(Window.partitionBy("item").orderBy(*order))
    best = found.withColumn("part", part).withColumn("rank", in_part).filter(F.col("rank") <= F.lit(ranking.top))
    best = best.withColumn("rank", overall).filter(F.col("rank") <= F.lit(ranking.top))
    return best.join(items.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def op11_bag_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


EXPECTED = r"""
WITH d AS (
    SELECT doc_id, row_number() OVER () AS entry, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), sums AS (
    SELECT count(*) FILTER (len(terms) > 0) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM d
), tf AS (
    SELECT entry, term, count(*) AS tf FROM (SELECT entry, unnest(terms) AS term FROM d) GROUP BY entry, term
), w AS (
    SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w
    FROM tf, sums GROUP BY term, n_docs
), item AS (
    SELECT item, item_id, unnest(list_distinct(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term
    FROM (SELECT row_number() OVER () AS item, * FROM (SELECT DISTINCT item_id, text FROM benchmark))
), scored AS (
    SELECT item, item_id, entry,
        CAST(sum(w.w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len(terms) * n_docs) // n_terms)))) AS BIGINT) AS score
    FROM item JOIN w USING (term) JOIN tf USING (term) JOIN d USING (entry), sums
    GROUP BY item, item_id, entry
), ranked AS (
    SELECT item_id, doc_id, score,
        row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank
    FROM scored JOIN d USING (entry) WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
