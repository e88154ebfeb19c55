"""Best-fit packing of documents into sequences by a grouping genetic algorithm.

Pieces of one length are alike, so a packing is a set of patterns, each the lengths that
share one sequence, with the number of sequences of that pattern. There are at most as
many lengths as tokens in a sequence, so a packing stays small however many documents
there are, and the search works on all of them at once.

Islands, one Spark group each, breed packings: a child takes whole well-filled sequences
of one parent, drops those of the other parent that hold the same pieces, and places what
that leaves over by best fit. After each epoch the best packing of every island moves on
to the next island.
"""

from __future__ import annotations

import json
import random
import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm import bpe
from tidelog.llm.common import Scratch, read_table

CAPACITY = 2048
#: The id after the last one of each document.
END = 0
#: Longer texts are encoded in parts.
LONG_TEXT = 500_000
#: Rows of a written batch.
ROWS_AT_ONCE = 20_000

#: (length, copies) of each length in a sequence, longest first.
Pattern = tuple[tuple[int, int], ...]
Packing = dict[Pattern, int]


@dataclass(frozen=True)
class Search:
    """How long the search goes on. It ends early when no packing can be smaller."""

    islands: int = 6
    epochs: int = 3
    generations: int = 10
    population: int = 6
    seed: int = 1


def filled(pattern: Pattern) -> int:
    return sum(length * copies for length, copies in pattern)


def sequences(packing: Packing) -> int:
    return sum(packing.values())


def fewest(lengths: Counter, capacity: int) -> int:
    """No packing has fewer sequences: all tokens must fit, and of the pieces above half
    a sequence no two fit together."""
    tokens = sum(length * count for length, count in lengths.items())
    large = sum(count for length, count in lengths.items() if 2 * length > capacity)
    return max(-(-tokens // capacity), large)


def goodness(packing: Packing, capacity: int) -> tuple[int, float]:
    """Fewer sequences are better; of as many, those with fuller and emptier ones."""
    squares = sum((filled(pattern) / capacity) ** 2 * times for pattern, times in packing.items())
    return -sequences(packing), squares


def with_more(pattern: Pattern, length: int, copies: int) -> Pattern:
    held = dict(pattern)
    held[length] = held.get(length, 0) + copies
    return tuple(sorted(held.items(), reverse=True))


def best_fit(packing: Packing, waiting: Counter, capacity: int) -> Packing:
    """Place the waiting pieces, longest first, each into the fullest sequence it fits.

    Pieces of one length fill the fullest sequences one after the other, so all copies
    of a pattern are served in one step.
    """
    packing = Counter(packing)
    room: dict[int, list[Pattern]] = {}
    for pattern in packing:
        room.setdefault(capacity - filled(pattern), []).append(pattern)
    sizes = sorted(size for size in room if size > 0)

    def put(pattern: Pattern, times: int) -> None:
        left = capacity - filled(pattern)
        if pattern not in packing and left > 0:
            if left not in room or not room[left]:
                insort(sizes, left)
            room.setdefault(left, []).append(pattern)
        packing[pattern] += times

    for length in sorted(waiting, reverse=True):
        count = waiting[length]
        while count > 0:
            at = bisect_left(sizes, length)
            pattern: Pattern = ()
            if at < len(sizes):
                size = sizes[at]
                pattern = room[size].pop()
                if not room[size]:
                    del sizes[at]
                times = packing.pop(pattern)
            else:
                size, times = capacity, count
            each = size // length
            whole = min(times, count // each)
            if whole:
                put(with_more(pattern, length, each), whole)
                count -= whole * each
                times -= whole
            if times and 0 < count < each:
                put(with_more(pattern, length, count), 1)
                count, times = 0, times - 1
            if pattern and times:
                put(pattern, times)
    return dict(packing)


def first_packing(lengths: Counter, capacity: int, draw: random.Random, exact: float) -> Packing:
    """Best fit of all pieces, after a share ``exact`` of the lengths was completed to
    whole sequences by one or two other pieces."""
    left, packing = Counter(lengths), Counter()
    order = sorted(lengths, reverse=True)
    for length in order:
        if draw.random() >= exact:
            continue
        rest = capacity - length
        some = draw.sample(order, min(len(order), 12))
        for other in [rest, *some]:
            pattern = with_more(((length, 1),), other, 1) if other and other <= rest else ((length, 1),)
            if filled(pattern) < capacity:
                pattern = with_more(pattern, capacity - filled(pattern), 1)
            times = min(left[size] // copies for size, copies in pattern)
            if times > 0:
                packing[pattern] += times
                for size, copies in pattern:
                    left[size] -= times * copies
    return best_fit(packing, +left, capacity)


def crossover(receiver: Packing, donor: Packing, capacity: int, draw: random.Random) -> Packing:
    """The receiver with whole well-filled sequences of the donor.

    Sequences of the receiver that hold pieces of the injected ones go, the emptiest
    first; pieces they lose beyond those are placed again by best fit.
    """
    by_fill = sorted(donor, key=lambda pattern: (-filled(pattern), draw.random()))
    best = by_fill[: max(1, len(by_fill) * 3 // 4)]
    injected = {pattern: donor[pattern] for pattern in best if draw.random() < 0.5}
    twice: Counter = Counter()
    for pattern, times in injected.items():
        for length, copies in pattern:
            twice[length] += copies * times
    return place_again(without(receiver, twice), injected, twice, capacity)


def without(packing: Packing, twice: Counter) -> Packing:
    """Drop sequences, the emptiest first, until each length is gone at least as often as
    ``twice`` says. ``twice`` then counts what is gone too little: nothing, or, as
    negative numbers, what must be placed again."""
    kept = {}
    for pattern in sorted(packing, key=filled):
        times = packing[pattern]
        wanted = max((-(-twice[length] // copies) for length, copies in pattern), default=0)
        gone = min(times, max(0, wanted))
        if gone:
            for length, copies in pattern:
                twice[length] -= copies * gone
        if times > gone:
            kept[pattern] = times - gone
    return kept


def place_again(kept: Packing, injected: Packing, twice: Counter, capacity: int) -> Packing:
    together = Counter(kept)
    together.update(injected)
    return best_fit(together, Counter({length: -n for length, n in twice.items() if n < 0}), capacity)


def mutated(packing: Packing, capacity: int, draw: random.Random) -> Packing:
    """Empty the least filled sequences and some others, and place their pieces again."""
    kept, loose = dict(packing), Counter()
    by_fill = sorted(packing, key=filled)
    chosen = by_fill[: 1 + len(by_fill) // 50] + draw.sample(by_fill, max(1, len(by_fill) // 20))
    for pattern in set(chosen):
        times = kept.pop(pattern)
        for length, copies in pattern:
            loose[length] += copies * times
    return best_fit(kept, loose, capacity)


def evolve(
    lengths: Counter, population: list[Packing], capacity: int, search: Search, draw: random.Random
) -> list[Packing]:
    """The population after some generations, best first."""
    least = fewest(lengths, capacity)
    rank = lambda packing: goodness(packing, capacity)
    while len(population) < search.population:
        exact = 0.0 if not population else draw.random()
        population.append(first_packing(lengths, capacity, draw, exact))
    population = sorted(population, key=rank, reverse=True)[: search.population]
    for _ in range(search.generations):
        if sequences(population[0]) <= least:
            break
        children = []
        for _ in range(max(1, search.population // 2)):
            receiver, donor = (min(draw.sample(range(len(population)), 2)) for _ in range(2))
            child = crossover(population[receiver], population[donor], capacity, draw)
            children.append(mutated(child, capacity, draw) if draw.random() < 0.5 else child)
        population = sorted(population + children, key=rank, reverse=True)[: search.population]
    return population


def written(packing: Packing) -> str:
    return json.dumps([[pattern, times] for pattern, times in sorted(packing.items())])


def reread(text: str) -> Packing:
    return {tuple((length, copies) for length, copies in pattern): times for pattern, times in json.loads(text)}


def best_packing(spark: SparkSession, lengths: Counter, capacity: int, search: Search) -> Packing:
    """The best packing that the islands find.

    Only packings are moved: a few thousand patterns each, whatever the number of pieces.
    """
    shared = spark.sparkContext.broadcast(dict(lengths))  # at most ``capacity`` lengths
    scratch = Scratch(spark, "packing")
    columns = "island INT, epoch INT, sequences LONG, goodness DOUBLE, packing STRING"

    def live(key: tuple, island: pd.DataFrame) -> pd.DataFrame:
        own, epoch = int(key[0]), int(island["epoch"].iloc[0])
        population = [reread(text) for text in island["packing"].dropna()]
        draw = random.Random(f"{search.seed} {own} {epoch}")
        after = evolve(Counter(shared.value), population, capacity, search, draw)
        rows = [(own, epoch + 1, sequences(p), goodness(p, capacity)[1], written(p)) for p in after]
        return pd.DataFrame(rows, columns=["island", "epoch", "sequences", "goodness", "packing"])

    start = [(island, 0, 0, 0.0, None) for island in range(search.islands)]
    state = spark.createDataFrame(start, columns)
    best_first = [F.col("sequences"), F.col("goodness").desc(), F.col("packing")]
    least = fewest(lengths, capacity)
    for epoch in range(search.epochs):
        state = scratch.write(state.groupBy("island").applyInPandas(live, columns), f"epoch-{epoch}")
        if state.agg(F.min("sequences")).first()[0] <= least:
            break
        place = F.row_number().over(Window.partitionBy("island").orderBy(*best_first))
        elite = state.withColumn("place", place).filter("place = 1").drop("place")
        state = state.unionByName(elite.withColumn("island", F.pmod(F.col("island") + 1, F.lit(search.islands)).cast("int")))
    return reread(state.orderBy(*best_first).limit(1).collect()[0]["packing"])


def places(packing: Packing) -> dict[str, np.ndarray]:
    """Where the n-th piece of each length goes, as stretches of n for which the sequence
    and the offset follow from n."""
    stretches, sequence = [], 0
    used: Counter = Counter()
    for pattern, times in sorted(packing.items()):
        offset = 0
        for length, copies in pattern:
            stretches.append((length, used[length], copies, sequence, offset))
            used[length] += copies * times
            offset += length * copies
        sequence += times
    table = np.array(sorted(stretches), np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "copies", "sequence", "offset"), table.T, strict=True))


@dataclass
class Tokens:
    """Ids of texts. Long texts are cut where a word begins in any case.

    The encoders are made at their first use. Shared as a broadcast value they are made
    once in a Python process and serve all its tasks: an encoder takes tens of MB.
    """

    vocabulary: bpe.Vocabulary

    @cached_property
    def whole(self):
        import tiktoken

        special = self.vocabulary.special_bytes
        ranks = {token: number for number, token in enumerate(self.vocabulary.tokens) if token not in special}
        return tiktoken.Encoding(
            "vocabulary", pat_str=bpe.WORD_PATTERN, mergeable_ranks=ranks, special_tokens=self.vocabulary.special
        )

    @cached_property
    def by_parts(self) -> bpe.Encoder:
        return bpe.Encoder(self.vocabulary)

    def of(self, text: str) -> np.ndarray:
        """The ids of a text and END, as little-endian unsigned 32-bit integers."""
        if len(text) > LONG_TEXT:
            ids = np.frombuffer(next(self.by_parts.encode([text])), "<u4")
        else:
            ids = self.whole.encode_to_numpy(text, allowed_special="all", disallowed_special=())
        return np.append(ids, END).astype("<u4")


def pieces_of(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, task, nth) of every piece of every row.

    nth counts the pieces of that length that the same task has made before.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Tokens(bpe.read_vocabulary(path)))  # the vocabulary file
    kind = docs.schema["doc_id"].dataType
    numbers = ["piece", "start", "length", "ids_crc32", "task", "nth"]
    schema = T.StructType([T.StructField("doc_id", kind), *[T.StructField(n, T.LongType()) for n in numbers]])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, made = shared.value, [0] * (capacity + 1)
        task = TaskContext.get().partitionId()
        for batch in batches:
            own, rows = batch.column("doc_id"), []
            owner: list[int] = []
            for at, text in enumerate(batch.column("text")):
                ids = tokens.of(text.as_py() or "")
                ends = [*range(len(ids), 0, -capacity)][::-1]
                for piece, (start, end) in enumerate(zip([0, *ends], ends, strict=False)):
                    length = end - start
                    rows.append((piece, start, length, zlib.crc32(ids[start:end].tobytes()), task, made[length]))
                    owner.append(at)
                    made[length] += 1
                if len(rows) >= ROWS_AT_ONCE:
                    yield batch_of(own, owner, rows, numbers)
                    rows, owner = [], []
            if rows:
                yield batch_of(own, owner, rows, numbers)

    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def batch_of(own: pa.Array, owner: list[int], rows: list[tuple], numbers: list[str]) -> pa.RecordBatch:
    columns = [pa.array(column, pa.int64()) for column in zip(*rows, strict=True)]
    return pa.RecordBatch.from_arrays([own.take(pa.array(owner)), *columns], ["doc_id", *numbers])


def counted(pieces: DataFrame) -> DataFrame:
    """The pieces with ``nth`` counted over all tasks. A task's pieces of one length are
    one key of the join, so a length that most pieces have is as many keys as tasks."""
    own = pieces.groupBy("task", "length").agg(F.count("*").alias("own"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    firsts = own.select("task", "length", F.coalesce(F.sum("own").over(before), F.lit(0)).alias("earlier"))
    return pieces.join(firsts, ["task", "length"]).withColumn("nth", F.col("nth") + F.col("earlier")).drop("earlier")


def pack(
    docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, search: Search = Search()
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece.

    Every row of ``docs`` is a document, also rows that repeat an id or have none; null
    and empty texts are the single id END. Documents of more than ``capacity`` ids are cut
    into whole sequences from their end, the first piece holds the rest. A sequence's
    pieces lie one after the other from offset 0. An empty table has no pieces.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "pieces")
    pieces = scratch.write(pieces_of(docs, path or bpe.tokenizer_path(), capacity), "cut")
    rows = pieces.groupBy("length").count().collect()  # at most ``capacity`` rows
    lengths = Counter({row["length"]: row["count"] for row in rows})
    packing = best_packing(spark, lengths, capacity, search) if lengths else {}
    shared = spark.sparkContext.broadcast(places(packing))  # a few patterns a length

    @F.pandas_udf("sequence_id LONG, offset LONG")
    def placed(length: pd.Series, nth: pd.Series) -> pd.DataFrame:
        table, wide = shared.value, np.int64(1) << np.int64(48)
        size, number = length.to_numpy(np.int64), nth.to_numpy(np.int64)
        at = np.searchsorted(table["length"] * wide + table["first"], size * wide + number, "right") - 1
        behind, inside = np.divmod(number - table["first"][at], table["copies"][at])
        return pd.DataFrame({"sequence_id": table["sequence"][at] + behind, "offset": table["offset"][at] + inside * size})

    found = counted(pieces).withColumn("found", placed("length", "nth"))
    return found.select("doc_id", "piece", "start", "length", "ids_crc32", "found.*")


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"))
