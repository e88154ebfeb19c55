"""Language-model scores by prediction by partial matching over bytes.

A text is predicted word by word, a word byte by byte and then its end. A byte is
predicted from the longest known context, at most ORDER bytes of the text before it,
words joined by single blanks. A byte never seen there costs the escape of that context
and is predicted from the next shorter one, without the bytes already excluded.

Contexts run over the borders of words, so a word costs more or less by what stands
before it. Without ``across`` they stop at the start of each word.

Texts come from a mixture: the languages of the training documents fall into a few groups
by hash, each with a trie of its own, and the probability of a text is the mean of the
groups' by their shares of the training documents. The language of a text is not looked
at when it is scored.

All contexts are exact. A gram is a symbol with its longest context; the different grams
of all texts are a table. Every different gram is scored once, and a document adds up the
scores of its grams. Grams are dealt by the last two bytes of the context, so that a task
has all longer contexts of its grams. Counts after one byte, at most 2 ** 8 *
SYMBOLS rows, go to all tasks; nothing else is gathered.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import Scratch, id_remainder, read_table

ORDER = 5
GROUPS = 6
#: 256 bytes and the end of a text. A word ends with a blank, which no word contains.
SYMBOLS = 257
END_OF_TEXT = 256
BLANK = 32
#: The end of a text among the words of the vocabulary.
END = " "
BLOCK_DOCUMENTS = 5000
#: Words of a block that are spelled at once. A gram and a number below this fit in 64 bits.
PART_WORDS = 60_000
#: Shares of the blocks that are added up one after the other.
PASSES = 2
BUCKET_GRAMS = 50_000
#: Bytes of a context that deal its grams.
DEALT_BYTES = 2
SMOOTH = 0.1


def symbols_of(word: str) -> list[int]:
    """Bytes of a word and its end; the end of a text is one symbol."""
    return [END_OF_TEXT] if word == END else [*word.encode("utf-8", "replace"), BLANK]


def classes_of(order: int, contexts: np.ndarray) -> np.ndarray:
    """The last ``order`` bytes of contexts, the last byte lowest. Every context is a
    class of its own."""
    return (contexts & np.uint64((1 << 8 * order) - 1)).astype(np.int64)


def tokens_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different words of some texts, and the word and the text of each token, as
    ``words_of`` finds them."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    encoded = lists.flatten().dictionary_encode()
    word, text = encoded.indices.to_numpy(), pc.list_parent_indices(lists).to_numpy()
    empty = pc.index(encoded.dictionary, "").as_py()
    if empty < 0:
        return encoded.dictionary, word, text
    some = word != empty
    word, text = word[some], text[some]
    words = pa.concat_arrays([encoded.dictionary[:empty], encoded.dictionary[empty + 1 :]])
    return words, word - (word > empty), text


def in_sequence(words: pa.Array, word: np.ndarray, text: np.ndarray, texts: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different words with END after them, and the word and the text of each token,
    the ends of texts among them."""
    place = np.arange(len(word)) + text
    sequence = np.full(len(word) + texts, len(words), np.int32)
    sequence[place] = word
    tokens = np.bincount(text, minlength=texts) + 1
    ended = pa.concat_arrays([words, pa.array([END], words.type)])
    return ended, sequence, np.repeat(np.arange(texts, dtype=np.int32), tokens)


def gram_parts(words: pa.Array, sequence: np.ndarray, across: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The gram and the token of each symbol, PART_WORDS tokens at once. A part is spelled
    with the words before it, so that its first contexts are whole."""
    for start in range(0, len(sequence), PART_WORDS):
        lead = min(start, ORDER)
        spelling = Spelling.of(words.take(pa.array(sequence[start - lead : start + PART_WORDS])), across)
        own = slice(np.searchsorted(spelling.word, lead), None)
        yield spelling.grams()[own], spelling.word[own] + (start - lead)


def firsts_of(ordered: np.ndarray) -> np.ndarray:
    """Places of the first of each of the different keys."""
    return np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))


def run_lengths(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys in order, and how often each occurs."""
    first = firsts_of(ordered)
    return ordered[first], np.diff(first, append=len(ordered))


def together(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The different keys of some parts in order, and the sums of their counts."""
    keys, counts = (np.concatenate(column) for column in zip(*parts, strict=True))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = firsts_of(keys)
    return keys[first], np.add.reduceat(counts[order], first)


@dataclass
class Spelling:
    """All symbols of some words: their word, and what comes before them, the last byte
    lowest, as far back as ``reach`` bytes. A text begins after blanks, and without
    ``across`` every word after one."""

    symbols: np.ndarray
    word: np.ndarray
    before: np.ndarray
    reach: np.ndarray

    @classmethod
    def of(cls, words: list[str] | pa.Array, across: bool = False) -> Spelling:
        words = pa.array(words, pa.large_string()) if isinstance(words, list) else words.cast(pa.large_string())
        ends = pc.equal(words, END)
        blank, nothing, start = (pa.scalar(text, words.type) for text in (" ", "", " " * ORDER))
        spelled = pc.if_else(ends, END + " " * ORDER, pc.binary_join_element_wise(words, blank, nothing))
        sizes = pc.binary_length(spelled).to_numpy().astype(np.int64)
        first, size = np.cumsum(sizes) - sizes, int(sizes.sum())
        spelled = pa.concat_arrays([pa.array([start]), spelled, pa.array([start])])
        whole = pa.LargeListArray.from_arrays(pa.array([0, len(spelled)], pa.int64()), spelled)
        stream = pc.binary_join(whole, nothing)[0].as_buffer()
        # eight bytes from every place on: a context, its symbol and two bytes after it
        grams = np.ndarray((size,), ">u8", stream, strides=(1,)).astype(np.uint64) >> np.uint64(16)
        last = np.flatnonzero(ends.to_numpy(zero_copy_only=False))
        own = np.ones(size, bool)
        own[(first[last, None] + np.arange(1, ORDER + 1)).ravel()] = False
        sizes[last] = 1
        grams, first = grams[own], np.cumsum(sizes) - sizes
        symbols, before = (grams & np.uint64(255)).astype(np.int64), grams >> np.uint64(8)
        symbols[first[last]] = END_OF_TEXT
        if not across:
            for back in range(1, ORDER):
                begins = (before >> np.uint64(8 * (back - 1))) & np.uint64(255) == BLANK
                before[begins] &= np.uint64((1 << 8 * back) - 1)
        reach = np.full(len(before), ORDER, np.int64) if across else reach_of(before)
        return cls(symbols, np.repeat(np.arange(len(words)), sizes), before, reach)

    def grams(self) -> np.ndarray:
        """A number for each context and symbol; without ``across``, a blank in it tells
        how far it reaches."""
        return self.before.astype(np.int64) * SYMBOLS + self.symbols


def reach_of(before: np.ndarray) -> np.ndarray:
    """Bytes of contexts: only the blank before a word can be their first byte."""
    reach = np.full(len(before), ORDER, np.int64)
    for back in range(ORDER, 0, -1):
        reach[(before >> np.uint64(8 * (back - 1))) & np.uint64(255) == BLANK] = back
    return reach


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order and the sums of their counts, those above 0."""
    unique, where = np.unique(keys, return_inverse=True)
    sums = np.zeros(len(unique), np.int64)
    np.add.at(sums, where, counts)
    return unique[sums > 0], sums[sums > 0]


def cells_of(
    before: np.ndarray, reach: np.ndarray, symbols: np.ndarray, counts: np.ndarray, lowest: int = 0
) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By order the cells (context * SYMBOLS + symbol) and their counts."""
    found = {}
    for order in range(lowest, ORDER + 1):
        own = reach >= order
        found[order] = summed(classes_of(order, before[own]) * SYMBOLS + symbols[own], counts[own])
    return found


def counted(words: list[str], counts: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By order the cells and the counts of these words."""
    spelling = Spelling.of(words)
    weight = np.asarray(counts, np.int64)[spelling.word]
    return cells_of(spelling.before, spelling.reach, spelling.symbols, weight)


def places(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places of keys, -1 for those that are not there."""
    if not len(sorted_keys):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == keys, at, -1)


@dataclass
class Level:
    """Cells of one order, and the contexts they belong to: the sum of their counts,
    their number, and the sum of the counts that the next shorter context has for the
    same symbols. A last context stands for those never seen."""

    cells: np.ndarray
    counts: np.ndarray
    contexts: np.ndarray
    whole: np.ndarray
    kinds: np.ndarray
    below: np.ndarray


@dataclass
class Trie:
    """Counts of one group, by order. What was seen after a context was also seen after
    each shorter one, so the symbols excluded at an order are those of the order above."""

    alphabet: np.ndarray
    levels: list[Level]

    @classmethod
    def of(cls, cells: dict[int, tuple[np.ndarray, np.ndarray]]) -> Trie:
        levels: list[Level] = []
        for order in range(ORDER + 1):
            own, counts = cells[order]
            contexts, where = np.unique(own // SYMBOLS, return_inverse=True)
            size = len(contexts) + 1
            shorter = np.zeros(len(own), np.int64)
            if order:
                last = levels[-1]
                short = classes_of(order - 1, (own // SYMBOLS).astype(np.uint64)) * SYMBOLS + own % SYMBOLS
                shorter = last.counts[places(last.cells, short)]
            levels.append(
                Level(
                    own,
                    counts,
                    contexts,
                    np.bincount(where, counts, size),
                    np.bincount(where, minlength=size),
                    np.bincount(where, shorter, size),
                )
            )
        return cls(np.unique(cells[0][0] % SYMBOLS), levels)

    def score(self, before: np.ndarray, reach: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """log10 probabilities of symbols after some contexts."""
        rest, found = np.zeros(len(before)), np.full(len(before), np.nan)
        kinds_above, counts_above = np.zeros(len(before), np.int64), np.zeros(len(before))
        for order in range(ORDER, -1, -1):
            level = self.levels[order]
            open_ones = np.flatnonzero((reach >= order) & np.isnan(found))
            own = classes_of(order, before[open_ones])
            context, cell = places(level.contexts, own), places(level.cells, own * SYMBOLS + symbols[open_ones])
            kinds = level.kinds[context] - kinds_above[open_ones]
            whole = level.whole[context] - counts_above[open_ones] + kinds
            seen = cell >= 0
            found[open_ones[seen]] = rest[open_ones[seen]] + np.log10(level.counts[cell[seen]] / whole[seen])
            escaped = ~seen & (kinds > 0)
            rest[open_ones[escaped]] += np.log10(kinds[escaped] / whole[escaped])
            kinds_above[open_ones], counts_above[open_ones] = level.kinds[context], level.below[context]
        return np.where(np.isnan(found), rest - np.log10(max(SYMBOLS - len(self.alphabet), 1)), found)

    def distributions(self, before: np.ndarray, reach: np.ndarray) -> np.ndarray:
        """log10 probabilities after some contexts: a column for each letter of the
        alphabet and one for any other symbol."""
        other = np.setdiff1d(np.arange(SYMBOLS), self.alphabet)[:1]
        letters = np.concatenate([self.alphabet, other if len(other) else [END_OF_TEXT]]).astype(np.int64)
        rows = np.repeat(np.arange(len(before)), len(letters))
        scores = self.score(before[rows], reach[rows], np.tile(letters, len(before)))
        return scores.reshape(len(before), len(letters))


def group_of(lang: Column) -> Column:
    """Group of the language of a row."""
    return (F.crc32(F.coalesce(lang.cast("string"), F.lit("")).cast("binary")) % F.lit(GROUPS)).cast("int")


def ask(rows: DataFrame, groups: list[int], across: bool) -> DataFrame:
    """(block, word, c) and (block, gram, c_<group>...) in one table: the different words
    of each block of documents and how often training documents have them; its different
    grams and how often training documents of each group have them."""
    row_of = {group: at for at, group in enumerate(groups)}

    def count(block: pa.Table) -> pa.Table:
        words, sequence, text = in_sequence(*tokens_of(block["text"].combine_chunks()), block.num_rows)
        group = np.array([row_of.get(one, 0) for one in block["grp"].to_pylist()], np.int64)
        group[block["held_out"].to_numpy()] = len(groups)
        grp = group[text]
        number, size = block["block"][0].as_py(), len(words)
        c = np.bincount(sequence[grp < len(groups)], minlength=size)
        kinds, parts = len(groups) + 1, []
        for grams, token in gram_parts(words, sequence, across):
            parts.append(run_lengths(np.sort(grams * kinds + grp[token])))
            if sum(len(keys) for keys, _ in parts[1:]) > len(parts[0][0]):
                parts = [together(parts)]
        keys, counts = together(parts)
        first = firsts_of(keys // kinds)
        grams, where = keys[first] // kinds, np.repeat(np.arange(len(first)), np.diff(first, append=len(keys)))
        sums = {}
        for g, at in row_of.items():
            own = keys % kinds == at
            sums[f"c_{g}"] = np.zeros(len(grams), np.int64)
            sums[f"c_{g}"][where[own]] = counts[own]
        return pa.concat_tables(
            [
                pa.table({"block": np.full(size, number, np.int64), "word": words, "c": c}),
                pa.table({"block": np.full(len(grams), number, np.int64), "gram": grams} | sums),
            ],
            promote_options="default",
        ).select(names)

    names = ["block", "word", "c", "gram", *(f"c_{group}" for group in groups)]
    columns = "".join(f", c_{group} LONG" for group in groups)
    return rows.groupBy("block").applyInArrow(count, f"block LONG, word STRING, c LONG, gram LONG{columns}")


def score_grams(grams: DataFrame, groups: list[int], across: bool) -> DataFrame:
    """(gram, s_<group>...) of the different grams (gram, c_<group>...), written before."""
    context = F.expr(f"gram div {SYMBOLS}")
    short = (context.bitwiseAND(F.lit(255)) * SYMBOLS + F.pmod("gram", F.lit(SYMBOLS))).alias("cell")
    sums = [F.sum(f"c_{group}").alias(f"c_{group}") for group in groups]
    after_one = grams.groupBy(short).agg(*sums).toArrow()  # at most 2 ** 8 * SYMBOLS rows
    cell = after_one["cell"].to_numpy()
    lowest = grams.sparkSession.sparkContext.broadcast(
        {
            g: {order: summed(cell if order else cell % SYMBOLS, after_one[f"c_{g}"].to_numpy()) for order in (0, 1)}
            for g in groups
        }
    )

    def score(bucket: pa.Table) -> pa.Table:
        gram = bucket["gram"].to_numpy()
        before, symbols = (gram // SYMBOLS).astype(np.uint64), gram % SYMBOLS
        reach, found = np.full(len(before), ORDER, np.int64) if across else reach_of(before), {}
        for group in groups:
            longer = cells_of(before, reach, symbols, bucket[f"c_{group}"].to_numpy(), DEALT_BYTES)
            trie = Trie.of(lowest.value[group] | longer)
            found[f"s_{group}"] = trie.score(before, reach, symbols).astype(np.float32)
        return pa.table({"gram": gram} | found)

    buckets = grams.count() // BUCKET_GRAMS + 1
    dealt = F.pmod(F.xxhash64(context.bitwiseAND(F.lit((1 << 8 * DEALT_BYTES) - 1))), F.lit(buckets))
    floats = "".join(f", s_{group} FLOAT" for group in groups)
    return grams.withColumn("bucket", dealt).groupBy("bucket").applyInArrow(score, f"gram LONG{floats}")


def mixed(scores: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """log10 of the means of the rows of 10 ** scores, weighted by shares."""
    weighted = scores + np.log10(shares)
    top = weighted.max(axis=1)
    return top + np.log10((10.0 ** (weighted - top[:, None])).sum(axis=1))


def score_documents(docs: DataFrame, across: bool = False) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    across: contexts run over the borders of words, as the query asks.

    Learns from the rows whose checksum of the id is not 0 modulo 10; rows without an id
    are learned from. Null is the empty text, which is only an end. Repeated rows are
    learned from as often as they occur. Without training rows every word is unknown and
    every symbol equally likely. Rows without a language are a language of their own.

    Documents are dealt into blocks by hash. Each block asks for the counts of its
    different words and the scores of its different grams, so no task holds the whole
    vocabulary. Blocks are added up in PASSES, so that disk holds the answers of one share.
    """
    scratch = Scratch(docs.sparkSession, "ppm")
    blocks = docs.count() // BLOCK_DOCUMENTS + 1
    rows = docs.select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).alias("block"),
        "doc_id",
        (id_remainder(F.col("doc_id"), 10) == 0).alias("held_out"),
        group_of(F.col("lang")).alias("grp"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    trained = {row["grp"]: row["count"] for row in rows.filter("NOT held_out").groupBy("grp").count().collect()}
    groups = sorted(trained) or [0]
    shares = np.array([trained.get(group, 1) for group in groups], float)
    shares /= shares.sum()

    asked = scratch.write(ask(rows, groups, across), "asked")
    asked_words = asked.filter("word IS NOT NULL").select("block", "word", "c")
    asked_grams = asked.filter("gram IS NOT NULL").drop("word", "c")
    words = scratch.write(asked_words.groupBy("word").agg(F.sum("c").alias("c")), "vocabulary")
    total = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.when(F.col("c") > 0, 1))).first()
    train_tokens, different = int(total[0]), int(total[1])
    sums = [F.sum(f"c_{group}").alias(f"c_{group}") for group in groups]
    grams = scratch.write(asked_grams.groupBy("gram").agg(*sums), "grams")
    scored = scratch.write(score_grams(grams, groups, across), "grams-scored")
    scratch.drop(grams)

    def add_up(texts: pa.Table, answers: pa.Table) -> pa.Table:
        known = answers.filter(pc.is_valid(answers["word"]))
        different_words, sequence, text = in_sequence(*tokens_of(texts["text"].combine_chunks()), texts.num_rows)
        at = pc.index_in(different_words, known["word"].combine_chunks()).to_numpy()[sequence]
        count = known["c"].to_numpy()
        base = np.log10((count + SMOOTH) / (train_tokens + SMOOTH * (different + 1)))
        added = lambda values: np.bincount(text, values[at], texts.num_rows)
        answers = answers.filter(pc.is_valid(answers["gram"])).sort_by("gram")
        gram, costs = answers["gram"].to_numpy(), [answers[f"s_{group}"].to_numpy() for group in groups]
        scores = np.zeros((texts.num_rows, len(groups)))
        for grams, token in gram_parts(different_words, sequence, across):
            first = int(text[token[0]])
            span = int(text[token[-1]]) - first + 1
            keys = np.sort(grams.astype(np.uint64) * span + (text[token] - first).astype(np.uint64))
            found = keys // span
            row = (keys - found * span).astype(np.int64)
            found, times = run_lengths(found)
            found = np.searchsorted(gram, found.astype(np.int64))
            for column, cost in enumerate(costs):
                spent = np.repeat(cost[found].astype(float), times)
                scores[first : first + span, column] += np.bincount(row, spent, span)
        columns = {
            "n_tokens": np.bincount(text, minlength=texts.num_rows),
            "n_known": added((count > 0).astype(float)).astype(np.int64),
            "base_score": added(base),
            "score": mixed(scores, shares),
        }
        return pa.table({"doc_id": texts["doc_id"], "held_out": texts["held_out"]} | columns)

    answers = asked_words.drop("c").join(words, "word").unionByName(
        asked_grams.select("block", "gram").join(scored, "gram"), allowMissingColumns=True
    )
    added = []
    for number in range(PASSES):
        own = F.pmod(F.col("block"), F.lit(PASSES)) == number
        asking = rows.filter(own).groupBy("block").cogroup(answers.filter(own).groupBy("block"))
        columns = "doc_id LONG, held_out BOOLEAN, n_tokens LONG, n_known LONG, base_score DOUBLE, score DOUBLE"
        added.append(scratch.write(asking.applyInArrow(add_up, columns), "added"))
    scratch.drop(asked, words, scored)
    return reduce(DataFrame.unionByName, added).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(train_tokens).cast("long").alias("train_tokens"),
        "base_score", "score",
    )


def op7_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read_table(spark, sf_dir, "documents"), across=True)
