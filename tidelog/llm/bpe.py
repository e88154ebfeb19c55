"""Byte-pair encoding that guesses first and merges only where the guess is wrong.

A word is first cut greedily into the longest tokens. Two tokens may stand next to each
other if merging the bytes of both in the order of the ranks never joins bytes across
their border; a cut whose borders are all of that kind is the result of the merges.
Borders are tested for all words of a batch at once, each pair of tokens once. Words that
fail are merged step by step.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property
from itertools import chain

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import Scratch, read_table

#: Fixed value: how the vocabulary's texts are cut into words.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")
NEVER = np.iinfo(np.int32).max
#: Words whose ids a task keeps, words encoded at once, characters cut into words at once.
KNOWN_WORDS = 400_000
WORDS_AT_ONCE = 200_000
CHARACTERS_AT_ONCE = 1_000_000
#: Texts that a Python process holds at once, next to its vocabulary and known words.
TEXTS_AT_ONCE = 500
#: Longer words are merged one by one.
SHORT_WORD = 48


def byte_letters() -> dict[str, int]:
    """The byte that each character of a vocabulary file stands for: printable bytes
    stand for themselves, the others follow from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in plain]
    return {chr(byte): byte for byte in plain} | {chr(256 + at): byte for at, byte in enumerate(others)}


@dataclass
class Vocabulary:
    """tokens: bytes of each id. merges: (left id, right id, merged id) by rank.
    special: texts that are one token wherever they stand."""

    tokens: list[bytes]
    merges: np.ndarray
    special: dict[str, int] = field(default_factory=dict)

    @cached_property
    def ids(self) -> dict[bytes, int]:
        return {token: number for number, token in enumerate(self.tokens) if token not in self.special_bytes}

    @cached_property
    def special_bytes(self) -> set[bytes]:
        return {text.encode() for text in self.special}

    @cached_property
    def longest(self) -> int:
        return max(map(len, self.ids), default=1)

    @cached_property
    def ranks(self) -> dict[tuple[int, int], tuple[int, int]]:
        return {(int(a), int(b)): (rank, int(c)) for rank, (a, b, c) in enumerate(self.merges)}

    @cached_property
    def sorted_pairs(self) -> tuple[np.ndarray, np.ndarray]:
        keys = self.merges[:, 0].astype(np.int64) * len(self.tokens) + self.merges[:, 1]
        order = np.argsort(keys)
        return keys[order], order.astype(np.int32)

    @cached_property
    def edges(self) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """For the left and the right edge of every token, from the whole token down to
        one byte: the piece at that edge, -1 beyond, and the rank of the merge that ends
        the piece."""
        children = np.full((len(self.tokens), 2), -1, np.int32)
        made_at = np.full(len(self.tokens), NEVER, np.int32)
        children[self.merges[:, 2]] = self.merges[:, :2]
        made_at[self.merges[:, 2]] = np.arange(len(self.merges))
        found = []
        for side in (0, 1):
            piece = np.arange(len(self.tokens), dtype=np.int32)
            end = np.full(len(piece), NEVER, np.int32)
            pieces, ends = [], []
            while (piece >= 0).any():
                pieces.append(piece)
                ends.append(end)
                end = np.where(piece >= 0, made_at[piece], NEVER).astype(np.int32)
                piece = np.where(piece >= 0, children[piece, side], -1).astype(np.int32)
            found.append((np.stack(pieces), np.stack(ends)))
        return found[0], found[1]

    @cached_property
    def proposals(self) -> dict[bytes, int]:
        """Tokens that the merges of their own bytes give back, and all bytes."""
        return {
            token: number
            for token, number in self.ids.items()
            if len(token) == 1 or merged(token, self) == [number]
        }


def read_vocabulary(path: str) -> Vocabulary:
    """Vocabulary from a tokenizers file with a byte-level pair model."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    model, letters = content["model"], byte_letters()
    special = {added["content"]: added["id"] for added in content["added_tokens"]}
    count = max([*model["vocab"].values(), *special.values()]) + 1
    tokens = [b""] * count
    for token, number in model["vocab"].items():
        tokens[number] = bytes(letters[letter] for letter in token)
    for text, number in special.items():
        tokens[number] = text.encode()
    vocab = model["vocab"]
    pairs = [merge if isinstance(merge, list) else merge.split(" ") for merge in model["merges"]]
    merges = np.array([(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs], np.int32)
    return Vocabulary(tokens, merges, special)


def merged(word: bytes, vocabulary: Vocabulary) -> list[int]:
    """Ids of a word, merging the pair of the lowest rank, leftmost first, to the end.

    Waiting pairs lie in a heap, so a word of n bytes takes n log n steps.
    """
    ids, ranks = [vocabulary.ids[word[at : at + 1]] for at in range(len(word))], vocabulary.ranks
    after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
    waiting = []

    def offer(at: int) -> None:
        if 0 <= at and after[at] < len(ids):
            found = ranks.get((ids[at], ids[after[at]]))
            if found:
                heapq.heappush(waiting, (found[0], at, ids[at], ids[after[at]]))

    for at in range(len(ids)):
        offer(at)
    while waiting:
        rank, at, left, right = heapq.heappop(waiting)
        if ids[at] != left or after[at] >= len(ids) or ids[after[at]] != right:
            continue
        gone = after[at]
        ids[at], ids[gone] = ranks[left, right][1], -1
        after[at] = after[gone]
        if after[at] < len(ids):
            before[after[at]] = at
        offer(at)
        offer(before[at])
    return [number for number in ids if number >= 0]


def merged_together(cuts: list[bytes], vocabulary: Vocabulary) -> list[list[int]]:
    """What merged() gives for each of many short words, one merge of each at a time."""
    if not cuts:
        return []
    keys, ranks = vocabulary.sorted_pairs
    first = np.array([vocabulary.ids[bytes([byte])] for byte in range(256)], np.int64)
    ids = first[np.frombuffer(b"".join(cuts), np.uint8)]
    word = np.repeat(np.arange(len(cuts)), [len(cut) for cut in cuts])
    done: list[tuple[np.ndarray, np.ndarray]] = []
    while len(ids):
        wanted = ids[:-1] * len(vocabulary.tokens) + ids[1:]
        place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        joined = (keys[place] == wanted) & (word[:-1] == word[1:])
        rank = np.append(np.where(joined, ranks[place], NEVER), NEVER)
        starts = np.flatnonzero(np.diff(word, prepend=-1))
        lowest = np.minimum.reduceat(rank, starts)
        sizes = np.diff(starts, append=len(ids))
        over = np.repeat(lowest == NEVER, sizes)
        done.append((word[over], ids[over]))
        hits = np.flatnonzero((rank == np.repeat(lowest, sizes)) & ~over)
        hits = hits[np.diff(word[hits], prepend=-1) > 0]
        ids[hits] = vocabulary.merges[rank[hits], 2]
        stays = ~over
        stays[hits + 1] = False
        ids, word = ids[stays], word[stays]
    word = np.concatenate([part for part, _ in done])
    flat = np.concatenate([part for _, part in done])[np.argsort(word, kind="stable")].tolist()
    ends = np.cumsum(np.bincount(word, minlength=len(cuts))).tolist()
    return [flat[start:end] for start, end in zip([0, *ends], ends, strict=False)]


def longest_first(word: bytes, vocabulary: Vocabulary) -> list[int]:
    """Greedy guess: at each place the longest token that fits."""
    get, longest, size = vocabulary.proposals.get, vocabulary.longest, len(word)
    cut, at = [], 0
    while at < size:
        end = min(size, at + longest)
        number = get(word[at:end])
        while number is None:
            end -= 1
            number = get(word[at:end])
        cut.append(number)
        at = end
    return cut


def may_touch(left: np.ndarray, right: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """Whether no merge crosses the border of each pair of tokens.

    While its bytes are merged, the right edge of the left token is one of a chain of
    pieces, each until the merge that ends it, and so is the left edge of the right
    token. A merge of two such pieces crosses the border if it comes before both their
    ends. Of equal ranks the leftmost pair is merged first, so the end of the right
    token's piece is not in time, that of the left token's piece is.
    """
    (starts, start_ends), (tails, tail_ends) = vocabulary.edges
    keys, ranks = vocabulary.sorted_pairs
    fine = np.ones(len(left), bool)
    for tail, tail_end in zip(tails, tail_ends, strict=True):
        for start, start_end in zip(starts, start_ends, strict=True):
            a, b = tail[left], start[right]
            open_pairs = np.flatnonzero(fine & (a >= 0) & (b >= 0))
            if not len(open_pairs):
                continue
            wanted = a[open_pairs].astype(np.int64) * len(vocabulary.tokens) + b[open_pairs]
            place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            known = keys[place] == wanted
            rank = np.where(known, ranks[place], NEVER)
            crosses = known & (rank < tail_end[left][open_pairs]) & (rank <= start_end[right][open_pairs])
            fine[open_pairs[crosses]] = False
    return fine


class Encoder:
    """Encodes and decodes texts; keeps the ids of words and forgets them when many."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.known: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}
        self.pattern = regex.compile(WORD_PATTERN)
        names = "|".join(map(regex.escape, sorted(vocabulary.special, key=len, reverse=True)))
        self.special = regex.compile(f"({names})") if names else None
        self.guessed = self.failed = 0

    def learn(self, words: list[str]) -> None:
        """Encode new words: guess, test all borders at once, merge what fails."""
        vocabulary = self.vocabulary
        plain = [word.encode("utf-8", "replace") for word in words]
        cuts = [longest_first(word, vocabulary) for word in plain]
        wrong = self.with_wrong_borders(cuts)
        short = [number for number in wrong if len(plain[number]) <= SHORT_WORD]
        for number, ids in zip(short, merged_together([plain[n] for n in short], vocabulary), strict=True):
            cuts[number] = ids
        for number in set(wrong).difference(short):
            cuts[number] = merged(plain[number], vocabulary)
        self.guessed += len(words)
        self.failed += len(wrong)
        ends = np.cumsum([4 * len(cut) for cut in cuts]).tolist()
        flat = np.fromiter(chain.from_iterable(cuts), "<u4").tobytes()
        self.known.update(
            (word, flat[start:end]) for word, start, end in zip(words, [0, *ends], ends, strict=False)
        )

    def with_wrong_borders(self, cuts: list[list[int]]) -> list[int]:
        """Numbers of the cuts that have a border where a merge crosses."""
        count = len(self.vocabulary.tokens)
        flat = np.fromiter(chain.from_iterable(cuts), np.int64)
        owner = np.repeat(np.arange(len(cuts)), [len(cut) for cut in cuts])
        inner = np.flatnonzero(owner[:-1] == owner[1:])
        unique, where = np.unique(flat[inner] * count + flat[inner + 1], return_inverse=True)
        if not len(unique):
            return []
        if len(self.pairs) > KNOWN_WORDS:
            self.pairs.clear()
        new = np.array([key for key in unique.tolist() if key not in self.pairs], np.int64)
        if len(new):
            left, right = np.divmod(new, count)
            self.pairs.update(zip(new.tolist(), may_touch(left, right, self.vocabulary).tolist(), strict=True))
        fine = np.fromiter((self.pairs[key] for key in unique.tolist()), bool, len(unique))
        return np.unique(owner[inner[~fine[where]]]).tolist()

    def cut(self, text: str) -> Iterator[list[str | int]]:
        """Words of a text, some at a time; special tokens as their ids.

        Long texts are cut before a lone space between two other characters, where a
        word begins in any case.
        """
        for part in self.special.split(text) if self.special else [text]:
            number = self.vocabulary.special.get(part)
            if number is not None:
                yield [number]
                continue
            start = 0
            while start < len(part):
                border = LONE_SPACE.search(part, start + CHARACTERS_AT_ONCE)
                end = border.start() if border else len(part)
                yield self.pattern.findall(part, start, end) if start or border else self.pattern.findall(part)
                start = end

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        waiting: list[tuple[list[str | int], bool]] = []
        begun: list[bytes] = []
        held = 0
        for text in texts:
            for parts in self.cut(text):
                waiting.append((parts, False))
                held += len(parts)
                if held >= WORDS_AT_ONCE:
                    yield from self.finish(waiting, begun)
                    held = 0
            waiting.append(([], True))
        yield from self.finish(waiting, begun)

    def finish(self, waiting: list[tuple[list[str | int], bool]], begun: list[bytes]) -> Iterator[bytes]:
        """Ids of the texts that end among the waiting words; begun: the text before."""
        wanted = dict.fromkeys(chain.from_iterable(parts for parts, _ in waiting))
        words = [word for word in wanted if isinstance(word, str)]
        new = [word for word in words if word not in self.known]
        if len(self.known) + len(new) > KNOWN_WORDS:
            self.known.clear()
            new = words
        self.learn(new)
        specials = {number: np.array([number], "<u4").tobytes() for number in wanted if isinstance(number, int)}
        find = (self.known | specials).__getitem__ if specials else self.known.__getitem__
        for parts, ends in waiting:
            begun.append(b"".join(map(find, parts)))
            if ends:
                yield b"".join(begun)
                begun.clear()
        waiting.clear()

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no UTF-8 become the replacement character."""
        token = self.vocabulary.tokens.__getitem__
        return b"".join(map(token, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encoded_column(spark: SparkSession, vocabulary: Vocabulary, text: Column) -> Column:
    """Ids of a text column, as binary; null is the empty text."""
    shared = spark.sparkContext.broadcast(vocabulary)  # the size of the vocabulary file

    @F.pandas_udf("binary")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder(shared.value)
        for texts in batches:
            yield pd.Series(list(encoder.encode([text or "" for text in texts])), dtype=object)

    return encode(text)


def decoded_column(spark: SparkSession, vocabulary: Vocabulary, ids: Column) -> Column:
    """Text of a binary column of ids."""
    shared = spark.sparkContext.broadcast(vocabulary)

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder(shared.value)
        for values in batches:
            yield pd.Series([encoder.decode(value or b"") for value in values], dtype=object)

    return decode(ids)


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids) for every row of ``docs``; ids: little-endian unsigned 32-bit.

    Null and empty texts have no ids. Repeated rows give repeated results.
    """
    vocabulary = read_vocabulary(path or tokenizer_path())
    return docs.select(
        "doc_id", encoded_column(docs.sparkSession, vocabulary, F.col("text")).alias("ids")
    )


def round_trip_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) for every row of ``docs``.

    The ids of a text are hashed where they are made; they are decoded from the ids, not
    from the words that were encoded. The digests are written once, so that texts go to
    Python in small batches whatever the session's setting is.
    """
    spark = docs.sparkSession
    vocabulary = read_vocabulary(path or tokenizer_path())
    shared = spark.sparkContext.broadcast(vocabulary)
    sha256 = lambda content: hashlib.sha256(content).hexdigest()

    @F.pandas_udf("n_tokens LONG, ids_sha256 STRING, decoded_sha256 STRING")
    def digests(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(shared.value)
        for texts in batches:
            rows = []
            for ids in encoder.encode([text or "" for text in texts]):
                decoded = encoder.decode(ids).encode("utf-8", "replace")
                rows.append((len(ids) // 4, sha256(ids), sha256(decoded)))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    found = docs.select("doc_id", digests(F.col("text")).alias("found")).select("doc_id", "found.*")
    return Scratch(spark, "bpe").write(found, "digests", TEXTS_AT_ONCE)


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip_digests(read_table(spark, sf_dir, "documents"))
