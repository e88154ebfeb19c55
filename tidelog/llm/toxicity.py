"""Toxicity scores from bags of subwords.

A word is the mean of the vectors of its character n-grams, a segment of a text the mean
of its words (short segments are filled up with zero vectors, so that few words are
little evidence), and a linear softmax turns a segment into the odds of being toxic. N-gram
vectors and softmax are trained together, so an unseen spelling gets the score of the
n-grams that it shares with known words. A text is as toxic as its worst segment, and in
training only that segment passes its error on: insults are not thinned out by the rest
of a long text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import id_remainder, read_table

REJECT_FROM = 0.3
ENOUGH_TO_SCALE = 20
#: Rows of the n-gram table that a training step moves at once.
ROWS_AT_ONCE = 1 << 14
NO_LETTERS = re.compile(r"[^\w\s]+|_+")


@dataclass(frozen=True)
class Settings:
    """buckets: rows of the n-gram table. per_class, longest: at most so many labelled
    documents of each class are used to fit, of at most so many characters each."""

    buckets: int = 1 << 18
    size: int = 8
    shortest_gram: int = 3
    longest_gram: int = 6
    segment: int = 24
    per_class: int = 2400
    longest: int = 12_000
    steps: int = 100
    rate: float = 0.05
    decay: float = 2e-5
    seed: int = 7


@dataclass
class Model:
    vectors: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    settings: Settings

    def gram_scores(self) -> np.ndarray:
        """What each n-gram adds to the log odds. All is linear up to the softmax, so
        scoring needs only this number of each n-gram."""
        return (self.vectors @ (self.weights[:, 1] - self.weights[:, 0])).astype(np.float32)


def bare_words(text: str | None) -> list[str]:
    """Lower-case words without punctuation."""
    return NO_LETTERS.sub("", (text or "").lower()).split()


def grams_of(words: list[str], settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of all n-grams of all words, and for each the number of its word.

    Every word is put between < and >; n-grams are found for all words at once, with a
    rolling hash over code points.
    """
    marked = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), "<u4")
    word = np.cumsum(marked == ord("<"), dtype=np.int32) - 1
    letters = marked.astype(np.uint64)
    rows, owners, rolled = [], [], letters
    for size in range(2, settings.longest_gram + 1):
        rolled = rolled[:-1] * np.uint64(0x100000001B3) + letters[size - 1 :]
        if size >= settings.shortest_gram:
            inside = word[: len(rolled)] == word[size - 1 :]
            mixed = (rolled[inside] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
            rows.append((mixed % np.uint64(settings.buckets)).astype(np.int32))
            owners.append(word[: len(rolled)][inside])
    return np.concatenate(rows), np.concatenate(owners)


def segment_sizes_of(count: int, size: int) -> list[int]:
    """Words in each segment of a text of ``count`` words; a text has at least one."""
    full, rest = divmod(count, size)
    return [size] * full + ([rest] if rest or not full else [])


def fit(texts: list[str], toxic: list[int], weights: list[float], settings: Settings) -> Model:
    """Train n-gram vectors and softmax jointly, with Adam over the whole sample.

    weights: how much each text counts, to give back the share of toxic texts that the
    sample has changed. One text in five is kept from training and sets the scale of the
    log odds, if it has enough of both classes. Without both classes every text gets the share of its class.
    """
    rng = np.random.default_rng(settings.seed)
    vectors = rng.normal(0, 0.1, (settings.buckets, settings.size))
    softmax, bias = rng.normal(0, 0.1, (settings.size, 2)), np.zeros(2)
    if len(set(toxic)) < 2:
        bias[:] = (0, 9) if any(toxic) else (9, 0)
        return Model(vectors * 0, softmax * 0, bias, settings)

    known: dict[str, int] = {}
    tokens, sizes, owners = [], [], []
    for number, text in enumerate(texts):
        words = bare_words(text)
        tokens.extend(known.setdefault(word, len(known)) for word in words)
        own = segment_sizes_of(len(words), settings.segment)
        sizes.extend(own)
        owners.extend([number] * len(own))
    grams, word_of_gram = grams_of(list(known), settings)
    gram_counts = np.maximum(np.bincount(word_of_gram, minlength=len(known)), 1)
    tokens, sizes, owners = np.array(tokens, np.int32), np.array(sizes), np.array(owners)
    segment_of_token = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    first_of_text = np.flatnonzero(np.diff(owners, prepend=-1))
    truth, counts = np.array(toxic, float), np.array(weights, float)
    kept_out = np.arange(len(texts)) % 5 == 4
    in_training = np.where(kept_out, 0, counts)
    in_training = in_training / in_training.sum()

    def worst_segments() -> tuple[np.ndarray, np.ndarray]:
        by_gram = (vectors @ (softmax[:, 1] - softmax[:, 0]))[grams]
        by_word = np.bincount(word_of_gram, by_gram, len(known)) / gram_counts
        by_segment = np.bincount(segment_of_token, by_word[tokens], len(sizes)) / settings.segment
        top = np.maximum.reduceat(by_segment, first_of_text)
        return top, np.lexsort((-by_segment, owners))[first_of_text]

    moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (vectors, softmax, bias)]
    for step in range(1, settings.steps + 1):
        top, worst = worst_segments()
        odds = top + bias[1] - bias[0]
        error = (1 / (1 + np.exp(-np.clip(odds, -30, 30))) - truth) * in_training

        share = np.zeros(len(sizes))
        share[worst] = error / settings.segment
        to_words = np.bincount(tokens, share[segment_of_token], len(known)) / gram_counts
        to_grams = np.bincount(grams, to_words[word_of_gram], settings.buckets)
        slope, down = softmax[:, 1] - softmax[:, 0], vectors.T @ to_grams
        for start in range(0, settings.buckets, ROWS_AT_ONCE):
            some = slice(start, start + ROWS_AT_ONCE)
            found = np.outer(to_grams[some], slope) + settings.decay * vectors[some]
            move(vectors[some], found, [moment[some] for moment in moments[0]], step, settings.rate)
        move(softmax, np.stack([-down, down], 1) + settings.decay * softmax, moments[1], step, settings.rate)
        move(bias, np.array([-error.sum(), error.sum()]), moments[2], step, settings.rate)
    top, _ = worst_segments()
    if min(truth[kept_out].sum(), (1 - truth[kept_out]).sum()) >= ENOUGH_TO_SCALE:
        factor, shift = scale_of_odds(top[kept_out], truth[kept_out], counts[kept_out])
        softmax *= factor
        bias[:] = (0, shift)
    return Model(vectors, softmax, bias, settings)


def move(values: np.ndarray, slope: np.ndarray, moments: list[np.ndarray], step: int, rate: float) -> None:
    """One step of Adam, in place."""
    first, second = moments
    first += 0.1 * (slope - first)
    second += 0.01 * (slope**2 - second)
    mean, spread = first / (1 - 0.9**step), second / (1 - 0.99**step)
    values -= rate * mean / (np.sqrt(spread) + 1e-9)


def scale_of_odds(scores: np.ndarray, truth: np.ndarray, counts: np.ndarray) -> tuple[float, float]:
    """Factor and shift that turn scores into log odds, by Newton steps."""
    center, spread = scores.mean(), scores.std() + 1e-9
    inputs = np.stack([(scores - center) / spread, np.ones(len(scores))])
    found, prior = np.array([1.0, 0.0]), np.diag([1e-2, 1e-2]) * counts.mean()
    for _ in range(50):
        odds = 1 / (1 + np.exp(-np.clip(found @ inputs, -30, 30)))
        slope = inputs @ ((odds - truth) * counts) + prior @ found
        bend = (inputs * (odds * (1 - odds) * counts)) @ inputs.T + prior
        found = found - np.linalg.solve(bend, slope)
    factor = max(found[0], 1e-3) / spread
    return factor, found[1] - factor * center


def fit_on_labels(docs: DataFrame, labels: DataFrame, settings: Settings) -> Model:
    """Fit on a bounded sample of the labelled documents outside the held-out part.

    The sample is at most ``per_class`` documents of each class, taken by a hash of the
    id, of at most ``longest`` characters. Documents with several labels are toxic if one
    label says so; rows without id, text or label are not used.
    """
    spark = docs.sparkSession
    usable = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .filter(id_remainder(F.col("doc_id"), 4) != 2)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    totals = {row["toxic"]: row["count"] for row in usable.filter("toxic IN (0, 1)").groupBy("toxic").count().collect()}
    wanted = [
        usable.filter(F.col("toxic") == kind)
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(settings.per_class)
        for kind in (0, 1)
    ]
    sample = wanted[0].unionByName(wanted[1])  # at most 2 * per_class ids
    rows = (
        docs.select("doc_id", "text")
        .filter(F.length("text") <= settings.longest)
        .join(F.broadcast(sample), "doc_id")
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
        .orderBy("doc_id")
        .collect()
    )
    used = {kind: max(1, sum(row["toxic"] == kind for row in rows)) for kind in (0, 1)}
    weights = [totals[row["toxic"]] / used[row["toxic"]] for row in rows]
    return fit([row["text"] for row in rows], [row["toxic"] for row in rows], weights, settings)


#: Words that are scored at once; longer texts are cut between segments.
WORDS_AT_ONCE = 96_000


def worst_of(texts: list[str | None], gram_scores: np.ndarray, settings: Settings) -> np.ndarray:
    """Log odds of the worst segment of each text, without the bias."""
    worst = np.full(len(texts), -np.inf)
    words, sizes, owners = [], [], []

    def score_them() -> None:
        if words:
            grams, owner = grams_of(words, settings)
            by_word = np.bincount(owner, gram_scores[grams], len(words))
            by_word /= np.maximum(np.bincount(owner, minlength=len(words)), 1)
            sums = np.concatenate([[0.0], np.cumsum(by_word)])
            ends = np.cumsum(sizes)
            means = (sums[ends] - sums[ends - sizes]) / settings.segment
            np.maximum.at(worst, owners, means)
        words.clear(), sizes.clear(), owners.clear()

    for number, text in enumerate(texts):
        own = bare_words(text)
        if not own:
            worst[number] = 0.0
        for at in range(0, len(own), WORDS_AT_ONCE):
            part = own[at : at + WORDS_AT_ONCE]
            words.extend(part)
            segments = segment_sizes_of(len(part), settings.segment)
            sizes.extend(segments)
            owners.extend([number] * len(segments))
            if len(words) >= WORDS_AT_ONCE:
                score_them()
    score_them()
    return worst


def score_column(spark: SparkSession, model: Model, text: Column) -> Column:
    """Score of a text column; null and empty texts get the score of no words."""
    shared = spark.sparkContext.broadcast(model.gram_scores())  # 4 bytes a bucket
    bias, settings = float(model.bias[1] - model.bias[0]), model.settings

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            odds = worst_of(texts.tolist(), shared.value, settings) + bias
            yield pd.Series(1 / (1 + np.exp(-np.clip(odds, -500, 500))))

    return score(text)


def score_documents(docs: DataFrame, labels: DataFrame, settings: Settings | None = None) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Empty and null texts are scored as texts without words. Rows without an id are never
    held out and never used to fit. Repeated rows give repeated results.
    """
    model = fit_on_labels(docs, labels, settings or Settings())
    score = score_column(docs.sparkSession, model, F.col("text"))
    held_out = id_remainder(F.col("doc_id"), 4) == 2
    return docs.select("doc_id", held_out.alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= REJECT_FROM).cast("int")
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, settings: Settings | None = None) -> DataFrame:
    """The rows of ``docs`` that are not predicted to be toxic, all columns as they are."""
    model = fit_on_labels(docs, labels, settings or Settings())
    return docs.filter(score_column(docs.sparkSession, model, F.col("text")) < REJECT_FROM)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
