from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

COLUMNS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that the operators use themselves
        *[T.StructField(name, T.LongType()) for name in ("key", "entry", "block", "score", "fingerprint", "slot", "doc")],
    ]
)


@pytest.fixture
def docs_of(spark):
    def make(rows):
        full = [(i, text, lang, source, len(text or ""), *[7] * 7) for i, text, lang, source in rows]
        return spark.createDataFrame(full, COLUMNS)

    return make


@pytest.fixture(scope="session")
def labels_of(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id LONG, quality INT, toxic INT")


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    parts = ["ba", "do", "ri", "mel", "ton", "ka", "su", "fen"]
    common = ["the", "of", "and", "to", "is"]
    out = []
    for at in range(words):
        out.append(draw.choice(common) if at % 3 == 0 else "".join(draw.choices(parts, k=draw.randint(2, 4))))
        if at % 11 == 10:
            out.append("\n")
    return " ".join(out)


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty, blank and very long texts, copies, near copies,
    repeated rows and repeated ids."""
    base = prose(1, 120)
    near = base.replace("the", "then", 1)
    return [
        (1, base, "en", "a"),
        (2, base, "en", "a"),
        (2, base, "en", "a"),
        (3, near, "en", "b"),
        (4, base.replace(" ", "  \t"), "de", "a"),
        (5, "", "en", "b"),
        (6, " \n\t", None, None),
        (7, None, "fr", "a"),
        (None, base, "en", "a"),
        (None, None, None, None),
        (8, prose(2, 30_000), "en", "a"),
        (9, prose(3, 40), "fr", "c"),
        (9, prose(4, 40), "fr", "c"),
        (10, "The end.", "en", "c"),
        (11, "x" * 3000, "en", "c"),
        (12, "Émile İ   日本語 <|endoftext|> 😀", "es", "b"),
    ]
