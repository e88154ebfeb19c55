"""From raw documents to token counts: toxicity, exact and near duplicates, mixing, BPE.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame. It is written as Parquet
and read again as the input of the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidelog.llm import bpe, exact_index, pfair, ring_simhash, toxicity
from tidelog.llm.common import Scratch, read_table


#: Jaccard similarity of five-word shingles from which a text is a near copy.
NEAR_COPY = 0.8


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_index.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ring_simhash.drop_near_duplicates(docs, similarity=NEAR_COPY)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pfair.mixed_order(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("exact dedup", drop_exact_copies),
    ("simhash near dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: A trained classifier and byte-pair merges are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over ``documents``; the stages before it are written."""
    scratch = Scratch(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
