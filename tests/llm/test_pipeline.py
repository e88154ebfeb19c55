"""The pipeline stage by stage against brute force on a small fixture."""

from __future__ import annotations

import random
import re

import pandas as pd
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import prose
from tests.llm.test_duplicates import roots_of, simhash
from tidelog.llm import bpe, pfair, ring_simhash, shingle_join
from tidelog.llm.common import BATCH_ROWS, CLEAN_UP, Scratch


def test_stages_take_effect(spark, docs_of, labels_of, odd_rows, tmp_path):
    texts = [prose(2000 + n, 60).replace(" of ", " zblorgish ", 3 * (n % 3 == 0)) for n in range(240)]
    rows = odd_rows + [(100 + n, text, "en", "a") for n, text in enumerate(texts)]
    docs = docs_of(rows)
    labels_of([(100 + n, 1, int(n % 3 == 0)) for n in range(240)]).write.parquet(str(tmp_path / "labels.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))

    now, seen = docs, [docs.count()]
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, str(tmp_path))
        out.write.parquet(str(tmp_path / f"stage-{number}"))
        now = spark.read.parquet(str(tmp_path / f"stage-{number}"))
        if number < len(corpus_pipeline.STAGES) - 1:
            assert now.columns == docs.columns, name
        seen.append(now.count())
        kept = [row.text for row in now.select("text").collect()] if "text" in now.columns else []
        if name == "toxicity":
            clean = {100 + n for n in range(240) if n % 3}
            left = {row.doc_id for row in now.select("doc_id").collect()}
            assert len(clean - left) <= 8 and len({100 + n for n in range(0, 240, 3)} & left) <= 8
        if name == "exact dedup":
            plain = [re.sub(r"[\x20\x09-\x0D]+", " ", text or "") for text in kept]
            assert len(plain) == len(set(plain))
        if name == "simhash near dedup":
            prints = [simhash(text) for text in kept]
            assert all((a ^ b).bit_count() > 4 for at, a in enumerate(prints) for b in prints[:at])
    assert seen[1] < seen[0] and seen[2] < seen[1] and seen[3] <= seen[2] and seen[5] == seen[4] == seen[3]

    result = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(tuple, result.collect()), key=repr) == sorted(map(tuple, now.collect()), key=repr)


def test_near_copies_beyond_the_fingerprint_bits_go(spark, docs_of, odd_rows):
    draw, rows = random.Random(7), odd_rows[:8] + odd_rows[9:11]
    for group in range(12):
        base = prose(500 + group, 90).split(" ")
        for copy in range(5):
            words = list(base)
            for _ in range(copy):
                words[draw.randrange(len(words))] = f"changed{draw.random()}"
            rows.append((100 * group + 50 + copy if copy < 4 else None, " ".join(words), "en", "a"))
    order = sorted(rows, key=lambda row: (row[0] is None, row[0] or 0))
    found = corpus_pipeline.drop_near_copies(spark, docs_of(rows), "").collect()
    first = ring_simhash.drop_near_duplicates(docs_of(rows)).collect()
    left = {(row.doc_id, row.text) for row in first}
    sets = [(row[:2], shingle_join.shingle_set(row[1])) for row in order if row[:2] in left]
    alike = lambda a, b: (len(a & b) / len(a | b) if a | b else 1) >= 0.8
    links = [(a, b) for b in range(len(sets)) for a in range(b) if alike(sets[a][1], sets[b][1])]
    roots = roots_of(range(len(sets)), links)
    expected = [row for at, (row, _) in enumerate(sets) if roots[at] == at]
    assert sorted(((row.doc_id, row.text) for row in found), key=repr) == sorted(expected, key=repr)
    assert len(expected) < len(first)


def test_a_large_group_of_near_copies_gives_few_pairs(spark, docs_of, monkeypatch):
    """Copies link to the first of a band, not to each other."""
    draw, base = random.Random(3), prose(77, 150).split(" ")
    rows = [(n, prose(3000 + n, 60), "en", "a") for n in range(40)]
    for copy in range(400):
        words = list(base)
        for _ in range(2 * (copy > 0)):
            words[draw.randrange(len(words))] = f"changed{draw.random()}"
        rows.append((1000 + copy, " ".join(words), "en", "a"))
    compared = []
    verify = shingle_join.similar_pairs

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return verify(pairs, *rest)

    monkeypatch.setattr(shingle_join, "similar_pairs", counted)
    kept = {row.doc_id for row in corpus_pipeline.drop_near_copies(spark, docs_of(rows), "").collect()}
    assert set(range(40)) <= kept and len(kept) < 45
    assert sum(compared) < 3 * 400


def test_every_row_has_a_slot_of_its_own(spark, docs_of):
    """Rows that repeat an id, or have none, are mixed like all others."""
    rows = [(1, f"one {n}", "en", "ab"[n % 2]) for n in range(60)] + [(None, f"none {n}", "en", "a") for n in range(60)]
    rows += [(100 + n, f"own {n}", "en", "b") for n in range(200)]
    docs = docs_of(rows)
    mixed = [row.text for row in corpus_pipeline.mix_sources(spark, docs, "").collect()]
    assert sorted(mixed) == sorted(row[1] for row in rows)
    slots = pfair.mix(docs).collect()
    assert len({(row.slot, row.place_in_block) for row in slots}) == len(rows)
    source = {row[1]: row[3] for row in rows}
    order = [source[text] for text in mixed]
    expected = [row.source for row in sorted(slots, key=lambda row: (row.slot, row.place_in_block))]
    assert order == expected


def test_scratch_sends_small_batches_and_restores_the_settings(spark):
    @F.pandas_udf("long")
    def batch(numbers: pd.Series) -> pd.Series:
        return pd.Series([len(numbers)] * len(numbers))

    settings = [CLEAN_UP, BATCH_ROWS]
    before = [spark.conf.get(key, None) for key in settings]
    table = spark.range(0, 100, 1, 1).select(batch("id").alias("n"))
    assert Scratch(spark, "batches").write(table, "small", 7).agg(F.max("n")).first()[0] == 7
    assert [spark.conf.get(key, None) for key in settings] == before


def test_texts_of_the_last_stage_go_to_python_in_small_batches(spark, docs_of, monkeypatch):
    class Watched(bpe.Encoder):
        def encode(self, texts):
            assert len(texts) <= 500
            return super().encode(texts)

    monkeypatch.setattr(bpe, "Encoder", Watched)
    rows = docs_of([(number, f"text {number}", "en", "a") for number in range(1200)]).coalesce(1)
    assert len(corpus_pipeline.encode(spark, rows, "").collect()) == 1200


def test_pairs_of_texts_go_to_python_in_small_batches(spark):
    class Watched(Scratch):
        def write(self, table, name, rows_at_once=None):
            batches[name] = rows_at_once
            return super().write(table, name, rows_at_once)

    batches = {}
    texts = spark.createDataFrame([(number, "a b c d e f") for number in range(4)], "entry LONG, text STRING")
    pairs = texts.filter("entry > 0").select("entry", F.lit(0).cast("long").alias("to_entry"))
    assert shingle_join.similar_pairs(pairs, texts, Watched(spark, "watched"), 0.8).count() == 3
    assert batches["similar"] <= 500
