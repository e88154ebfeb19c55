"""Ranked search, packing and target draws against brute force and on odd rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

from tests.llm.conftest import prose
from tidelog.llm import bag_search, bpe, packing, target_draw
from tidelog.llm.common import LOWER_AZ

QUICK = packing.Search(islands=3, epochs=2, generations=4, population=4)


@pytest.fixture
def queries_of(spark):
    columns = "item_id LONG, text STRING, doc_id LONG, score LONG, block LONG"
    return lambda rows: spark.createDataFrame([(*row, 7, 7, 7) for row in rows], columns)


ITEMS = [
    (1, prose(1, 20)),
    (1, prose(1, 20)),
    (1, prose(2, 12)),
    (2, "the THE the end. Émile 日本語"),
    (None, prose(3, 30)),
    (3, None),
    (4, ""),
    (5, "!?"),
    (6, "nowhere-to-be-found"),
    (7, "x" * 3000),
]


def searched(rows, items, top=10):
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    bags = [Counter(term.findall((row[1] or "").translate(LOWER_AZ))) for row in rows]
    n_docs, n_terms = sum(map(bool, bags)), sum(bag.total() for bag in bags)
    df = Counter(word for bag in bags for word in bag)
    found = []
    for item_id, text in dict.fromkeys(items):
        wanted = set(term.findall((text or "").translate(LOWER_AZ)))
        scores = []
        for row, bag in zip(rows, bags, strict=True):
            m = 10 + (90 * bag.total() * n_docs) // n_terms if n_terms else 10
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[word] + 1)))
                * (1_000_000_000 * bag[word] // (1000 * bag[word] + 8 * m))
                for word in wanted & bag.keys()
            )
            if score > 0:
                scores.append((-score, row[0] is None, row[0] or 0))
        for rank, (score, none, doc_id) in enumerate(sorted(scores)[:top], 1):
            found.append((item_id, rank, None if none else doc_id, -score))
    return sorted(found, key=repr)


def many_copies(odd_rows):
    """A group of 60 copies, ties between texts, and words that most rows have."""
    return odd_rows + [(400 - n, prose(4, 25), "en", "a") for n in range(60)] + [
        (500 + n, prose(50 + n % 40, 30) + " the end", "en", "a") for n in range(120)
    ]


@pytest.mark.parametrize("at_once", [None, 20])
def test_search_equals_brute_force(docs_of, queries_of, odd_rows, monkeypatch, at_once):
    if at_once:  # several blocks of items
        monkeypatch.setattr(bag_search, "TERMS_AT_ONCE", at_once)
    rows = many_copies(odd_rows)
    found = bag_search.search(docs_of(rows), queries_of(ITEMS))
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=repr) == searched(rows, ITEMS)


def test_a_class_is_scored_once_and_told_apart(spark, docs_of, queries_of, odd_rows):
    rows = many_copies(odd_rows)
    items = bag_search.items_of(queries_of(ITEMS), bag_search.Scratch(spark, "test"))
    block = bag_search.read_block(items)
    table = bag_search.classes(bag_search.bags(docs_of(rows), block), 200, 9000, bag_search.Ranking()).collect()
    assert len(table) == len({(bytes(row.bag), row.m) for row in table}) < len(rows) - 50
    assert max(len(row.members) for row in table) == 10
    assert [300 + n for n in range(41, 51)] in [row.members for row in table]


def test_search_in_empty_tables(docs_of, queries_of, odd_rows):
    assert bag_search.search(docs_of([]), queries_of(ITEMS)).count() == 0
    assert bag_search.search(docs_of(odd_rows), queries_of([])).count() == 0
    assert bag_search.search(docs_of([(1, None, "en", "a")]), queries_of([(1, "!"), (2, None)])).count() == 0


def test_terms_of_long_texts(monkeypatch):
    text = prose(9, 500) + " x" * 40 + "y" * 300
    whole = [term for terms in bag_search.terms_of(text) for term in terms]
    monkeypatch.setattr(bag_search, "CHARACTERS_AT_ONCE", 50)
    assert [term for terms in bag_search.terms_of(text) for term in terms] == whole


def pieces_and_sequences(found):
    by_sequence = {}
    for row in found:
        by_sequence.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    pieces = [(row.doc_id, row.piece, row.start, row.length, row.ids_crc32) for row in found]
    return sorted(pieces, key=repr), len(by_sequence)


def test_packing_holds_every_piece_once(docs_of, odd_rows, monkeypatch):
    monkeypatch.setattr(packing, "LONG_TEXT", 20_000)
    rows = odd_rows + [(100 + n, prose(n, 30 * n % 700), "en", "a") for n in range(60)]
    rows += [(200 + n, "", "en", "a") for n in range(300)]
    found, count = pieces_and_sequences(packing.pack(docs_of(rows), search=QUICK).collect())
    tokenizer = Tokenizer.from_file(bpe.tokenizer_path())
    expected, total = [], 0
    for doc_id, text, *_ in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        start, total = 0, total + len(ids)
        for piece in range(-(-len(ids) // 2048)):
            end = len(ids) - 2048 * (-(-len(ids) // 2048) - piece - 1)
            expected.append((doc_id, piece, start, end - start, zlib.crc32(ids[start:end].tobytes())))
            start = end
    assert found == sorted(expected, key=repr)
    assert count <= -(-total // 2048) + 1


def test_packing_of_an_empty_table(docs_of):
    found = packing.pack(docs_of([]), search=QUICK)
    assert found.count() == 0 and "sequence_id" in found.columns


def held(made):
    return Counter({n: c for n, c in sum((Counter({n: c * t for n, c in p}) for p, t in made.items()), Counter()).items()})


def random_lengths(draw, least, most, pieces):
    return Counter(draw.randint(least, most) for _ in range(pieces))


@pytest.mark.parametrize("least, most", [(1, 2048), (400, 1000), (1, 40), (700, 1100)])
def test_children_hold_what_their_parents_hold(least, most):
    draw = random.Random(least)
    lengths = random_lengths(draw, least, most, 3000)
    parents = [packing.first_packing(lengths, 2048, draw, exact) for exact in (0.0, 0.4, 0.9)]
    children = [packing.crossover(a, b, 2048, draw) for a in parents for b in parents]
    children += [packing.mutated(child, 2048, draw) for child in children]
    for made in parents + children:
        assert held(made) == lengths
        assert all(packing.filled(pattern) <= 2048 for pattern in made)
        assert packing.reread(packing.written(made)) == made


def test_best_fit_equals_one_piece_at_a_time():
    draw = random.Random(5)
    for _ in range(30):
        lengths = random_lengths(draw, 1, 90, draw.randint(1, 200))
        bins: list[int] = []
        for length in sorted(lengths.elements(), reverse=True):
            fits = [at for at, used in enumerate(bins) if used + length <= 100]
            if fits:
                bins[max(fits, key=bins.__getitem__)] += length
            else:
                bins.append(length)
        assert packing.sequences(packing.best_fit({}, lengths, 100)) == len(bins)


def test_generations_find_smaller_packings():
    draw = random.Random(3)
    lengths = random_lengths(draw, 400, 1000, 5000)
    first = packing.best_fit({}, lengths, 2048)
    after = packing.evolve(lengths, [first], 2048, packing.Search(generations=12), draw)[0]
    assert held(after) == lengths
    least = packing.fewest(lengths, 2048)
    assert packing.sequences(after) - least < 0.6 * (packing.sequences(first) - least)


def test_islands_trade_packings(spark):
    lengths = random_lengths(random.Random(8), 400, 1000, 2000)
    made = packing.best_packing(spark, lengths, 2048, QUICK)
    assert held(made) == lengths
    assert packing.sequences(made) < packing.sequences(packing.best_fit({}, lengths, 2048))


def test_tokens_of_texts_with_long_words():
    tokens = packing.Tokens(bpe.read_vocabulary(bpe.tokenizer_path()))
    tokenizer = Tokenizer.from_file(bpe.tokenizer_path())
    for text in ("x" * 20_000, " " * 20_000, "a\n  b\t  c", "é" * 9_000, "<|endoftext|> <|endoftext", "!?" * 9_000):
        assert tokens.of(text).tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 0]


def drawn(rows, items, draw):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def features(text):
        words = word.findall((text or "").translate(LOWER_AZ))
        runs = [" ".join(words[at : at + n]) for n in range(1, draw.longest + 1) for at in range(len(words) - n + 1)]
        return words, Counter(zlib.crc32(run.encode()) % draw.buckets for run in runs)

    target = sum((features(text)[1] for _, text in items), Counter())
    raw = sum((features(row[1])[1] for row in rows), Counter())
    t, s = target.total() + draw.buckets, raw.total() + draw.buckets
    gain = {b: math.floor(1000 * math.log((target[b] + 1) * s / ((raw[b] + 1) * t))) for b in raw}
    out = []
    for doc_id, text, *_ in rows:
        words, held_buckets = features(text)
        weight = sum(gain[b] * n for b, n in held_buckets.items())
        name = f"{draw.seed}:{'' if doc_id is None else doc_id}"
        h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((doc_id, held_buckets.total(), weight, score, len(words) >= draw.min_words))
    eligible = sorted((row for row in out if row[4]), key=lambda row: (-row[3], row[0] is None, row[0] or 0))
    taken = eligible[: draw.percent * len(eligible) // 100]
    rest = Counter(out) - Counter(taken)
    return sorted(
        [(*row[:4], rank) for rank, row in enumerate(taken, 1)] + [(*row[:4], None) for row in rest.elements()], key=repr
    )


@pytest.mark.parametrize("longest, percent", [(1, 10), (3, 35)])
def test_target_draw_equals_brute_force(docs_of, queries_of, odd_rows, monkeypatch, longest, percent):
    monkeypatch.setattr(target_draw, "BYTES_AT_ONCE", 5_000)
    draw = target_draw.Draw(longest=longest, percent=percent)
    rows = many_copies(odd_rows) + [(None, prose(6, 30), "en", "a")] * 40
    found = target_draw.draw_documents(docs_of(rows), queries_of(ITEMS), draw)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, found.collect()), key=repr) == drawn(rows, ITEMS, draw)


def test_target_draw_of_empty_tables(docs_of, queries_of, odd_rows):
    draw = target_draw.Draw()
    assert target_draw.draw_documents(docs_of([]), queries_of(ITEMS), draw).count() == 0
    found = target_draw.draw_documents(docs_of(odd_rows), queries_of([]), draw)
    assert sorted(map(tuple, found.collect()), key=repr) == drawn(odd_rows, [], draw)


def test_check_sql_on_odd_rows(docs_of, queries_of, odd_rows):
    rows = many_copies(odd_rows)
    documents, benchmark = docs_of(rows).toArrow(), queries_of(ITEMS).toArrow()
    con = duckdb.connect()
    con.register("documents", documents)
    con.register("benchmark", benchmark)
    for sql, frame in (
        (bag_search.EXPECTED, bag_search.search(docs_of(rows), queries_of(ITEMS))),
        (target_draw.EXPECTED, target_draw.draw_documents(docs_of(rows), queries_of(ITEMS))),
    ):
        answer = con.sql(f"SELECT {', '.join(frame.columns)} FROM ({sql})").fetchall()
        assert sorted(answer, key=repr) == sorted(map(tuple, frame.collect()), key=repr)
