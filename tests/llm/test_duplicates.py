"""Exact, SimHash and line duplicates against brute force."""

from __future__ import annotations

import hashlib
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.conftest import prose
from tidelog.llm import exact_index, line_join, ring_simhash
from tidelog.llm.common import Scratch, words_of
from tidelog.llm.components import connected_components


def rows_of(table):
    return sorted(map(tuple, table.collect()), key=repr)


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def roots_of(nodes, edges):
    parent = {node: node for node in nodes}

    def find(node):
        while parent[node] != node:
            node = parent[node]
        return node

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    return {node: find(node) for node in nodes}


def test_exact_groups_match_brute_force(docs_of, odd_rows):
    found = exact_index.exact_groups(docs_of(odd_rows)).drop("bucket")
    groups = {}
    for doc_id, text, *_ in odd_rows:
        groups.setdefault(plain(text), []).append(doc_id)
    expected = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        ordered = sorted(ids, key=lambda i: (i is None, i or 0))
        digest = hashlib.sha256(text.encode()).hexdigest()
        expected += [(i, keep, len(ids), at == 0, digest) for at, i in enumerate(ordered)]
    assert rows_of(found) == sorted(expected, key=repr)


def test_exact_stage_keeps_one_row_of_each_text_with_all_columns(docs_of, odd_rows):
    docs = docs_of(odd_rows)
    kept = exact_index.drop_copies(docs)
    assert kept.columns == docs.columns
    texts = [plain(row["text"]) for row in kept.collect()]
    assert len(texts) == len(set(texts)) == len({plain(text) for _, text, *_ in odd_rows})


def test_directory_doubles_only_where_buckets_are_overfull(spark):
    entries = spark.range(4000).select(F.xxhash64("id").alias("key"))
    crowded = spark.range(900).select(F.shiftrightunsigned(F.xxhash64("id"), 24).alias("key"))
    both = entries.unionByName(crowded)
    table, depth = exact_index.directory(both.unionByName(both), Scratch(spark, "test"), capacity=300)
    assert depth > 24
    keys = both.withColumn("prefix", exact_index.prefix_of(F.col("key"), depth))
    held = keys.join(table, "prefix").groupBy("bucket", "depth").count().collect()
    assert sum(row["count"] for row in held) == 4900
    assert all(row["count"] <= 300 for row in held)
    assert len({row["depth"] for row in held}) > 1


def test_texts_of_one_key_are_told_apart_by_their_bytes(spark, docs_of, odd_rows, monkeypatch):
    """Three keys for all texts: the groups come from the chains of the buckets."""
    rows = odd_rows + [(50 + n, prose(n % 9, 20), "en", "a") for n in range(60)]
    expected = rows_of(exact_index.exact_groups(docs_of(rows)).drop("bucket"))
    kept = rows_of(exact_index.drop_copies(docs_of(rows)).select("text"))
    monkeypatch.setattr(exact_index, "text_key", lambda text: F.pmod(F.length(text), F.lit(3)).cast("long"))
    found = exact_index.exact_groups(docs_of(rows))
    assert rows_of(found.drop("bucket")) == expected
    assert found.filter("bucket IS NULL AND group_size > 1").count() == 0
    assert rows_of(exact_index.drop_copies(docs_of(rows)).select("text")) == kept
    keyed = exact_index.keyed_rows(docs_of(rows)).select("key", "doc_id")
    chains = exact_index.write_index(keyed, exact_index.keyed_texts(docs_of(rows)), Scratch(spark, "test"))
    assert chains.count() == len({plain(row[1]) for row in rows})
    assert chains.select("key").distinct().count() == 3


def simhash(text):
    words = words_of(text or "")
    if not words:
        return 0
    grams = [" ".join(words[at : at + 4]) for at in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(gram.encode(), 42) for gram in grams]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def test_simhash_matches_brute_force(docs_of, odd_rows):
    rows = odd_rows + [(20 + n, prose(1, 120).replace("of", "off", n % 3), "en", "a") for n in range(12)]
    found = ring_simhash.near_duplicates(docs_of(rows)).collect()
    prints = {i: simhash(row[1]) for i, row in enumerate(rows)}
    roots = roots_of(prints, [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 4])
    expected = []
    for at, row in enumerate(rows):
        ids = [rows[other][0] for other in prints if roots[other] == roots[at] and rows[other][0] is not None]
        expected.append((row[0], f"{prints[at]:016x}", min(ids, default=None)))
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


def test_simhash_stage_keeps_one_row_of_each_group(docs_of, odd_rows):
    docs = docs_of(odd_rows[:11] + odd_rows[12:])  # else two groups have the id 9
    kept = ring_simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    groups = {row["component_id"] for row in ring_simhash.near_duplicates(docs).collect()}
    assert kept.count() == len(groups)


def test_keys_widen_with_the_number_of_prints():
    """Candidates by chance, per print, grow far less than the prints."""
    by_chance = []
    for power in range(10, 34):
        found = ring_simhash.lookups(4, ring_simhash.key_width(1 << power))
        by_chance.append(sum((1 << power) / (1 << (mask % (1 << 64)).bit_count()) for _, mask in found))
    assert max(by_chance) < 1000
    assert len(ring_simhash.lookups()) == 15 and ring_simhash.key_width(250_000) == (3, 3)


@pytest.mark.parametrize("width", ring_simhash.WIDTHS)
def test_every_near_pair_shares_a_key(width):
    import random

    draw = random.Random(sum(width))
    found = ring_simhash.lookups(4, width)
    chains = [ring_simhash.chain_masks(start) for start in range(5)]
    for _ in range(3000):
        difference = sum(1 << bit for bit in draw.sample(range(64), draw.randint(0, 4)))
        assert any(
            not difference & mask % (1 << 64)
            and all((difference & m % (1 << 64)).bit_count() <= ring_simhash.chain_budget(n) for n, m in enumerate(chains[start], 1))
            for start, mask in found
        )


def test_ring_filter_loses_no_link(spark):
    import random

    draw = random.Random(5)
    centers = [draw.getrandbits(64) for _ in range(40)]
    prints = set(centers)
    for center in centers:
        for _ in range(25):
            value = center
            for bit in draw.sample(range(64), draw.randint(1, 6)):
                value ^= 1 << bit
            prints.add(value)
    signed = [value - (1 << 64) if value >> 63 else value for value in prints]
    scratch = Scratch(spark, "test")
    nodes = spark.createDataFrame([(value,) for value in signed], "node LONG")
    found = {row["node"]: row["root"] for row in ring_simhash.near_roots(nodes, scratch).collect()}
    wide = {row["node"]: row["root"] for row in ring_simhash.near_roots(nodes, scratch, width=(4, 5)).collect()}
    mask = (1 << 64) - 1
    edges = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & mask).bit_count() <= 4]
    expected = roots_of(signed, edges)
    parts = lambda roots: {frozenset(n for n in signed if roots.get(n, n) == r) for r in {roots.get(n, n) for n in signed}}
    assert parts(found) == parts(wide) == parts(expected)


def test_components_of_a_long_path_and_no_edges(spark):
    scratch = Scratch(spark, "test")
    path = spark.createDataFrame([(n, n + 1) for n in range(60)] + [(100, 101)], "a LONG, b LONG")
    found = {row["node"]: row["root"] for row in connected_components(path, scratch).collect()}
    assert found == {**{n: 0 for n in range(61)}, 100: 100, 101: 100}
    assert connected_components(path.limit(0), scratch).count() == 0


def clean_lines(rows):
    order = sorted(range(len(rows)), key=lambda n: (rows[n][0] is not None, rows[n][0] or 0))
    sets = []
    for number in order:
        for at, line in enumerate((rows[number][1] or "").split("\n")):
            words = frozenset(w for w in re.split(r"[\x20\x09-\x0D]+", line.lower()) if w)
            sets.append(((rows[number][0] is not None, rows[number][0] or 0), at, words, line, number))
    kept = {}
    for place, at, words, line, number in sets:
        earlier = [o for o in sets if (o[0], o[1]) < (place, at) and o[2] and words]
        if not words or not any(len(words & o[2]) >= 0.8 * len(words | o[2]) - 1e-9 for o in earlier):
            kept.setdefault(number, []).append(line)
    return [
        (row[0], (row[1] or "").count("\n") + 1, (row[1] or "").count("\n") + 1 - len(kept.get(n, [])), "\n".join(kept.get(n, [])))
        for n, row in enumerate(rows)
    ]


def test_lines_match_brute_force(docs_of, odd_rows):
    variants = [(30 + n, prose(40, 60) + f"\nextra word number {n} of a line that is quite long and shared", "en", "a") for n in range(6)]
    rows = [row for row in odd_rows if row[0] not in (None, 2, 8, 9)] + variants + [(None, prose(40, 60), None, None)]
    assert rows_of(line_join.dedup_lines(docs_of(rows))) == sorted(clean_lines(rows), key=repr)


def clean_lines_in_order(rows):
    """Like clean_lines; equal line numbers of rows with one id, or none, in the order of the rows."""
    lines = []
    for number, (doc_id, text, *_) in enumerate(rows):
        for at, line in enumerate((text or "").split("\n")):
            words = frozenset(w for w in re.split(r"[\x20\x09-\x0D]+", line.lower()) if w)
            lines.append(((doc_id is not None, doc_id or 0, at, number), words, line))
    lines.sort(key=lambda one: one[0])
    kept, seen = {number: [] for number in range(len(rows))}, set()
    for place, words, line in lines:
        if not words or not any(len(words & o) >= 0.8 * len(words | o) - 1e-9 for o in seen):
            kept[place[3]].append((place[2], line))
        if words:
            seen.add(words)
    out = []
    for number, (doc_id, text, *_) in enumerate(rows):
        total, stay = (text or "").count("\n") + 1, [line for _, line in sorted(kept[number])]
        out.append((doc_id, total, total - len(stay), "\n".join(stay)))
    return out


def test_lines_of_rows_with_one_id_or_none_match_brute_force(docs_of, odd_rows):
    short = [row for row in odd_rows if row[0] != 8]
    shared = [(None, "first own line here\nthe same words in every text of these", "en", "a")]
    shared += [(None, f"quite other {prose(60 + n, 12)}\nthe same words in every text of these", "en", "a") for n in range(4)]
    shared += [(9, "a b c d e f g h i\nunique words of one row", "en", "a"), (9, "a b c d e f g h i\nx y z", "en", "a")]
    rows = short + shared
    assert rows_of(line_join.dedup_lines(docs_of(rows))) == sorted(clean_lines_in_order(rows), key=repr)
    rows = odd_rows + shared
    assert rows_of(line_join.dedup_lines(docs_of(rows))) == sorted(clean_lines_in_order(rows), key=repr)


def test_lines_of_odd_rows_have_a_result_for_each_row(docs_of, odd_rows):
    assert line_join.dedup_lines(docs_of(odd_rows)).count() == len(odd_rows)


def test_empty_tables(docs_of):
    empty = docs_of([])
    for found in (
        exact_index.exact_groups(empty),
        exact_index.drop_copies(empty),
        ring_simhash.near_duplicates(empty),
        ring_simhash.drop_near_duplicates(empty),
        line_join.dedup_lines(empty),
    ):
        assert found.count() == 0


def test_words_of_one_line_are_not_written(spark):
    class Watched(Scratch):
        def write(self, table, name, *args, **kwargs):
            written = super().write(table, name, *args, **kwargs)
            rows[name] = rows.get(name, 0) + written.count()
            return written

    lines = [" ".join(f"w{line}x{word}" for word in range(30)) for line in range(20)]
    near = lines[7].replace("w7x0", "other").replace("w7x29", "more")
    texts = ["\n".join(lines[:10]), "\n".join(lines[10:]) + "\n" + near]
    table = spark.createDataFrame([(at, text, at) for at, text in enumerate(texts)], "doc_id LONG, text STRING, entry LONG")
    rows = {}
    kept = line_join.kept_lines(table, Watched(spark, "watched"))
    assert sorted(map(tuple, kept.collect())) == [(at // 10, at % 10) for at in range(20)]
    assert 2 <= rows["postings"] <= 14


def test_words_of_long_lines_are_compared_only_if_their_maps_are_near(spark):
    """Long unrelated lines that share rare words, and lines of equal words in another order."""
    import random

    class Watched(Scratch):
        def write(self, table, name, *args, **kwargs):
            written = super().write(table, name, *args, **kwargs)
            rows[name] = rows.get(name, 0) + written.count()
            return written

    draw = random.Random(6)
    vocabulary = [f"w{word}" for word in range(700)]
    lines = [" ".join(draw.sample(vocabulary, draw.randint(100, 180))) for _ in range(60)]
    lines += [" ".join(draw.sample(lines[3].split(), len(lines[3].split())) + ["w1"] * at) for at in range(30)]
    lines += [lines[5].replace("w", "v", 4), " ", "", lines[8].upper() + "  "]
    rows, kept = {}, []
    for at, line in enumerate(lines):
        words = frozenset(line.lower().split())
        if words and not any(len(words & other) >= 0.8 * len(words | other) for other in map(frozenset, map(str.split, lines[:at]))):
            kept.append((0, at))
    table = spark.createDataFrame([(0, "\n".join(lines), 0)], "doc_id LONG, text STRING, entry LONG")
    assert sorted(map(tuple, line_join.kept_lines(table, Watched(spark, "watched")).collect())) == kept
    assert len(kept) >= 60 and rows["near"] <= 100
