"""Classifier, resampling, language model, encoder, mixing, licenses, signatures."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tests.llm.conftest import prose
from tidelog.llm import bpe, importance, license_scan, pfair, ppm, spot_signatures, toxicity
from tidelog.llm.common import words_of

SMALL = toxicity.Settings(buckets=1 << 16, steps=80)


@pytest.fixture(scope="session")
def insults():
    texts, marks = [], []
    for number in range(1200):
        text = prose(1000 + number, 60)
        if number % 3 == 0:
            words = text.split(" ")
            text = " ".join([*words[:20], "zblorgish", *words[20:40], "zblorgish", *words[40:]])
        texts.append(text)
        marks.append(int(number % 3 == 0))
    return texts, marks


def test_toxic_words_and_unseen_spellings_are_found(insults):
    texts, marks = insults
    model = toxicity.fit(texts[:1000], marks[:1000], [1.0] * 1000, SMALL)
    bias = model.bias[1] - model.bias[0]
    odds = lambda some: toxicity.worst_of(some, model.gram_scores(), SMALL) + bias
    found = odds(texts[1000:]) > 0
    assert (found == (np.array(marks[1000:]) == 1)).mean() > 0.95
    clean = prose(5, 60)
    spelled = "zblorgishh! " + clean + " Zblorgis"
    assert odds([spelled])[0] > odds([clean])[0] + 2
    assert odds([clean + " " + prose(6, 3000) + " zblorgish zblorgish"])[0] > odds([clean])[0]


def test_toxicity_of_odd_rows(docs_of, labels_of, odd_rows, insults):
    texts, marks = insults
    rows = odd_rows + [(100 + n, text, "en", "a") for n, text in enumerate(texts)]
    labels = labels_of([(100 + n, 1, mark) for n, mark in enumerate(marks)] + [(None, 1, 1), (1, None, None)])
    docs = docs_of(rows)
    found = toxicity.score_documents(docs, labels, SMALL).collect()
    assert len(found) == len(rows)
    assert all(0 <= row["score"] <= 1 and row["predicted"] == int(row["score"] >= 0.3) for row in found)
    assert all(row["held_out"] == (row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 4 == 2) for row in found)
    kept = toxicity.drop_toxic(docs, labels, SMALL)
    assert kept.columns == docs.columns
    assert kept.count() == sum(row["score"] < 0.3 for row in found)
    assert toxicity.score_documents(docs.limit(0), labels.limit(0), SMALL).count() == 0


def test_bpe_equals_the_library(docs_of, odd_rows):
    library = Tokenizer.from_file(bpe.tokenizer_path())
    draw = random.Random(3)
    texts = [row[1] or "" for row in odd_rows] + ["".join(draw.choices("abe <|>\n't日é ", k=200)) for _ in range(60)]
    encoder = bpe.Encoder(bpe.read_vocabulary(bpe.tokenizer_path()))
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        expected = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == expected
        assert encoder.decode(ids) == library.decode(expected, skip_special_tokens=False)
    assert 0 < encoder.failed < encoder.guessed
    digests = bpe.round_trip_digests(docs_of(odd_rows))
    assert digests.count() == len(odd_rows)
    assert bpe.round_trip_digests(docs_of([])).count() == 0


def test_bpe_cuts_long_texts_at_safe_places(monkeypatch):
    encoder = bpe.Encoder(bpe.read_vocabulary(bpe.tokenizer_path()))
    text = prose(9, 400) + "   x  \n y" * 30
    whole = list(encoder.encode([text, "", text]))
    monkeypatch.setattr(bpe, "CHARACTERS_AT_ONCE", 7)
    monkeypatch.setattr(bpe, "WORDS_AT_ONCE", 5)
    assert list(encoder.encode([text, "", text])) == whole


def test_merging_together_equals_merging_alone():
    vocabulary = bpe.read_vocabulary(bpe.tokenizer_path())
    draw = random.Random(4)
    words = [bytes(draw.choices(b"abcdeth ", k=draw.randint(1, 12))) for _ in range(300)]
    assert bpe.merged_together(words, vocabulary) == [bpe.merged(word, vocabulary) for word in words]


def slow_log10(cells, history, symbol):
    """Prediction by partial matching, one symbol, straight from counts by context."""
    excluded, total = set(), 0.0
    for order in range(min(ppm.ORDER, len(history)), -1, -1):
        place = int(ppm.classes_of(order, np.array([int.from_bytes(history[len(history) - order :], "big")], np.uint64))[0])
        seen = {s: n for s, n in cells[order][place].items() if s not in excluded}
        if not seen:
            continue
        whole = sum(seen.values()) + len(seen)
        if symbol in seen:
            return total + math.log10(seen[symbol] / whole)
        total += math.log10(len(seen) / whole)
        excluded |= seen.keys()
    return total - math.log10(ppm.SYMBOLS - len(excluded))


def test_ppm_matches_brute_force(docs_of, odd_rows):
    rows = odd_rows + [(200 + n, prose(300 + n, 50), "en" if n % 2 else "fr", "a") for n in range(30)]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    tokens = [words_of(row[1] or "") + [ppm.END] for row in rows]
    group = lambda lang: zlib.crc32((lang or "").encode()) % ppm.GROUPS
    cells = defaultdict(lambda: [defaultdict(Counter) for _ in range(ppm.ORDER + 1)])
    counts, shares = Counter(), Counter()
    for row, own in zip(rows, tokens, strict=True):
        if held(row[0]):
            continue
        counts.update(own)
        shares[group(row[2])] += 1
        for word in own:
            history = b" "
            for symbol in ppm.symbols_of(word):
                for order in range(min(ppm.ORDER, len(history)) + 1):
                    value = int.from_bytes(history[len(history) - order :], "big")
                    place = int(ppm.classes_of(order, np.array([value], np.uint64))[0])
                    cells[group(row[2])][order][place][symbol] += 1
                history += bytes([symbol]) if symbol < 256 else b""
    total, different = sum(counts.values()), len(counts)
    known = {}

    def score(word, own):
        if (word, own) not in known:
            history, sums = b" ", 0.0
            for symbol in ppm.symbols_of(word):
                sums += slow_log10(cells[own], history[-ppm.ORDER :], symbol)
                history += bytes([symbol]) if symbol < 256 else b""
            known[word, own] = sums
        return known[word, own]

    expected = []
    for row, own in zip(rows, tokens, strict=True):
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (different + 1))) for w in own)
        by_group = {g: sum(score(w, g) for w in own) + math.log10(n / sum(shares.values())) for g, n in shares.items()}
        top = max(by_group.values())
        whole = top + math.log10(sum(10 ** (s - top) for s in by_group.values()))
        expected.append((row[0], held(row[0]), len(own), sum(counts[w] > 0 for w in own), total, base, whole))
    found = sorted(map(tuple, ppm.score_documents(docs_of(rows)).collect()), key=repr)
    for got, want in zip(found, sorted(expected, key=repr), strict=True):
        assert got[:5] == want[:5]
        assert got[5:] == pytest.approx(want[5:], rel=1e-5)
    assert ppm.score_documents(docs_of([])).count() == 0


def ppm_across_words(rows):
    """Scores of held-out and other rows from exact contexts of whole texts, straight from counts."""
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    group = lambda lang: zlib.crc32((lang or "").encode()) % ppm.GROUPS
    spelled = []
    for row in rows:
        text = "".join(word + " " for word in words_of(row[1] or "")).encode()
        spelled.append((b" " * ppm.ORDER + text, [*text, ppm.END_OF_TEXT]))
    cells, shares = defaultdict(lambda: defaultdict(Counter)), Counter()
    for row, (history, symbols) in zip(rows, spelled, strict=True):
        if not held(row[0]):
            shares[group(row[2])] += 1
            for at, symbol in enumerate(symbols):
                for order in range(ppm.ORDER + 1):
                    cells[group(row[2])][history[at + ppm.ORDER - order : at + ppm.ORDER]][symbol] += 1

    def log10_of(own, context, symbol):
        excluded, total = set(), 0.0
        for order in range(ppm.ORDER, -1, -1):
            seen = {s: n for s, n in cells[own][context[ppm.ORDER - order :]].items() if s not in excluded}
            if symbol in seen:
                return total + math.log10(seen[symbol] / (sum(seen.values()) + len(seen)))
            if seen:
                total += math.log10(len(seen) / (sum(seen.values()) + len(seen)))
                excluded |= seen.keys()
        return total - math.log10(ppm.SYMBOLS - len(excluded))

    found = []
    for history, symbols in spelled:
        by_group = [
            sum(log10_of(g, history[at : at + ppm.ORDER], s) for at, s in enumerate(symbols)) + math.log10(n / sum(shares.values()))
            for g, n in shares.items()
        ]
        top = max(by_group)
        found.append(top + math.log10(sum(10 ** (one - top) for one in by_group)))
    return found


def test_ppm_contexts_run_over_words(spark, docs_of, odd_rows, tmp_path, monkeypatch):
    texts = [prose(300 + n, 50) for n in range(30)]
    rows = [row for row in odd_rows if row[0] != 8]
    rows += [(200 + n, text, "en" if n % 2 else "fr", "a") for n, text in enumerate(texts)]
    held = [n for n in range(300, 900) if zlib.crc32(str(n).encode()) % 10 == 0][:2]
    rows += [(held[0], "of the of the\x00 x", "en", "a"), (held[1], "x the the\x00 of of", "en", "a")]
    docs_of(rows).write.parquet(str(tmp_path / "documents.parquet"))
    expected = sorted(((row[0], score) for row, score in zip(rows, ppm_across_words(rows), strict=True)), key=repr)

    def scores():
        found = ppm.op7_ppm_scores(spark, str(tmp_path)).select("doc_id", "score").collect()
        return sorted(map(tuple, found), key=repr)

    def agree(found):
        assert [one[0] for one in found] == [one[0] for one in expected]
        assert [one[1] for one in found] == pytest.approx([one[1] for one in expected], rel=1e-5)

    agree(scores())
    assert len({score for doc_id, score in scores() if doc_id in held}) == 2
    for name in ("PART_WORDS", "BUCKET_GRAMS", "BLOCK_DOCUMENTS"):
        monkeypatch.setattr(ppm, name, 7)
    agree(scores())


def test_ppm_scores_depend_on_the_order_of_words(docs_of):
    """Held-out texts in the order of the training texts are likelier than with turned words."""
    phrases = ["zulu ate bread", "kilo ran home", "papa cut wood"]
    held = [n for n in range(900) if zlib.crc32(str(n).encode()) % 10 == 0][:6]
    learned = [n for n in range(900) if zlib.crc32(str(n).encode()) % 10][:60]
    text = lambda n: " ".join(phrases[(n + at) % 3] for at in range(4))
    turned = lambda n: " ".join(reversed(text(n).split()))
    rows = [(doc_id, text(n), "en", "a") for n, doc_id in enumerate(learned)]
    rows += [(doc_id, text(n) if n < 3 else turned(n), "en", "a") for n, doc_id in enumerate(held)]
    found = {row["doc_id"]: row for row in ppm.score_documents(docs_of(rows), across=True).collect()}
    for n in range(3):
        assert found[held[n]]["score"] > found[held[n + 3]]["score"] + 5
        assert found[held[n]]["base_score"] == pytest.approx(found[held[n + 3]]["base_score"])


def test_ppm_probabilities_add_up_to_one():
    words = [word for word in prose(8, 300).split()]
    trie = ppm.Trie.of(ppm.counted(words, np.ones(len(words), int)))
    spelling = ppm.Spelling.of(["bad", "zz"])
    table = trie.distributions(spelling.before, spelling.reach)
    others = ppm.SYMBOLS - len(trie.alphabet)
    sums = (10 ** table[:, :-1]).sum(axis=1) + others * 10 ** table[:, -1]
    assert np.all(sums <= 1 + 1e-9) and np.all(sums > 0.9)


def test_ppm_contexts_are_never_merged():
    contexts = np.random.default_rng(5).integers(0, 1 << 40, 200_000, dtype=np.uint64)
    for order in range(ppm.ORDER + 1):
        own = contexts & np.uint64((1 << 8 * order) - 1)
        assert len(np.unique(ppm.classes_of(order, contexts))) == len(np.unique(own))


def test_ppm_scores_do_not_depend_on_how_grams_are_dealt(docs_of, odd_rows, monkeypatch):
    def scores():
        return sorted(map(tuple, ppm.score_documents(docs_of(odd_rows)).collect()), key=repr)

    whole = scores()
    for name in ("PART_WORDS", "BUCKET_GRAMS", "BLOCK_DOCUMENTS"):
        monkeypatch.setattr(ppm, name, 5)
    for got, want in zip(scores(), whole, strict=True):
        assert got[:5] == want[:5]
        assert got[5:] == pytest.approx(want[5:], rel=1e-5)


def test_pfair_meets_windows_and_stays_within_a_block(docs_of):
    sizes = {"a": 900, "b": 300, "c": 130, None: 20}
    rows = [(1000 * n + at, "x", "en", name) for n, (name, size) in enumerate(sizes.items()) for at in range(size)]
    weights = {"a": 0.62, "b": 0.25, "c": 0.1, "": 0.03}
    found = pfair.mix(docs_of(rows), weights, block_rows=5, period=100).collect()
    assert len(found) == len(rows)
    slots = {}
    for row in found:
        assert row["release"] <= row["slot"] < row["deadline"]
        assert slots.setdefault(row["slot"], (row["source"], row["block"])) == (row["source"], row["block"])
    blocks = Counter((row["source"], row["block"]) for row in found)
    assert max(blocks.values()) <= 5
    first_gap = next(at for at in range(10**6) if at not in slots)
    shares = pfair.whole_shares(weights, 100)
    placed = Counter()
    for slot in range(first_gap):
        placed[slots[slot][0]] += 1
        for name, share in shares.items():
            assert abs(placed[name] - (slot + 1) * share / 100) < 1


def test_mixing_of_odd_rows_keeps_every_row(docs_of, odd_rows):
    docs = docs_of(odd_rows)
    assert pfair.mix(docs).count() == len(odd_rows)
    ordered = pfair.mixed_order(docs)
    assert ordered.columns == docs.columns
    assert sorted(map(repr, ordered.collect())) == sorted(map(repr, docs.collect()))
    left_out = pfair.mix(docs, {"a": 1.0, "b": 0.0}).collect()
    assert all((row["slot"] >= 0) == (row["source"] == "a") for row in left_out)
    assert pfair.mix(docs_of([])).count() == 0
    assert pfair.mixed_order(docs_of([])).count() == 0


def test_resampling_prefers_the_target_and_keeps_the_share(docs_of, labels_of, odd_rows):
    junk = [(500 + n, " ".join(["qq%%", "zz##", f"v{n}"] * 20), "en", "a") for n in range(60)]
    good = [(300 + n, prose(n, 60), "en", "a") for n in range(60)]
    rows = odd_rows + junk + good
    labels = labels_of([(300 + n, 1, 0) for n in range(40)] + [(500 + n, 0, 0) for n in range(40)] + [(None, 1, None)])
    found = importance.resample(docs_of(rows), labels, keep_share=0.5).collect()
    assert sum(row["kept"] for row in found) >= math.ceil(0.5 * len(rows))
    lowest = min(row["draw"] for row in found if row["kept"])
    assert all(row["draw"] <= lowest for row in found if not row["kept"])
    kept = {row["doc_id"] for row in found if row["kept"]}
    assert sum(300 + n in kept for n in range(60)) > 55 and sum(500 + n in kept for n in range(60)) < 15
    assert importance.resample(docs_of([]), labels).count() == 0


def test_kth_largest(spark):
    values = [random.Random(2).randint(-(1 << 62), 1 << 62) for _ in range(300)] + [-5, -5, 0, 3, 3]
    table = spark.createDataFrame([(value,) for value in values], "v LONG")
    for k in (1, 2, 150, 304, 305):
        assert importance.kth_largest(table, "v", k) == sorted(values, reverse=True)[k - 1]


def test_licenses_are_found_with_their_spans(docs_of, odd_rows):
    text = "some words\nLicensed under the Apache License, Version 2.0. More.\nreleased UNDER  the mit license"
    rows = odd_rows + [(50, text, "en", "a"), (51, "license under version of the", "en", "a")]
    found = {row["doc_id"]: row["notices"] for row in license_scan.scan_documents(docs_of(rows)).collect()}
    assert [(n["license"], n["coverage"]) for n in found[50]] == [("Apache-2.0", 1.0), ("MIT", 1.0)]
    assert [text[n["start"] : n["end"]] for n in found[50]] == [n["matched"] for n in found[50]]
    assert found[50][0]["matched"] == "Licensed under the Apache License, Version 2.0"
    assert all(not notices for doc_id, notices in found.items() if doc_id != 50)
    assert license_scan.scan_documents(docs_of([])).count() == 0


LICENSES = license_scan.Index.of(license_scan.all_templates())
LICENSE_FILES = sorted(file.name for file in license_scan.files("tidelog.llm.licenses").iterdir() if file.name.endswith(".txt"))


@pytest.mark.parametrize("name", LICENSE_FILES)
def test_whole_texts_and_headers_are_found_in_comments(name):
    whole = license_scan.files("tidelog.llm.licenses").joinpath(name).read_text("utf-8").split(license_scan.TERMS_END)[0]
    commented = "\n".join(f" * {line}" for line in whole.strip().split("\n"))
    edited = commented.split(" ")
    for at in range(len(edited) // 3 * 2, len(edited) // 3, -40):  # words put in, so that diagonals drift
        edited.insert(at, "qqinserted page seven")
    for body in (commented, " ".join(edited)):
        text = f"{prose(1, 50)}\n# Copyright 2020 Some One\n{body}\n{prose(2, 50)}"
        [notice] = license_scan.scan(text, LICENSES)
        assert notice[0] == name.removesuffix(".txt").removesuffix(".header")
        assert notice[1] > 0.95 and notice[5] == text[notice[3] : notice[4]]
        spanned = license_scan.WORD.findall(notice[5].lower())
        assert len(spanned) >= 0.95 * len(license_scan.WORD.findall(body.lower()))


def test_two_texts_and_half_a_text_of_a_license():
    mit = license_scan.files("tidelog.llm.licenses").joinpath("MIT.txt").read_text("utf-8")
    found = license_scan.scan(f"{mit}\n{prose(3, 30)}\n{mit}", LICENSES)
    assert [(one[0], one[1]) for one in found] == [("MIT", 1.0)] * 2
    assert license_scan.scan(" ".join(mit.split()[:60]), LICENSES) == []


def test_spdx_lines_give_their_identifiers():
    text = "// SPDX-License-Identifier: (MIT OR Apache-2.0) */\n# SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0\nx\nspdx-license-identifier: Foo-1"
    found = license_scan.scan(text, LICENSES)
    assert [(one[0], one[1]) for one in found] == [("MIT", 1.0), ("Apache-2.0", 1.0), ("GPL-2.0-only", 1.0), ("Foo-1", 1.0)]
    assert [one[5] for one in found][:2] == ["SPDX-License-Identifier: (MIT", "Apache-2.0"]
    assert license_scan.scan("SPDX-License-Identifier:", LICENSES) == []


def test_alignment_equals_the_whole_table():
    draw = random.Random(1)
    for _ in range(50):
        a, b = draw.choices("abcd", k=12), draw.choices("abcd", k=12)
        best = [[0] * 13 for _ in range(13)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        pairs = license_scan.aligned(a, b, 0, 12)
        assert len(pairs) == best[12][12]
        assert all(a[i] == b[j] for i, j in pairs)


def chains(text):
    words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
    found = set()
    for at, word in enumerate(words):
        if word in spot_signatures.ANCHORS:
            rest = [w for w in words[at + 1 :] if w not in spot_signatures.ANCHORS][: spot_signatures.CHAIN]
            if rest:
                found.add(" ".join([word, *rest]))
    return found or ({" ".join(words)} if words else set())


def alike(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_signatures_match_brute_force(docs_of):
    rows = [(n, prose(n // 2, 40 + n), "en", "a") for n in range(14)] + [(20, None, None, None), (21, "", None, None), (22, "of of", "en", "a")]
    rows += [(23, "Quite, plain words", "en", "a"), (24, "quite plain WORDS", "en", "a"), (25, "other plain words", "en", "a"), (26, "!?", "en", "a")]
    found = {row["doc_id"]: row for row in spot_signatures.compare_edited(docs_of(rows)).collect()}
    ordered = sorted(rows, key=lambda row: -row[0])
    for (doc_id, text, *_), (_, after, *_) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        text, after = text or "", after or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        row = found[doc_id]
        assert row["n_chars"] == len(text)
        assert row["near_edited"] == pytest.approx(alike(chains(text), chains(edited)))
        assert row["near_next"] == pytest.approx(alike(chains(text), chains(after)))
        assert (row["fingerprint"] == row["edited_fingerprint"]) == (chains(text) == chains(edited))


def test_signature_groups_match_brute_force(docs_of, odd_rows):
    rows = [row for row in odd_rows if row[0] != 9] + [(60 + n, prose(70, 200) + " " + prose(n, 5 * n), "en", "a") for n in range(6)]
    found = sorted(((r["doc_id"], r["component_id"]) for r in spot_signatures.near_groups(docs_of(rows)).collect()), key=repr)
    sets = [chains(row[1]) for row in rows]
    parent = list(range(len(rows)))
    for _ in rows:
        for a in range(len(rows)):
            for b in range(len(rows)):
                if alike(sets[a], sets[b]) >= 0.8:
                    parent[a] = parent[b] = min(parent[a], parent[b])
    ids = {p: min((rows[n][0] for n in range(len(rows)) if parent[n] == p and rows[n][0] is not None), default=None) for p in parent}
    assert found == sorted(((row[0], ids[parent[n]]) for n, row in enumerate(rows)), key=repr)


def test_next_texts_match_brute_force(docs_of, odd_rows):
    for rows in (odd_rows, odd_rows[:1], [(None, None, None, None), (None, "b", "en", "a")], [(5, "a", "en", "a")] * 3):
        texts = sorted(((i, t or "") for i, t, *_ in rows), key=lambda row: (row[0] is not None, row[0] or 0, row[1]), reverse=True)
        right = [(i, t, after) for (i, t), (_, after) in zip(texts, texts[1:] + texts[:1], strict=True)]
        found = [tuple(row) for row in spot_signatures.with_next_text(docs_of(rows)).collect()]
        assert sorted(found, key=repr) == sorted(right, key=repr)


def test_signatures_of_odd_rows(docs_of, odd_rows):
    assert spot_signatures.compare_edited(docs_of(odd_rows)).count() == len(odd_rows)
    assert spot_signatures.compare_edited(docs_of([])).count() == 0


def test_texts_without_chains_are_alike_only_with_the_same_words(docs_of):
    rows = [(1, "plain words", "en", "a"), (2, "Plain, words!", "en", "a"), (3, "other words", "en", "a"), (4, "", "en", "a"), (5, None, "en", "a")]
    found = {row["doc_id"]: row for row in spot_signatures.compare_edited(docs_of(rows)).collect()}
    assert [found[n]["near_next"] for n in (5, 4, 3, 2, 1)] == [1.0, 0.0, 0.0, 1.0, 0.0]
    prints = [found[n]["fingerprint"] for n in (1, 2, 3, 4, 5)]
    assert prints[0] == prints[1] and prints[3] == prints[4] and len(set(prints)) == 3


def test_overlapping_matches_as_when_all_are_compared():
    draw = random.Random(9)
    for _ in range(200):
        matches = []
        for number in range(draw.randint(0, 60)):
            start = draw.randrange(300)
            matches.append((draw.randint(1, 9), draw.random(), number, start, start + draw.randint(1, 20), "x"))
        matches.sort(key=lambda one: (-one[0], -one[1], one[2], one[3]))
        kept = []
        for one in matches:
            if all(one[4] <= other[3] or one[3] >= other[4] for other in kept):
                kept.append(one)
        assert license_scan.without_overlaps(matches) == sorted(kept, key=lambda one: one[3])


def naive_score(model, text):
    """Score of a text from the model's own vectors, one n-gram at a time."""
    settings = model.settings

    def vector(gram):
        rolled = ord(gram[0])
        for letter in gram[1:]:
            rolled = (rolled * 0x100000001B3 + ord(letter)) % (1 << 64)
        return model.vectors[(rolled * 0x9E3779B97F4A7C15 % (1 << 64) >> 40) % settings.buckets]

    words = re.sub(r"[^\w\s]+|_+", "", (text or "").lower()).split()
    means = []
    for word in words:
        marked = f"<{word}>"
        grams = [marked[at : at + n] for n in range(3, 7) for at in range(len(marked) - n + 1)]
        means.append(sum(map(vector, grams)) / len(grams))
    odds = []
    for at in range(0, max(1, len(words)), settings.segment):
        segment = sum(means[at : at + settings.segment], np.zeros(settings.size)) / settings.segment
        left, right = segment @ model.weights + model.bias
        odds.append(1 / (1 + math.exp(left - right)))
    return max(odds)


def test_scores_match_brute_force(docs_of, labels_of, odd_rows, insults):
    texts, marks = insults
    rows = odd_rows + [(100 + n, text, "en", "a") for n, text in enumerate(texts[:400])]
    docs, labels = docs_of(rows), labels_of([(100 + n, 1, mark) for n, mark in enumerate(marks[:400])])
    model = toxicity.fit_on_labels(docs, labels, SMALL)
    found = sorted((repr(row["doc_id"]), row["score"]) for row in toxicity.score_documents(docs, labels, SMALL).collect())
    right = sorted((repr(row[0]), naive_score(model, row[1])) for row in rows)
    assert [name for name, _ in found] == [name for name, _ in right]
    assert [score for _, score in found] == pytest.approx([score for _, score in right], abs=1e-4)


def test_weights_match_brute_force(docs_of, labels_of, odd_rows):
    rows = odd_rows + [(300 + n, prose(n, 60), "en", "a") for n in range(30)]
    labels = labels_of([(300 + n, 1, 0) for n in range(10)] + [(305, 0, 0), (2, 1, None)])
    mix, crc = 0x9E3779B97F4A7C15, lambda word: zlib.crc32(word.encode())

    def buckets(text):
        hashes = [crc(word) for word in words_of(text or "")]
        grams = hashes + [a * 31 + b + 1 for a, b in zip(hashes, hashes[1:], strict=False)]
        return Counter((gram * mix % (1 << 64)) >> 48 for gram in grams)

    good = {300 + n for n in range(10)} - {305} | {2}
    target = sum((buckets(row[1]) for row in rows if row[0] in good), Counter())
    raw = sum((buckets(row[1]) for row in rows), Counter())
    size = importance.BUCKETS
    ratio = lambda b: math.log((target[b] + 1) / (target.total() + size)) - math.log((raw[b] + 1) / (raw.total() + size))
    found = sorted((repr(r["doc_id"]), r["n_grams"], r["log_weight"]) for r in importance.resample(docs_of(rows), labels).collect())
    right = []
    for row in rows:
        own = buckets(row[1])
        total = sum(n * ratio(b) for b, n in own.items())
        right.append((repr(row[0]), own.total(), 64 * total / (own.total() + 16)))
    right.sort()
    assert [one[:2] for one in found] == [one[:2] for one in right]
    assert [one[2] for one in found] == pytest.approx([one[2] for one in right], rel=1e-9, abs=1e-12)
