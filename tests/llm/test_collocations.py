"""Phrases equal counting by hand: nulls, ties, marks, many parts of a task, words and runs of one hash."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from assay.llm import collocations

SCHEMA = "doc_id long, text string, lang string, size string, phrase string, a string, `x.y` int"


def by_hand(rows, least, longest=5, covered=100, best=2000):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts[lang, tuple(words[i : i + size])] += 1
    kept = {key: n for key, n in counts.items() if n >= least}
    inner = Counter()
    for (lang, words), n in kept.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                key = lang, words[i : i + size]
                inner[key] = max(inner[key], n)
    found = {}
    for (lang, words), a in kept.items():
        if len(words) > 1 and not 100 * inner[lang, words] >= covered * a:
            cuts = []
            for k in range(1, len(words)):
                left, right = kept[lang, words[:k]], kept[lang, words[k:]]
                cuts.append((1000 * a * totals[lang] // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    rows = []
    for lang, phrases in found.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(phrases)[:best], 1):
            rows.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(rows)


def texts(seed, n=60):
    rng = random.Random(seed)
    vocabulary = ["a", "B", "b", "É", "é", "zz", "x-y", "日本", "the", "The", "'", "\x00"]
    blanks = [" ", "  ", "\t", " \t ", ".", ", ", "\n", "!? ", ";", "\r\n", "\x0b"]
    phrase = ["over and out", "Over  and\tout. now", "x x x x x x", "over and over and over"]
    for _ in range(n):
        parts = [rng.choice([rng.choice(vocabulary), rng.choice(phrase)]) + rng.choice(blanks + [" "] * 9) for _ in range(rng.randint(0, 60))]
        yield rng.choice(["".join(parts), None, "", " \t"]) if rng.random() < 0.2 else "".join(parts), rng.choice(["en", "en", "de", None, "und", ""])


def frame(spark, rows):
    full = [(i % 7 or None, text, lang, "s", "p", "a", 1) for i, (text, lang) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA).repartition(4, "text")


@pytest.mark.parametrize(("at_once", "piece", "hashes"), [(1 << 20, 1 << 20, None), (50, 20, None), (300, 1 << 20, 5)])
def test_equals_counting_by_hand(spark, monkeypatch, at_once, piece, hashes):
    monkeypatch.setattr(collocations, "AT_ONCE", at_once)
    monkeypatch.setattr(collocations, "SLICE", piece)
    monkeypatch.setattr(collocations, "KNOWN_WORDS", 5 if at_once == 50 else 1 << 20)
    if hashes:
        # Words of one first hash: runs of one fingerprint are told apart by words and second fingerprint.
        full = collocations.word_hash
        monkeypatch.setattr(collocations, "word_hash", lambda word: full(word) >> 64 << 64 | (sum(word) % hashes + 1))
        monkeypatch.setattr(collocations, "HELD_RUNS", 10)
    rows = list(texts(at_once))
    rows += rows[:5] * 30
    got = collocations.collocations(frame(spark, rows), least=8, best=40).collect()
    expected = by_hand(rows, 8, best=40)
    assert len(expected) > 60
    assert sorted(tuple(r) for r in got) == expected


def test_parameters(spark):
    rows = list(texts(3, 80))
    got = collocations.collocations(frame(spark, rows), least=5, longest=3, covered=70, best=10).collect()
    assert sorted(tuple(r) for r in got) == by_hand(rows, 5, 3, 70, 10)
    got = collocations.collocations(frame(spark, rows), least=300, longest=2).collect()
    assert sorted(tuple(r) for r in got) == by_hand(rows, 300, 2)


def test_no_rows_and_no_words(spark):
    assert collocations.collocations(spark.createDataFrame([], SCHEMA)).collect() == []
    assert collocations.collocations(frame(spark, [("", "en"), (None, None), (" \t.", "de")])).collect() == []


def test_scores_beyond_64_bits(spark, monkeypatch):
    """The formula holds for counts whose products pass 64 bits."""
    big = 10**15
    phrases = [("en", 1, "p", 3 * big), ("en", 1, "q", 2 * big), ("en", 2, "p q", big + 7)]
    found = (
        spark.createDataFrame(phrases, "lang string, size int, phrase string, a long"),
        spark.createDataFrame([("en", 9 * big + 1)], "lang string, n long"),
    )
    monkeypatch.setattr(collocations, "frequent_phrases", lambda *_: found)
    (row,) = collocations.collocations(spark.range(0)).collect()
    assert row.score == 1000 * (big + 7) * (9 * big + 1) // (3 * big * 2 * big)


def test_polynomials_give_the_fingerprint_of_every_run():
    words = [f"w{i % 17}".encode() for i in range(200)]
    reader = collocations.Words()
    ids = np.array([reader[w] for w in words] + [collocations.BREAK])
    powers = [collocations.Powers(base) for base in collocations.BASES]
    runs = collocations.Runs("en", ids, reader.hashes(), powers, {})
    for size, at, prints in runs.levels(5):
        assert at.tolist() == list(range(200 - size + 1))
        expected = [collocations.fingerprints("en", words[i : i + size]) for i in at]
        second = runs.second().prints(size, at)
        assert list(zip(prints.view(np.int64).tolist(), second.view(np.int64).tolist())) == expected


def test_long_text_without_breaks(spark):
    text = "lorem ipsum " * 200_000
    got = collocations.collocations(frame(spark, [(text, "la")])).collect()
    assert sorted(tuple(r) for r in got) == by_hand([(text, "la")], 100)
