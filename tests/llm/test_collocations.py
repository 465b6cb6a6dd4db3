"""Phrase mining against brute force: any memory budget, repeats, nulls, ties, cuts and containment."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from tallywise.llm.collocations import collocations, exact_score, frequent_phrases
from tallywise.session import Scratch

SCHEMA = "doc_id long, lang string, text string, words string, id int, n string"  # the last three clash with inner names


def pieces(rows):
    for _, lang, text, *_ in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            yield lang or "und" if lang is None else lang, [w for w in re.split(r"[\x20\x09]+", piece) if w]


def counted(rows, least):
    f, n = Counter(), Counter()
    for lang, w in pieces(rows):
        n[lang] += len(w)
        for m in range(1, 6):
            f.update((lang, tuple(w[i : i + m])) for i in range(len(w) - m + 1))
    return {k: v for k, v in f.items() if v >= least}, n


def brute(rows, least, percent, top):
    f, n = counted(rows, least)
    out = []
    for (lang, g), a in f.items():
        if len(g) < 2:
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, g[:k]] * f[lang, g[k:]]), k) for k in range(1, len(g))]
        score, k = min(cuts)
        inside = [b for (other, h), b in f.items() if other == lang and len(h) > len(g) and any(h[i : i + len(g)] == g for i in range(len(h)))]
        if not any(100 * b >= percent * a for b in inside):
            out.append((lang, " ".join(g), a, f[lang, g[:k]], f[lang, g[k:]], n[lang], score))
    found = []
    for lang in {x[0] for x in out}:
        mine = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))
        found += [(x[0], i + 1, *x[1:]) for i, x in enumerate(mine[:top])]
    return sorted(found)


def corpus(seed, size=250):
    chance = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(12)] + ["Über", "É", "漢字", "a b", "x\x1cy", "🙂"]
    rows = []
    for i in range(size):
        said = [chance.choice(vocabulary[: chance.choice([3, 18])]) for _ in range(chance.randrange(30))]
        said += ["New", "york", "city", "hall", "of", "fame"][chance.randrange(4) :] * chance.randrange(3)
        text = "".join(w + chance.choice([" ", "  ", "\t", " ", " ", ". ", "\n", "\x0b", "!?"]) for w in said)
        rows.append((i, chance.choice(["en", "en", "en", None, "und", "é"]), text))
    rows += [(1, "en", None), (2, "en", ""), (None, "en", " . , "), (None, None, None), (3, "long", "la la la land. " * 3000), *rows[:20]]
    return [(*r, "clash", 1, "clash") for r in rows]


@pytest.mark.parametrize(("least", "percent", "top", "memory"), [(5, 100, 2000, 1 << 18), (3, 80, 7, 40), (2, 100, 2000, 3), (8, 50, 2, 1)])
def test_brute_force(spark, monkeypatch, least, percent, top, memory):
    """A budget of a few suffixes makes prefixes longer, up to whole suffixes."""
    monkeypatch.setattr("tallywise.llm.collocations.MAX_HOT", 1 << 40)
    rows = corpus(least)
    got = collocations(spark.createDataFrame(rows, SCHEMA), Scratch(spark), least, percent, top, memory).collect()
    assert sorted(map(tuple, got)) == brute(rows, least, percent, top)


def test_full_bit_tables_let_nothing_wrong_through(spark, monkeypatch):
    """With tables of a few bits all words and pairs seem frequent: more suffixes, the same phrases."""
    monkeypatch.setattr("tallywise.llm.collocations.FLAGS", 8)
    monkeypatch.setattr("tallywise.llm.words.SLICE_BYTES", 300)
    monkeypatch.setattr("tallywise.llm.collocations.HELD", 50)
    monkeypatch.setattr("tallywise.llm.collocations.PART", 5)
    rows = corpus(1)
    phrases, vocabulary, totals = frequent_phrases(spark.createDataFrame(rows, SCHEMA).fillna({"lang": "und", "text": ""}), Scratch(spark), 6)
    named = {r.id: (r.lang, r.word) for r in vocabulary.collect()}
    got = {(named[r.words[0]][0], tuple(named[w][1] for w in r.words)): r.a for r in phrases.collect()}
    assert got == {k: v for k, v in counted(rows, 6)[0].items() if len(k[1]) > 1}
    assert {r.lang: r.n for r in totals.collect()} == {k: n for k, n in counted(rows, 6)[1].items() if n}


def test_numbers_beyond_64_bits(spark):
    rows = [(10**15 + 7, 3 * 10**16 + 1, 2 * 10**15 + 3, 10**15 + 9), (10**12, 10**13 - 1, 10**12, 10**12 + 1), (100, 101, 100, 100)]
    got = spark.createDataFrame(rows, "a long, n long, l long, r long").withColumn("score", exact_score()).collect()
    assert [r.score for r in got] == [1000 * a * n // (x * y) for a, n, x, y in rows]


def test_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert collocations(empty, Scratch(spark)).collect() == []
    assert collocations(spark.createDataFrame([(1, "en", "a b c", "", 0, "")], SCHEMA), Scratch(spark)).collect() == []
