"""Phrase collocations against plain counting."""

import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from footfall.llm import collocations

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def brute_force(rows, least, inside_percent, top):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(str.maketrans(UPPER, UPPER.lower()))):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in (1, 2, 3):
                counts.update((lang, *words[i:i + n]) for i in range(len(words) - n + 1))
    candidates = {key: a for key, a in counts.items() if len(key) > 2 and a >= least}
    dropped = set()
    for (lang, *words), a in candidates.items():
        if len(words) == 3:
            for part in ((lang, *words[:2]), (lang, *words[1:])):
                if 100 * a >= inside_percent * counts[part]:
                    dropped.add(part)
    found = {}
    for (lang, *words), a in candidates.items():
        if (lang, *words) not in dropped:
            cuts = []
            for k in range(1, len(words)):
                l, r = counts[(lang, *words[:k])], counts[(lang, *words[k:])]  # noqa: E741
                cuts.append((1_000_000 * a * a // (l * r), k, l, r))
            score, _, l, r = min(cuts)  # noqa: E741
            found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), l, r))
    out = []
    for lang, own in found.items():
        for rank, (score, a, phrase, l, r) in enumerate(sorted(own)[:top], 1):  # noqa: E741
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def texts(seed, n):
    random = np.random.default_rng(seed)
    words = ["Ab", "ab", "c", "dé", "e\xa0f", "漢", "g", "H", "x" * 80, "i'j", *[f"w{i}" for i in range(30)]]
    weights = 1 / np.arange(1, len(words) + 1)
    gaps = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", " ! "]
    for _ in range(n):
        picked = random.choice(words, size=random.integers(0, 60), p=weights / weights.sum())
        yield "".join(word + gaps[random.integers(len(gaps))] for word in picked)


SCHEMA = "doc_id long, text string, lang string, rank string, key int, phrase string"


# The bounds of numbered words and pairs decide which way a phrase is counted, never whether.
@pytest.mark.parametrize("head_words,head_pairs", [(1 << 18, 1 << 19), (12, 1 << 19), (1 << 18, 20), (9, 5), (0, 0)])
def test_against_plain_counting(spark, head_words, head_pairs):
    rows = [(lang, text) for i, lang in enumerate(["en", "de", None, "und"]) for text in texts(i, 150)]
    rows += [("en", "same old phrase here. " * 300), ("en", None), (None, ""), ("fr", " \t\n.,"), ("en", rows[0][1]), ("en", rows[0][1])]
    df = spark.createDataFrame([(i, text, lang, "r", 1, "p") for i, (lang, text) in enumerate(rows)], SCHEMA).repartition(5)
    got = collocations.collocations(df, 10, 50, 40, head_words, head_pairs)
    assert sorted(map(tuple, got.collect())) == brute_force(rows, 10, 50, 40)


def test_products_beyond_64_bits(spark):
    rows = [("en", 4_000_000), ("de", 3_037_000_500)]
    words = spark.createDataFrame([(lang, w, a) for lang, a in rows for w in ("x", "y")], "lang string, word string, f long")
    pairs = spark.createDataFrame([(lang, "x", "y", a) for lang, a in rows], "lang string, w1 string, w2 string, a long")
    triples = spark.createDataFrame([], "lang string, w1 string, w2 string, w3 string, a long")
    totals = spark.createDataFrame([(lang, 2 * a) for lang, a in rows], "lang string, n long")
    got = collocations._ranked(words, totals, pairs, triples, 50, 10).collect()
    assert {(row.lang, row.score) for row in got} == {("en", 1_000_000), ("de", 1_000_000)}


def test_empty_tables(spark, no_docs, odd_docs):
    assert collocations.collocations(no_docs).count() == 0
    assert [row.phrase for row in collocations.collocations(odd_docs).where("lang = 'fr'").collect()] == ["word word word"]


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 40)), max_size=200), st.integers(1, 4))
def test_tiles_count_pairs(pairs, bits):
    left, right = (np.array([p[i] for p in pairs], np.int64) for i in (0, 1))
    one, two, counts = collocations.count_tiles(left, right, bits)
    assert dict(zip(zip(one.tolist(), two.tolist()), counts.tolist())) == Counter(pairs)


def test_dense_tiles():
    left = np.repeat(np.arange(300), 200)
    right = np.tile(np.arange(200), 300) * 7
    one, two, counts = collocations.count_tiles(np.concatenate((left, left)), np.concatenate((right, right)))
    assert len(counts) == 60_000 and set(counts.tolist()) == {2}
    assert set(zip(one.tolist(), two.tolist())) == set(zip(left.tolist(), right.tolist()))
