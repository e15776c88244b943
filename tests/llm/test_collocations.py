"""Counts, scores and what is dropped, against plain Python."""

import re
from collections import Counter

import numpy as np
import pytest

from lectern.llm import collocations as C


def plain(docs, max_n=3, least=10, inside=50, top=2000):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            ws = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for m in range(1, max_n + 1):
                f.update((lang, tuple(ws[i : i + m])) for i in range(len(ws) - m + 1))
    wanted = {p: a for p, a in f.items() if len(p[1]) >= 2 and a >= least}
    out = {}
    for (lang, p), a in wanted.items():
        if any(q[0] == lang and len(q[1]) > len(p) and 100 * b >= inside * a and any(q[1][i : i + len(p)] == p for i in range(len(q[1]))) for q, b in wanted.items()):
            continue
        score, k = min((1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return {(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for lang, rows in out.items() for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top])}


def mined(spark, docs, **options):
    df = spark.createDataFrame([(1, t, lang, "x", 3) for lang, t in docs], "doc_id long, text string, lang string, phrase string, n int")
    out = C.collocations(df, C.Mining(**options))
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return {tuple(r) for r in out.collect()}


def corpus(n, seed):
    rng = np.random.default_rng(seed)
    vocabulary = ["the", "The", "of", "naïve", "état", "ß", "x\x00y", "internationalisation", "Donaudampfschifffahrt", "a", "b", "日本語"]
    weights = np.arange(len(vocabulary), 0, -1) / sum(range(len(vocabulary) + 1))
    joins = [" ", "  ", "\t", ". ", ",", "\n", " \t "]
    text = lambda: "".join(w + j for w, j in zip(rng.choice(vocabulary, 50, p=weights), rng.choice(joins, 50, p=[0.6, 0.1, 0.1, 0.05, 0.05, 0.05, 0.05]), strict=True))
    return [([None, "en", "de", "und"][rng.integers(4)], text()) for _ in range(n)]


@pytest.mark.parametrize("options", [{}, {"max_n": 2}, {"max_n": 5, "least": 4, "inside": 80}, {"top": 7}, {"inside": 0}])
def test_equals_plain(spark, options):
    docs = [*corpus(120, 4), ("en", None), (None, ""), ("de", "."), ("fr", "only once")]
    got = mined(spark, docs, **options)
    assert got == plain(docs, **options) and len(got) > 3


def test_chunks_and_flushed_keys_change_nothing(spark, monkeypatch):
    docs = corpus(100, 5)
    monkeypatch.setattr(C, "CHUNK", 300)
    monkeypatch.setattr(C, "MOST_KEYS", 50)
    monkeypatch.setattr(C, "LEAST_BITS", 6)
    monkeypatch.setattr(C, "MOST_BITS", 6)  # nearly all phrases pass: they are counted exactly all the same
    assert mined(spark, docs) == plain(docs)


def test_one_language_of_copies_and_a_very_long_text(spark):
    docs = [("en", "alpha beta gamma delta, epsilon zeta")] * 400 + [("en", "lorem ipsum " * 40_000), ("en", "z" * 300_000 + " y")]
    assert mined(spark, docs) == plain(docs)


def test_ties_go_by_bytes_and_cuts_by_the_first(spark):
    docs = [(None, "é f. z y. a b. aa b")] * 12
    got = sorted(mined(spark, docs), key=lambda r: r[1])
    assert [r[2] for r in got] == ["z y", "é f", "a b", "aa b"]
    assert mined(spark, [("q", "a b c")] * 10) == {("q", 1, "a b c", 10, 10, 10, 30, 1_000_000)}


def test_empty_and_bounds(spark):
    assert mined(spark, []) == set() == mined(spark, [("en", None)] * 20)
    for bad in ({"max_n": 1}, {"least": 0}, {"top": 0}):
        with pytest.raises(ValueError):
            C.Mining(**bad)


def test_scores_beyond_64_bits(spark):
    counts = spark.createDataFrame([("en", 1, "a", 3 * 10**12), ("en", 1, "b", 2 * 10**12 + 1), ("en", 2, "a b", 10**12 + 7)], "lang string, words int, phrase string, c long")
    (row,) = C.scored(counts, 3).collect()
    assert row["score"] == 1_000_000 * (10**12 + 7) ** 2 // (3 * 10**12 * (2 * 10**12 + 1))
