"""Radix selection against sorting, and the whole draw against a plain rendering."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lectern.llm import importance as I

LONG = 2**63


def plain(docs, target, percent=10, least=20, most=1, buckets=10_000, seed=2024):
    """docs: (id, text); the rows as the operator has them, by sorting everything."""
    words = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    features = lambda ws: [" ".join(ws[i : i + m]) for m in range(1, most + 1) for i in range(len(ws) - m + 1)]
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    own, goal = [features(words(t)) for _, t in docs], [features(words(t)) for t in target]
    s, t = Counter(bucket(f) for fs in own for f in fs), Counter(bucket(f) for fs in goal for f in fs)
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log(float(t[b] + 1) * (all_s + buckets) / (float(s[b] + 1) * (all_t + buckets))))
    rows = []
    for (i, text), fs in zip(docs, own, strict=True):
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(bucket(f)) for f in fs)
        rows.append([i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words(text)) >= least])
    able = sorted((r for r in rows if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for n, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = n + 1
    return [tuple(r[:5]) for r in rows]


def drawn(spark, docs, target, **options):
    d = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, _id int, rank int")
    out = I.resample(d, spark.createDataFrame([(t,) for t in target], "text string"), **options)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"] and {t for _, t in out.dtypes} == {"bigint"}
    return [tuple(r) for r in out.collect()]


KEY = lambda r: tuple((x is None, x or 0) for x in r)


def texts(n, seed):
    rng, vocabulary = np.random.default_rng(seed), ["Straße", "wörter", "THE", "of", "a1", "naïve", "x-y", "end.", "ÉTÉ"]
    return [" ".join(rng.choice(vocabulary, rng.integers(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("most", [1, 2])
def test_equals_plain(spark, most):
    docs = [(int(i), t) for i, t in zip(np.random.default_rng(1).permutation(300) - 100, texts(300, 2), strict=True)]
    docs += [(500, None), (501, ""), (502, "word " * 30_000), (503, "..."), (-(2**62), docs[0][1]), (2**62, docs[0][1])]
    goal = [*texts(20, 3), None, ""]
    got = drawn(spark, docs, goal, features=I.Features(most, 1000), percent=30)
    assert sorted(got, key=KEY) == sorted(plain(docs, goal, 30, most=most, buckets=1000), key=KEY)


def test_repeated_rows_null_ids_and_ties_draw_exactly_as_many(spark):
    text = "one two three four five six seven eight nine ten " * 3
    docs = [(7, text)] * 200 + [(None, text)] * 50 + [(i, text) for i in range(10)] + [(99, "short")] * 40
    got, want = drawn(spark, docs, ["one two"], percent=25), plain(docs, ["one two"], 25)
    assert sorted(got, key=KEY) == sorted(want, key=KEY)
    ranks = sorted(r[4] for r in got if r[4])
    assert ranks == list(range(1, 260 * 25 // 100 + 1))


def test_empty_tables(spark):
    assert drawn(spark, [], ["a b"]) == []
    docs = [(i, "w " * 25) for i in range(20)]
    assert sorted(drawn(spark, docs, []), key=KEY) == sorted(plain(docs, []), key=KEY)
    assert [r[4] for r in drawn(spark, docs[:5], ["w"])] == [None] * 5  # a tenth of five is none


def test_bounds():
    with pytest.raises(ValueError):
        I.Features(0)
    with pytest.raises(ValueError):
        I.Features(1, I.MOST_BUCKETS + 1)


@given(st.lists(st.tuples(st.sampled_from([-LONG, -5, -1, 0, 1, 7, 4096, LONG - 1]), st.integers(-LONG, LONG - 1)), min_size=1, max_size=40), st.integers(0, 45))
@settings(max_examples=12, deadline=None)
def test_first_k_is_a_prefix_of_the_order(spark, pairs, k):
    rows = [(a, b, i) for i, (a, b) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "a long, b long, i long").coalesce(1)
    got = {tuple(r) for r in df.filter(I.first_k(df, ["a", "b", "i"], k)).collect()}
    assert got == set(sorted(rows)[:k])


def test_rounds_count_digits_only(spark, monkeypatch):
    """A draw among 40,000 rows of one score brings no more than a digit's counts to the driver."""
    df = spark.range(40_000).select(F.lit(5).cast("long").alias("a"), F.col("id").alias("b"))
    assert df.filter(I.first_k(df, ["a", "b"], 12_345)).agg(F.count("*"), F.max("b")).first() == (12_345, 12_344)
