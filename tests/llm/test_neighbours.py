"""Recall against brute force, exact scores, and rows that take no part."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.llm import neighbours as N


def plain(rows, k, every=100):
    """{query: [(vec_id, score)]}; rows: (id, vector), ids distinct."""
    fit = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    ids, x = np.array([i for i, _ in fit]), np.array([v for _, v in fit])
    out = {}
    for q in ids[ids % every == 0]:
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
        at = [j for j in np.lexsort((ids, d)) if ids[j] != q][:k]
        out[int(q)] = [(int(ids[j]), float(d[j])) for j in at]
    return out


def found(spark, rows, k=10, every=100, **options):
    df = spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows], "vec_id long, embedding array<float>, rank int, score double")
    out = N.nearest_neighbours(df, F.col("vec_id") % every == 0, N.Search(k=k, **options))
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    got = {}
    for r in sorted(out.collect()):
        got.setdefault(r[0], []).append((r[2], r[3]))
        assert r[1] == len(got[r[0]])
    return got


def recall(got, want):
    return sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) for q, w in want.items()) / sum(map(len, want.values()))


def vectors(n, d, seed, clusters=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    if clusters:
        x = 0.2 * x + rng.normal(size=(clusters, d))[rng.integers(clusters, size=n)]
    return [(i, [float(c) for c in row]) for i, row in enumerate(x.astype(np.float32).tolist())]


@pytest.mark.parametrize(("n", "d", "clusters"), [(3000, 32, 0), (3000, 32, 40), (2000, 7, 0), (1500, 1, 0)])
def test_recall_and_exact_scores(spark, n, d, clusters):
    rows = vectors(n, d, 1, clusters)
    got, want = found(spark, rows, every=20), plain(rows, 10, 20)
    assert set(got) == set(want) and recall(got, want) >= 0.9
    x = dict(rows)
    for q, near in got.items():
        assert len(near) == 10 and near == sorted(near, key=lambda p: (p[1], p[0]))
        for i, score in near:
            assert score == pytest.approx(float(np.sqrt(((np.array(x[q]) - np.array(x[i])) ** 2).sum())), abs=1e-12)


def test_small_blocks_and_chunks_find_the_same(spark, monkeypatch):
    rows = vectors(1200, 16, 2, 5)
    whole = found(spark, rows, every=10)
    monkeypatch.setattr(N, "BLOCK", 40)
    monkeypatch.setattr(N, "CHUNK", 3)
    small = found(spark, rows, every=10)
    assert recall(small, plain(rows, 10, 10)) >= 0.9 and set(small) == set(whole)


def test_a_third_of_copies_and_ties(spark):
    rows = vectors(300, 8, 3) + [(1000 + i, [1.0] * 8) for i in range(150)] + [(2000, [1.0] * 8), (2100, [-0.0] + [1.0] * 7), (2101, [0.0] + [1.0] * 7)]
    got = found(spark, rows, k=5)
    assert got[2000] == [(i, 0.0) for i in range(1000, 1005)] and got[1000] == [(i, 0.0) for i in range(1001, 1006)]
    assert got[2100][0] == (2101, 0.0)


def test_rows_that_take_no_part(spark):
    bad = [(100, None), (200, [0.0] * 4), (300, [1.0, None, 1.0, 1.0]), (400, [float("nan")] * 4), (500, [float("inf"), 0.0, 0.0, 0.0]), (600, []), (None, [1.0] * 4), (700, [1.0] * 5)]
    good = [(0, [1.0, 0.0, 0.0, 0.0]), (1, [0.0, 1.0, 0.0, 0.0]), (2, [1.0, 0.5, 0.0, 0.0])]
    assert found(spark, bad + good) == {0: [(2, 0.5), (1, pytest.approx(2**0.5))]}
    assert found(spark, bad) == {700: []} or found(spark, bad) == {}
    assert found(spark, []) == {} == found(spark, [(0, [1.0, 2.0])])


def test_repeated_rows_and_ids(spark):
    rows = [(0, [1.0, 0.0])] * 30 + [(1, [1.0, 0.1])] * 30 + [(2, [0.0, 1.0]), (2, [1.0, 0.2])]
    assert [i for i, _ in found(spark, rows, k=3)[0]] == [1, 2, 2]


def test_block_plan_covers_each_list_apart():
    sizes = np.array([0, 10, 8000, 300, 20_000, 5, 8192, 0])
    first, number = N.block_plan(sizes)
    load = {}
    for s, f, n in zip(sizes.tolist(), first.tolist(), number.tolist(), strict=True):
        for b in range(f, f + n):
            load[b] = load.get(b, 0) + -(-s // n)
    assert max(load.values()) <= N.BLOCK and number.tolist() == [1, 1, 1, 1, 3, 1, 1, 1]


def test_bounds():
    for bad in ({"k": 0}, {"codes": 257}, {"part": 0}):
        with pytest.raises(ValueError):
            N.Search(**bad)
