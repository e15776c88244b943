"""Titles with very many copies, and very long ones: what is made for them grows with the rows."""

import random
import time

from pyspark.sql import functions as F

from lectern.functions import agreement as A
from lectern.operators import ladder, scoring, worklists
from lectern.operators import linkage as L


def copies(spark, n):
    rows = [(i, "Doe, J.", f"Old stone gardens of the kyoto hills{' 2' * (i % 9 == 0)}", 1880 + i % 4, "book", i <= n // 3) for i in range(1, n + 1)]
    return L.items(spark.createDataFrame(rows, "ord long, author string, title string, year int, kind string, existing boolean"))


def test_edges_of_copies_grow_with_the_rows(spark):
    """400 rows of eight forms; all pairs were 60,000 edges."""
    assert L.candidate_edges(copies(spark, 400)).count() < 400 * 2 * 16


def test_two_titles_are_compared_once(spark, monkeypatch):
    """40 rows of two titles were some 700 comparisons."""
    seen, real = [], L.with_same_title
    monkeypatch.setattr(L, "with_same_title", lambda df, *a: seen.append(df.select("r_tk", "t_tk", "strict")) or real(df, *a), raising=False)
    rows = [(i, "Doe, J.", f"Old stone gardens of the {('kyoto', 'kyoro')[i % 2]} hills", 1880 + i % 4, "book", False) for i in range(40)]
    it = L.items(spark.createDataFrame(rows, "ord long, author string, title string, year int, kind string, existing boolean"))
    assert L.candidate_edges(it).filter("stage = 1").select("r_ord").distinct().count() == 39
    assert 2 <= seen[0].count() <= 4


def test_titles_without_years_meet_only_as_equals(spark):
    """All 45 pairs met, to be dropped where titles are compared."""
    rows = [(i, "Doe, J.", f"Old stone gardens {'abcde'[i // 2] * 6}", None, "book", False) for i in range(10)]
    it = L.rarest_first(L.items(spark.createDataFrame(rows, "ord long, author string, title string, year int, kind string, existing boolean")), "ord", "toks")
    assert sorted(map(tuple, L._paired(*L._sides(it), "r_sur", "t_sur").collect())) == [(i, i - 1) for i in range(1, 10, 2)]


def test_rows_of_one_title_are_those_that_same_title_has(spark):
    words = "old stone gardens garden of the kyoto kyoro hills 1 2 in colour".split()
    rnd = random.Random(4)
    full = [" ".join(rnd.choices(words, k=rnd.randint(1, 9))) for _ in range(150)]
    pairs = [(i, x, y, x + " by roe" * (i % 3), y + " by ros" * (i % 2), i % 4 == 0) for i, (x, y) in enumerate((x, (x + " hills", x.replace("o", "e", 1), y)[i % 3]) for i, (x, y) in enumerate(zip(full, full[1:], strict=False)))]
    df = spark.createDataFrame(pairs, "n int, a string, b string, fa string, fb string, strict boolean")
    want = {r.n for r in df.filter(A.same_title(*map(F.col, ("a", "b", "fa", "fb", "strict")))).collect()}
    got = [r.n for r in A.with_same_title(df, ["n"], "a", "b", "fa", "fb", "strict").collect()]
    assert sorted(got) == sorted(want) and 40 < len(want) < 149


def test_nearest_of_copies_is_that_of_all_pairs(spark):
    it = copies(spark, 60)
    got = {tuple(r) for r in L.nearest_exact(it).collect()}
    record, target = L._sides(it)
    want = {}
    for r in L.exact_edges(record, target, 20).collect():
        want[r.r_ord] = min(want.get(r.r_ord, (99, 99)), (r.d, r.t_ord))
    assert got == {(r, t, d) for r, (d, t) in want.items()} and len(got) == 40


def test_rungs_that_ask_for_an_equal_column(spark):
    corpus = spark.createDataFrame([(i, ["a", "b", "c"][: 2 + i % 2], "xy"[i % 3 == 0]) for i in range(12)], "candidate long, words array<string>, c_source string")
    records = corpus.toDF("record", "words", "source")
    other = F.col("record") != F.col("candidate")
    one = ladder.word_rung(corpus, 4, also=other, same=("source", "c_source"))(records)
    all_ = ladder.word_rung(corpus, 4, also=other & (F.col("source") == F.col("c_source")))(records)
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(one) == rows(all_) and len(rows(one)) > 20


def test_each_offer_is_compared_once(spark):
    made = spark.createDataFrame([("a b", "a b", "c", "A b", "C")], "main string, full string, surname string, c_title string, c_creator string")
    plan = worklists.scored(made)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_points_of_a_very_long_title(spark):
    title = " ".join(f"word{i % 15000}" for i in range(20000))
    row = spark.createDataFrame([(title,)], "t string")
    began = time.time()
    got = row.select(scoring.points(scoring.RULES["gallica"], F.col("t"), F.lit(""), F.array().cast("array<int>"), F.lit(title), F.lit(""), F.lit(None).cast("int")).alias("p")).first()["p"]
    assert got["points"] == 2 and time.time() - began < 30
