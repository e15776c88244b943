"""Budgets by hand and against brute force over all rows."""

import math
import random
import re
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lectern.llm import mixing as M


def test_shortage_goes_to_siblings_before_ancestors():
    totals = {("a", "x"): 10, ("a", "y"): 1000, ("b", "x"): 1000, ("b", "y"): 1000}
    got = M.leaf_budgets(totals, 800, {}, 1.0)
    assert got == {("a", "x"): 10, ("a", "y"): 390, ("b", "x"): 200, ("b", "y"): 200}
    # a whole family short: the rest reaches the other family
    got = M.leaf_budgets({("a", "x"): 10, ("a", "y"): 20, ("b", "x"): 1000}, 400, {}, 1.0)
    assert got == {("a", "x"): 10, ("a", "y"): 20, ("b", "x"): 370}


def test_weights_epochs_and_rounding():
    assert M.leaf_budgets({("a",): 100, ("b",): 100}, 150, {("a",): 2.0}, 1.0) == {("a",): 100, ("b",): 50}
    assert M.leaf_budgets({("a",): 100, ("b",): 1000}, 900, {("a",): 8.0}, 3.0) == {("a",): 300, ("b",): 600}
    assert sum(M.leaf_budgets({(i,): 1000 for i in range(7)}, 100, {}, 1.0).values()) == 100
    assert M.leaf_budgets({("a",): 5, ("b",): 5}, 100, {("a",): 0.0}, 1.0) == {("a",): 0, ("b",): 5}
    assert M.leaf_budgets({}, 100, {}, 1.0) == {}


def poured(totals, budget, weights, epochs, path=()):
    """Budgets by another way: the level to which a family's vessels are filled, in fractions, found by halving; then whole tokens."""
    able = lambda p: int(totals[p] * Fraction(epochs)) if p in totals else sum(able(c) for c in below(p) if weight(c) > 0)
    below = lambda p: sorted({q[: len(p) + 1] for q in totals if q[: len(p)] == p and len(q) > len(p)})
    weight = lambda p: Fraction(weights.get(p, 1.0))
    if path in totals:
        return {path: min(budget, able(path))}
    family = [c for c in below(path) if weight(c) > 0]
    own = min(budget, sum(map(able, family)))
    low, high = Fraction(0), Fraction(1 + max([0, *(able(c) / weight(c) for c in family)]))
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if sum(min(able(c), middle * weight(c)) for c in family) <= own else (low, middle)
    exact = {c: min(Fraction(able(c)), low * weight(c)) for c in family}
    exact = {c: Fraction(round(x)) if abs(x - round(x)) < Fraction(1, 10**9) else x for c, x in exact.items()}
    got = {c: math.floor(x) for c, x in exact.items()}
    for c in sorted(family, key=lambda c: (got[c] - exact[c], c))[: own - sum(got.values())]:
        got[c] += 1
    out = {q: 0 for q in totals if q[: len(path)] == path}
    for c in family:
        out |= poured(totals, got[c], weights, epochs, c)
    return out


def test_budget_under_a_weight_of_nothing_goes_to_others():
    totals = {("a", "x"): 100, ("a", "y"): 1000, ("b", "z"): 1000}
    assert M.leaf_budgets(totals, 1000, {("a", "y"): 0.0}, 1.0) == {("a", "x"): 100, ("a", "y"): 0, ("b", "z"): 900}
    deep = {("a", "x", "1"): 50, ("a", "x", "2"): 500, ("a", "y", "1"): 70, ("b", "z", "1"): 900}
    assert M.leaf_budgets(deep, 600, {("a", "x", "2"): 0.0, ("a", "y"): 0.0}, 1.0) == {("a", "x", "1"): 50, ("a", "x", "2"): 0, ("a", "y", "1"): 0, ("b", "z", "1"): 550}


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10**6), st.integers(0, 4000))
def test_budgets_equal_poured_ones(seed, budget):
    r = random.Random(seed)
    totals = {(a, b, c): r.choice([0, 1, 10, 300, 1000]) for a in "ab" for b in "xyz"[: r.randint(1, 3)] for c in "12"[: r.randint(1, 2)]}
    weights = {p[:d]: r.choice([0.0, 0.5, 1.0, 3.0]) for p in totals for d in (1, 2, 3) if r.random() < 0.5}
    got, want = M.leaf_budgets(totals, budget, weights, 1.5), poured(totals, budget, weights, 1.5)
    top = sum(max(0, int(1.5 * t)) for p, t in totals.items() if all(weights.get(p[:d], 1.0) > 0 for d in (1, 2, 3)))
    assert got.keys() == want.keys() and sum(got.values()) == sum(want.values()) == min(budget, top)
    assert all(abs(got[p] - want[p]) <= 2 for p in got)  # halves may be rounded to either neighbour, on each level


def rows(n):
    r = random.Random(3)
    out = [(i, " ".join("w" * r.randint(1, 3) for _ in range(r.choice([0, 1, 5, 40]))), r.choice(["en", "de", None]), r.choice(["s0", "s0", "s0", "s1", "s2"]), "clash", 7) for i in range(n)]
    return [*out, (5000, "long " * 20_000, "en", "s1", "clash", 7), (5001, None, "en", "s1", "clash", 7), (None, "no id here", "de", "s2", "clash", 7), (5002, "twice twice", "en", "s0", "clash", 7), (5002, "twice twice", "en", "s0", "clash", 7)]


SCHEMA = "doc_id long, text string, lang string, source string, tokens string, copies int"


@pytest.mark.parametrize(("n", "share", "epochs"), [(400, 0.5, 1.0), (400, 0.9, 2.5), (60, 0.2, 1.0), (0, 1.0, 1.0)])
def test_mix_equals_brute_force(spark, n, share, epochs):
    data = rows(n)
    docs = spark.createDataFrame(data, SCHEMA)
    levels = {"lang": F.col("lang"), "source": F.col("source")}
    weights = {("en",): 2.0, ("de", "s0"): 3.0}
    got = M.mix(docs, levels, weights, budget_share=share, max_epochs=epochs, seed=4).collect()
    assert len(got) == len(data)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    totals = {}
    for _, t, lang, s, *_ in data:
        totals[(lang or "", s)] = totals.get((lang or "", s), 0) + size(t)
    budgets = poured(totals, int(sum(totals.values()) * share), weights, epochs)
    keyed = spark.createDataFrame([(i, t, lang or "", s, budgets[lang or "", s] // max(1, totals[lang or "", s])) for i, t, lang, s, *_ in data], "i long, t string, l string, s string, f long").withColumn("x", F.xxhash64(F.coalesce("t", F.lit("")))).withColumn("h", F.xxhash64(F.lit(4), "f", "i", "x")).collect()
    for leaf, own in budgets.items():
        mine = sorted((r.h, r.x, size(r.t), r.i) for r in keyed if (r.l, r.s) == leaf)
        full, rest = (own // totals[leaf], own % totals[leaf]) if totals[leaf] else (0, 0)
        want, upto = {}, {}
        for k in {m[:2] for m in mine}:
            upto[k] = sum(m[2] for m in mine if m[:2] <= k)
        for h, x, _, i in mine:
            want[i] = full + int(rest > 0 and upto[h, x] <= rest)
        here = {r.doc_id: r.copies for r in got if ((r.lang or ""), r.source) == leaf}
        assert here == want
        spent = sum(size(r.text) * r.copies for r in got if ((r.lang or ""), r.source) == leaf)
        assert spent <= own


def test_mixed_repeats_rows_and_keeps_columns(spark):
    docs = spark.createDataFrame(rows(100), SCHEMA)
    levels = {"lang": F.col("lang")}
    counted = M.mix(docs, levels, budget_share=1.6, max_epochs=2.0, out_col="k")
    out = M.mixed(docs, levels, budget_share=1.6, max_epochs=2.0)
    assert out.columns == docs.columns and out.count() == counted.agg(F.sum("k")).first()[0]
    assert M.mixed(docs.limit(0), levels).collect() == []
