"""Components against all pairs, the bounds of the signatures, and the search itself."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lectern.llm import jaccard_join as J
from lectern.llm.common import combined
from lectern.operators import graph as C


def shingle_set(text, size=3):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else " " if c in "\t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w]
    if not words:
        return set()
    size = min(size, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute(rows, percent=90, size=3):
    sets = [shingle_set(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and min(len(sets[i]), len(sets[j])) * 100 >= percent * max(len(sets[i]), len(sets[j])):
                common = len(sets[i] & sets[j])
                if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                    parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        root = find(i)
        least[root] = doc if least.get(root) is None else least[root] if doc is None else min(doc, least[root])
    return sorted(((doc, len(s), least[find(i)] if s else doc) for i, ((doc, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def corpus(seed, n):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeXYZ") for _ in range(r.randint(1, 5)))
    passage = [word() for _ in range(40)]
    out, i = [], 0
    while len(out) < n:
        base = [word() for _ in range(r.choice([0, 1, 2, 3, 5, 9, 12, 40, 80, 200]))]
        if r.random() < 0.4:
            base += passage
        for _ in range(r.choice([1, 1, 2, 6])):
            own = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 4])):
                if own:
                    own[r.randrange(len(own))] = word()
            out.append((i, r.choice([" ", "\n", " \t "]).join(own)))
            i += r.randint(1, 3)
    blob = [word() for _ in range(150)]
    for _ in range(40):  # near copies whose likeness is about the threshold
        own = list(blob)
        for _ in range(r.randint(1, 4)):
            own[r.randrange(len(own))] = word()
        out.append((i, " ".join(own)))
        i += 1
    r.shuffle(out)
    return out


@pytest.mark.parametrize("seed", [5, 6])
def test_components_at_four_fifths_on_five_words(spark, seed):
    rows = [*corpus(seed, 200), (100_000, None), (100_001, "one two"), (100_002, "ONE two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.jaccard_components(docs, 80, 5, block=3000).collect()), key=repr)
    assert got == brute(rows, 80, 5)


@pytest.mark.parametrize(("seed", "block"), [(1, J.BLOCK), (2, 400)])
def test_components_equal_all_pairs(spark, seed, block):
    rows = [*corpus(seed, 160), (100_000, None), (100_001, ""), (None, "no id " * 5), (None, None), (100_002, "Repeated ROW"), (100_002, "repeated row"), (100_003, "word " * 30_000)]
    docs = spark.createDataFrame([(*r, b"x", "y") for r in rows], "doc_id long, text string, key binary, node string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.jaccard_components(docs, block=block).collect()), key=repr)
    assert got == brute(rows)


def test_empty_table(spark):
    assert J.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 400), st.integers(0, 30), st.integers(0, 30), st.integers(0, 10**6), st.sampled_from([90, 80, 50]))
def test_linked_sets_share_a_signature(common, only_a, only_b, seed, percent):
    t = J.Threshold(percent)
    rng = np.random.default_rng(seed)
    pool = np.unique(rng.integers(0, 2**64, common + only_a + only_b, dtype=np.uint64))
    rng.shuffle(pool)
    a, b = np.sort(np.concatenate([pool[:common], pool[common : common + only_a]])), np.sort(np.concatenate([pool[:common], pool[common + only_a :]]))
    if t.linked(common, len(a), len(b)) and not np.array_equal(a, b):
        assert len(np.intersect1d(J.signatures(a, t), J.signatures(b, t)))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 15), unique=True), min_size=1, max_size=12), st.integers(1, 12))
def test_divide_skip_counts(lists, need):
    sets = [np.array(sorted(x), np.int64) for x in lists]
    items, counts = J.divide_skip(sets, need)
    want = {k: n for k in range(16) if (n := sum(k in x for x in lists)) >= need}
    assert dict(zip(items.tolist(), counts.tolist(), strict=True)) == want


def test_combined_signatures_keep_all():
    r = np.random.default_rng(4)
    sigs = [np.unique(r.integers(0, 40, r.integers(0, 6))).astype(np.uint64) for _ in range(30)]
    own, followed, more, firsts = (x.to_pylist() for x in combined(sigs, 1000))
    first = {}
    for i, x in enumerate(sigs):
        assert sorted(own[i]) == sorted(v for v in x.tolist() if v not in first)
        assert sorted(zip(more[i], firsts[i], strict=True)) == sorted((v, 1000 + first[v]) for v in x.tolist() if v in first)
        for v in x.tolist():
            first.setdefault(v, i)
    count = {v: sum(v in x for x in sigs) for v in first}
    assert all(f == (count[v] > 1) for x, y in zip(own, followed, strict=True) for v, f in zip(x, y, strict=True))
    assert [x.to_pylist() for x in combined([], 0)] == [[], [], [], []]


def test_candidates_share_a_leader(spark):
    """Rows of one signature have one leader, in whatever pieces and tasks they are."""
    r = np.random.default_rng(2)
    sigs = [np.unique(r.integers(0, 60, r.integers(0, 5))).astype(np.uint64) for _ in range(200)]
    rows = []
    for at in range(0, 200, 40):
        lists = [x.to_pylist() for x in combined(sigs[at : at + 40], at)]
        rows += [(at + i, *(x[i] for x in lists)) for i in range(40)]
    table = spark.createDataFrame(rows, "row long, sigs array<long>, followed array<boolean>, more array<long>, firsts array<long>")
    got = {(x.row, x.leader) for x in J.candidates(table).collect()}
    holders = {v: [i for i, x in enumerate(sigs) if v in x] for v in range(60)}
    assert got == {(i, h[0]) for h in holders.values() for i in h[1:]}


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.component for r in C.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{i: 100 for i in range(100, 140)}, 200: 200, 201: 200}
    assert C.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_one_id_or_none_brings_no_other_rows_text(spark, monkeypatch):
    """2,000 near copies without an id, 300 of one id: no more texts are searched than there are in clusters."""
    base = " ".join(f"w{i}" for i in range(80))
    rows = [(None, f"{base} x{i}") for i in range(2000)] + [(7, f"{base} y{i}") for i in range(300)] + [(7, "alone here now")]
    sent, real = [], J.links

    def counted(members, size, t):
        sent.append(members.select("node").count())
        return real(members, size, t)

    monkeypatch.setattr(J, "links", counted)
    out = J.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sent[0] <= 2 * len(rows)
    assert {r.component_id for r in out} == {7} and len(out) == len(rows)
