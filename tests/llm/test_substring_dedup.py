"""Planted passages against what is found, chains against all orders, alignments against a plain table."""

import difflib
import itertools
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lectern.llm import substring_dedup as S
from lectern.llm.common import word_hashes


def words(r, n):
    return ["".join(r.choice("abcdefghijklmné") for _ in range(r.randint(3, 9))) for _ in range(n)]


def fuzzy(r, passage, edits):
    out = list(passage)
    for i in sorted(r.sample(range(8, len(out) - 8), edits), reverse=True):
        kind = r.choice("rid")
        if kind == "r":
            out[i] = "".join(r.choice("xyz") for _ in range(6))
        elif kind == "i":
            out.insert(i, "".join(r.choice("xyz") for _ in range(6)))
        else:
            del out[i]
    return out


@pytest.fixture(scope="module")
def found(spark):
    r = random.Random(11)
    texts, planted, doc = {}, {}, 0
    for p in range(6):  # a passage each, in several documents, exact or with edits
        passage = words(r, r.choice([60, 90, 200]))
        for copy in range(r.choice([2, 3, 12])):
            body = fuzzy(r, passage, copy % 4 if p else 0)
            texts[doc] = " ".join([*words(r, r.randint(5, 80)), *body, *words(r, r.randint(5, 80))])
            planted.setdefault(p, {})[doc] = " ".join(body)
            doc += 1
    line = words(r, 15)
    for _ in range(2):
        texts[doc] = " ".join([*words(r, 10), *(line * 6), *words(r, 10)])  # a repeated line, long in all
        planted.setdefault("line", {})[doc] = " ".join(line * 6)
        doc += 1
    short = words(r, 30)
    clean = []
    for _ in range(8):  # under the least length
        texts[doc] = "\n".join([*words(r, 60), *short, *words(r, 60)])
        clean.append(doc)
        doc += 1
    whole = words(r, 70)
    copies = [doc, doc + 1, doc + 2]
    texts |= {doc: " ".join(whole), doc + 1: "\n".join(w.upper() if w.isascii() else w for w in whole), doc + 2: "  ".join(whole)}
    doc += 3
    texts |= {doc: None, doc + 1: "", doc + 2: " ".join(words(r, 20_000))}
    clean += [doc, doc + 1, doc + 2]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in texts.items()], "doc_id long, text string, seed int, node string")
    return texts, planted, clean, copies, S.repeated_passages(docs).collect()


def test_planted_passages_are_found_but_for_one_source_each(found):
    texts, planted, _, _, rows = found
    for docs in planted.values():
        missing = []
        for doc, body in docs.items():
            start = texts[doc].index(body)
            covered = max((min(r.end, start + len(body)) - max(r.start, start) for r in rows if r.doc_id == doc), default=0)
            if covered < 0.85 * len(body):
                missing.append(doc)
        assert len(missing) == 1
        assert any(r.source_id == missing[0] for r in rows)


def test_clean_documents_are_left_alone(found):
    _, _, clean, _, rows = found
    assert not {r.doc_id for r in rows} & set(clean)


def test_copies_are_whole_passages_of_the_smallest_id(found):
    texts, _, _, copies, rows = found
    mine = [r for r in rows if r.doc_id in copies]
    assert sorted(r.doc_id for r in mine) == copies[1:]
    assert all((r.source_id, r.start, r.end, r.group_size, r.identity) == (copies[0], 0, len(texts[r.doc_id]), 3, 1.0) for r in mine)


def test_spans_are_whole_words_and_agree(found):
    texts, _, copies, _, rows = found
    for r in rows:
        a, b = texts[r.doc_id][r.start : r.end].lower().split(), texts[r.source_id][r.source_start : r.source_end].lower().split()
        assert r.n_words == len(a) >= S.MIN_WORDS
        assert difflib.SequenceMatcher(None, a, b, autojunk=False).ratio() > 0.6


def test_defined_cases(spark):
    schema = "doc_id long, text string"
    assert S.repeated_passages(spark.createDataFrame([], schema)).collect() == []
    long = " ".join(f"w{i}" for i in range(80))
    rows = S.repeated_passages(spark.createDataFrame([(None, long), (5, long), (5, long), (6, long + " tail"), (6, "other")], schema)).collect()
    assert {r.doc_id for r in rows} <= {None, 5, 6} and any(r.doc_id is None and r.source_id == 5 for r in rows)


def spans(texts, rows, body):
    """Documents in which a listed passage covers all of body."""
    return [i for i, t in texts.items() if any(r.start <= t.index(body) and t.index(body) + len(body) <= r.end for r in rows if r.doc_id == i)]


def test_passages_around_another_middle_are_both_found(spark):
    r = random.Random(3)
    pairs, texts = [], {}
    for middle in (30, 45, 60, 90, 120):  # half to twice the passage, in both documents or inserted in one
        for one in (True, False):
            head, foot = words(r, 60), words(r, 60)
            pairs.append((2 * len(pairs), " ".join(head), " ".join(foot)))
            for side in (0, 1):
                own = [] if one and side else words(r, middle)
                texts[pairs[-1][0] + side] = " ".join([*words(r, 20), *head, *own, *foot, *words(r, 20)])
    rows = S.repeated_passages(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    for first, head, foot in pairs:
        mine = {i: texts[i] for i in (first, first + 1)}
        assert len(spans(mine, rows, head)) == len(spans(mine, rows, foot)) == 1


def test_passages_with_a_word_in_ten_or_eight_changed_are_found(spark):
    r = random.Random(5)
    texts, bodies = {}, []
    for k in range(20):
        passage = words(r, 60)
        other = [f"x{k}" if i % (10 if k % 2 else 8) == 3 else w for i, w in enumerate(passage)]
        bodies.append((" ".join(passage), " ".join(other)))
        for side, body in enumerate(bodies[-1]):
            texts[2 * k + side] = " ".join([*words(r, 20), body, *words(r, 20)])
    rows = S.repeated_passages(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    most = lambda i, body: max((min(r.end, texts[i].index(body) + len(body)) - max(r.start, texts[i].index(body)) for r in rows if r.doc_id == i), default=0)
    assert all(max(most(2 * k, a) / len(a), most(2 * k + 1, b) / len(b)) > 0.8 for k, (a, b) in enumerate(bodies))


def test_each_copy_within_a_document_is_found(spark):
    r = random.Random(8)
    texts, bodies = {}, []
    for k in range(12):  # the passage once in one document, three times in the other, either of which may lead
        bodies.append(" ".join(words(r, 60)))
        texts[2 * k] = " ".join([*words(r, 20), bodies[k], *words(r, 20)])
        texts[2 * k + 1] = " ".join(x for _ in range(3) for x in [*words(r, 20), bodies[k]])
    texts[100], texts[101] = " ".join(["again"] * 3000), " ".join(["again"] * 100)  # one word: places are bounded
    assert len(S.seeds_of(S.words_of(texts[100].encode()))[0]) < 3000 * (1 + 1 / S.K) + 1
    rows = S.repeated_passages(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    for k, body in enumerate(bodies):
        mine = [x for x in rows if x.doc_id in (2 * k, 2 * k + 1)]
        if any(x.doc_id == 2 * k for x in mine):
            continue  # the document with three copies leads
        at = [i for i in range(len(texts[2 * k + 1])) if texts[2 * k + 1].startswith(body, i)]
        assert len(at) == 3 and all(any(x.start <= i and i + len(body) <= x.end for x in mine) for i in at)
    assert sum(not any(x.doc_id == 2 * k for x in rows) for k in range(12)) > 2


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 60), st.integers(8, 20)), min_size=1, max_size=6, unique=True))
def test_best_chain_is_best_of_all_orders(segments):
    def worth(chain):
        return sum(n / 3 for _, _, n in chain) - sum(S.GAP * (y[0] - x[0] - x[2] + y[1] - x[1] - x[2]) for x, y in itertools.pairwise(chain))

    fits = lambda c: all(x[0] + x[2] <= y[0] and x[1] + x[2] <= y[1] for x, y in itertools.pairwise(c))
    best = max(worth(c) for k in range(1, len(segments) + 1) for c in itertools.permutations(segments, k) if fits(c))
    chains = S.chains_of(segments)
    assert worth(chains[0]) == pytest.approx(best) and all(map(fits, chains))
    assert sorted(x for c in chains for x in c) == sorted(segments)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=9), st.lists(st.integers(0, 3), max_size=9))
def test_edit_matches(a, b):
    table = {}
    for i, j in itertools.product(range(len(a) + 1), range(len(b) + 1)):
        if not i or not j:
            table[i, j] = i + j
        else:
            table[i, j] = min(table[i - 1, j - 1] + (a[i - 1] != b[j - 1]), table[i - 1, j] + 1, table[i, j - 1] + 1)
    got = S.edit_matches(np.array(a, np.uint64), np.array(b, np.uint64))
    most = {}  # the most agreeing words among alignments of least distance
    for i, j in itertools.product(range(len(a) + 1), range(len(b) + 1)):
        ways = [most[x, y] for x, y in ((i - 1, j), (i, j - 1)) if x >= 0 and y >= 0 and table[i, j] == table[x, y] + 1]
        if i and j and table[i, j] == table[i - 1, j - 1] + (a[i - 1] != b[j - 1]):
            ways.append(most[i - 1, j - 1] + (a[i - 1] == b[j - 1]))
        most[i, j] = max(ways, default=0)
    assert got == most[len(a), len(b)]
    assert 0 <= got <= difflib.SequenceMatcher(None, a, b).real_quick_ratio() * (len(a) + len(b)) / 2 + 1e-9
    assert table[len(a), len(b)] >= max(len(a), len(b)) - got


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="abAB é\t\n\x0b\x00\x1f\xa0😀", max_size=60).map(str.encode), max_size=5))
def test_word_hashes_are_of_words(texts):
    got, at = word_hashes(texts)
    assert len(at) == len(texts) + 1
    of = {}
    for i, text in enumerate(texts):
        words = text.lower().split()
        assert at[i + 1] - at[i] == len(words) and np.array_equal(got[at[i] : at[i + 1]], S.words_of(text))
        for word, value in zip(words, got[at[i] : at[i + 1]].tolist(), strict=True):
            assert of.setdefault(word, value) == value
    assert len(set(of.values())) == len(of)


def test_chains_done_together_equal_those_done_one_by_one():
    import pyarrow as pa

    r = np.random.default_rng(8)
    rows, want = [], []
    for chain in range(600):
        shared = r.integers(10, 2**31, 45)
        a, b, at = [], [], []
        for one in (a, b):  # equal words on both sides of a seed of five, of which some are changed in either
            x, before = shared.copy(), r.integers(0, 4, r.integers(0, 30))
            places = r.integers(0, 45, r.integers(0, 50))
            x[places[(places < 20) | (places >= 25)]] = r.integers(0, 4)
            one += [*before.tolist(), *x.tolist(), *r.integers(0, 4, r.integers(0, 30)).tolist()]
            at.append(len(before) + 20)
        a, b = np.array(a, "<u4"), np.array(b, "<u4")
        low, high = (int(v) for v in r.integers(0, 30, 2))
        cuts = [(max(0, p - low), min(len(x), p + 5 + high)) for x, p in zip((a, b), at, strict=True)]
        for k, (x, p, (lo, hi)) in enumerate(zip((a, b), at, cuts, strict=True)):
            rows.append((chain, k, 100 + k, lo, len(x) - hi, [at[0], at[1], 5] if k == 0 else None, x[lo:hi].tobytes()))
        found = S.aligned([(at[0] - cuts[0][0], at[1] - cuts[1][0], 5)], a[slice(*cuts[0])], b[slice(*cuts[1])], (cuts[0][0] > 0, cuts[1][0] > 0, cuts[0][1] < len(a), cuts[1][1] < len(b)))
        want += [(chain, 100, 101, None, None, None, None, None)] if found is None else [(chain, 100, 101, cuts[0][0] + i, cuts[0][0] + j, cuts[1][0] + x, cuts[1][0] + y, same) for i, j, x, y, same in found]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.binary()]
    order = r.permutation(len(rows))  # sorted by chain only, in whatever order the sides come
    rows = sorted((rows[i] for i in order), key=lambda x: x[0])
    batch = pa.RecordBatch.from_arrays([pa.array([x[k] for x in rows], t) for k, t in enumerate(kinds)], names=list("abcdefg"))
    names = ["chain", "node", "lead", "from", "to", "lead_from", "lead_to", "agree"]
    got = S._aligned_rows(batch, names).to_pylist()
    assert len(want) > 200 and sorted((tuple(x[n] for n in names) for x in got), key=repr) == sorted(want, key=repr)
    again = S._aligned_rows(pa.RecordBatch.from_arrays([c.take(pa.array(np.repeat(np.arange(len(rows)), 2))) for c in batch.columns], names=list("abcdefg")), names)
    assert again.num_rows == len(got) and S._aligned_rows(batch.slice(0, 0), names).num_rows == 0


def test_long_alignments():
    import time

    r = np.random.default_rng(3)
    a = r.integers(0, 2**63, 3000).astype(np.uint64)
    b = np.delete(np.insert(a, [100, 900, 2500], 7), [50, 1500])
    began = time.time()
    assert S.edit_matches(a, b) == 2998
    assert S.edit_matches(a, r.integers(0, 2**63, 3000).astype(np.uint64)) == 0
    assert time.time() - began < 5


def test_tails_with_many_edits_are_followed_to_their_end(spark):
    """After an equal start a word in seven is changed, with no seed for a thousand words: many times the words fetched at first."""
    r = random.Random(9)
    body = words(r, 1200)
    other = [f"x{i}" if i > 20 and i % 4 == 0 else w for i, w in enumerate(body)]
    texts = {1: " ".join([*words(r, 30), *body, *words(r, 30)]), 2: " ".join([*words(r, 30), *other, *words(r, 30)])}
    rows = S.repeated_passages(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert len(rows) == 1 and rows[0].n_words > 1150


def test_seeds_cover_every_equal_stretch():
    r = np.random.default_rng(1)
    for _ in range(200):
        n = S.K + S.WINDOW - 1
        shared = r.integers(0, 2**63, n).astype(np.uint64)
        a, b = (np.concatenate([r.integers(0, 2**63, r.integers(0, 30)).astype(np.uint64), shared, r.integers(0, 2**63, r.integers(0, 30)).astype(np.uint64)]) for _ in range(2))
        assert np.intersect1d(S.seeds_of(a)[0], S.seeds_of(b)[0]).size


def test_one_id_or_none_brings_no_other_rows_text(spark, monkeypatch):
    """400 rows without an id that share a passage: each text is fetched for its own wants only."""
    shared = " ".join(f"s{i}" for i in range(60))
    rows = [(None, " ".join(f"a{i}_{j}" for j in range(20)) + f" {shared} z{i}") for i in range(400)]
    fetched, real = [], S._by_text

    def counted(*args):
        out = real(*args)
        fetched.append(out.count())
        return out

    monkeypatch.setattr(S, "_by_text", counted)
    out = S.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert max(fetched) <= 2 * len(rows)
    assert len(out) == len(rows) - 1 and all(r.n_words >= 60 for r in out)
