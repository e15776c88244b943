"""The query against a driver-side brute force, and the parse's local consistency."""

import hashlib
import itertools
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lectern.llm import fingerprints as P


def words(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 9))) for _ in range(n))


def parsed(text):
    """The sketch by a plain parse, symbol by symbol, with Python's integers: what the module's text says."""
    wide, mask = 2**64, 2**64 - 1
    low = lambda a, b: ((a ^ b) & -(a ^ b)).bit_length() - 1

    def mix(x):
        x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & mask
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & mask
        return x ^ (x >> 31)

    power, powers = 1, []
    for _ in range(256):
        power = power * 0xD1342543DE82EF95 % wide
        powers.append(power)
    symbols, names, level = [ord(c) for c in text], set(), 0
    while symbols:
        level += 1
        runs = [(x, len(list(group))) for x, group in itertools.groupby(symbols)]
        symbols = [x if n == 1 else mix((x + n * 0x9E3779B97F4A7C15) % wide) for x, n in runs]
        labels = symbols
        for _ in range(3):
            labels = [symbols[0] & 1, *(2 * low(a, b) + (b >> low(a, b) & 1) if a != b else b & 1 for a, b in itertools.pairwise(labels))]
        cuts = [0] + [i for i in range(2, len(labels)) if labels[i] > labels[i - 1] and (i + 1 == len(labels) or labels[i] > labels[i + 1])]
        phrases = [symbols[a:b] for a, b in itertools.pairwise([*cuts, len(symbols)])]
        symbols = [mix((sum(x * powers[j & 255] for j, x in enumerate(p)) + len(p) * 0x9E3779B97F4A7C15) % wide) for p in phrases]
        if level >= P.FIRST_LEVEL or len(symbols) == 1:
            names |= {mix((x + level) % wide) >> 32 for x in symbols}
        if len(symbols) == 1:
            break
    return sorted(names)[: P.SKETCH]


def alike(a, b):
    least = sorted({*a, *b})[: P.SKETCH]
    return sum(x in a and x in b for x in least) / len(least) if least else 1.0


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab c😀é", max_size=120))
def test_parse_equals_a_plain_one(text):
    assert P.fingerprints([text])[0].tolist() == parsed(text)


def test_likeness_is_smooth_in_length():
    """Four characters more at the end cost a text of any length about as much as one a little longer or shorter."""
    mean = []
    for n in range(40, 200, 4):
        near = [P.likeness(*P.fingerprints([t[:n], t[:n] + "abcd"])) for t in (words(s, 60) for s in range(30))]
        mean.append(sum(near) / len(near))
    assert all(abs(a - b) < 0.1 for a, b in itertools.pairwise(mean)) and mean[0] < mean[-1] and min(mean) > 0.25


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    out = {}
    for i, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        changed = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
        a, b, c = map(parsed, (text, changed, following))
        of = lambda sketch: "".join(f"{x:08x}" for x in sketch)
        out[doc_id] = (len(text), hashlib.sha256(changed.encode()).hexdigest(), of(a), of(b), alike(a, b), alike(a, c))
    return out


@pytest.mark.parametrize("n", [0, 1, 2, 9, 60])
def test_query_equals_brute_force(spark, n):
    rows = [(i * 7 - 20, words(i % 40, i % 23) + "é😀" * (i % 3)) for i in range(n)]
    if n > 8:
        rows += [(None, "no id at all"), (10_000, None), (10_001, ""), (10_002, words(1, 3000)), (10_003, "a" * 5000)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, fingerprint string")
    got = {r.doc_id: tuple(r)[1:] for r in P.fingerprint_with_edits(docs).collect()}
    assert got == brute(rows)


@pytest.mark.parametrize("n", [2, 3, 8, 24])
def test_ids_are_dealt_in_order_at_any_number_of_partitions(spark, n):
    rows = [(i, f"text {i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    spark.conf.set("spark.sql.shuffle.partitions", n)
    try:
        dealt = [[r._id for r in part if not r._extra] for part in P.in_descending_order(docs, "doc_id", "text").rdd.glom().collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    parts = sorted((p for p in dealt if p), reverse=True)
    assert [i for p in parts for i in p] == list(range(299, -1, -1)) and len(parts) >= n // 2


def test_repeated_ids_give_a_row_each(spark):
    docs = spark.createDataFrame([(1, "one"), (1, "two"), (1, "one"), (2, "three")], "doc_id long, text string")
    assert sorted(r.n_chars for r in P.fingerprint_with_edits(docs).collect()) == [3, 3, 3, 5]


def test_rows_of_one_id_are_dealt_over_partitions(spark):
    rows = [(None, words(i, 4)) for i in range(400)] + [(i, words(i, 3)) for i in range(200)] + [(77, f"again {i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    spark.conf.set("spark.sql.shuffle.partitions", 20)
    try:
        dealt = [[r for r in part if not r._extra] for part in P.in_descending_order(docs, "doc_id", "text").rdd.glom().collect()]
        found = P.fingerprint_with_edits(docs).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert sum(map(len, dealt)) == len(rows) and max(map(len, dealt)) < 0.15 * len(rows)
    hashes = {r.text: r.h for r in docs.withColumn("h", F.xxhash64("text")).collect()}
    order = sorted(rows, key=lambda r: (-r[0] if r[0] is not None else 10**9, hashes[r[1]], r[1]))
    follows = {r: order[(i + 1) % len(order)][1] for i, r in enumerate(order)}
    got = {}
    for r in found:
        got.setdefault(r.doc_id, set()).add(r.edited_sha256)
    want = {}
    for doc_id, text in rows:
        want.setdefault(doc_id, set()).add(hashlib.sha256(P.edited(text, follows[doc_id, text]).encode()).hexdigest())
    assert got == want


def test_shared_substring_shares_interior_phrases_at_every_offset():
    shared = words(5, 400)
    base = [set(x.tolist()) for x, _ in P.phrase_levels([shared])]
    for shift in range(1, 30):
        moved = [set(x.tolist()) for x, _ in P.phrase_levels([words(shift, 3)[:shift] + shared + words(99, 5)])]
        for level in range(4):
            assert len(base[level] & moved[level]) >= 0.8 * len(base[level]) - 3


def test_batches_do_not_matter():
    texts = [words(i, i) for i in range(50)] + ["", "x", "aaaa"]
    together = P.fingerprints(texts)
    assert all(np.array_equal(a, P.fingerprints([t])[0]) for a, t in zip(together, texts, strict=True))


def test_likeness_tells_edits_from_strangers():
    a, b = words(1, 500), words(2, 500)
    x, y, z = P.fingerprints([a, P.edited(a, b), b])
    assert P.likeness(x, x) == 1 and 0.15 < P.likeness(x, y) < 0.55 and P.likeness(x, z) < 0.05
    assert P.likeness(x[:0], x[:0]) == 1 and P.likeness(x[:0], x) == 0
