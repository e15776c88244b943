"""The text index against the search without one, containment against all pairs, neighbours against a sorted list."""

import random
import time

import pytest
from pyspark.sql import functions as F

from lectern.operators import attach as A
from lectern.operators import dedupe as D
from lectern.operators import search as S
from lectern.operators import text_index as T

BOOK = "id long, author string, title string, year string, year_num int, edition string, volume string, links array<string>, other string, source string, type string, access string, language string"


@pytest.fixture(scope="module")
def view(spark):
    r = random.Random(2)
    words = ["Études", "Kyōto", "art", "of", "a", "Ω", "İstanbul", "garden", "gardening", "\\d+", "100%", "x_y", "日本", "😀smile"]
    line = lambda n: " ".join(r.choice(words) for _ in range(n))
    rows = [(i, r.choice(["", "Satow, E.", None]), line(r.randint(0, 5)), "1890", 1890, "", None, r.choice([None, [], ["https://archive.org/details/x"]]), line(3), r.choice(["s1", "s2"]), r.choice(["book", "article"]), "", "English") for i in range(300)]
    out = S.with_search_columns(spark.createDataFrame(rows, BOOK)).cache()
    yield out
    out.unpersist()


@pytest.fixture(scope="module")
def index(view):
    return T.TextIndex.build(view)


@pytest.mark.parametrize("q", ["garden", "gardening art", '"art of"', "a", "ky", "ō", "title:of -garden", "author:satow type:all", "Ω", "日本", "日", "😀", "\\d+", "100%", "x_y", "_", "%", "nowhere", "-art", "", "type:article", '"gardening gardening gardening"', "source:s1 e"])
def test_index_answers_as_the_search(view, index, q):
    r = S.Request(q, show="all")
    found = lambda df: sorted(map(tuple, df.select("id", "rel").collect()))
    assert found(index.search(r)) == found(S.search(view, r))


def test_a_term_reads_its_letters_files_only(index):
    files = lambda df: df.select(F.input_file_name().alias("f")).distinct().count()
    whole, term = files(index.table), index.scan("ft", "garden")
    plan = term._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(head" in plan or "PartitionFilters: [head" in plan
    assert 0 < files(term) < whole / 3 and 0 < files(index.scan("ft", "ga")) < whole / 3


def test_grams_of_long_terms():
    assert T.wanted_grams("abcd") == ["abc", "bcd"] and T.wanted_grams("aaaaa") == ["aaa"]
    assert len(T.wanted_grams("".join(chr(97 + i % 26) + chr(65 + i // 26) for i in range(60)))) <= T.MOST_GRAMS


def test_containing_equals_all_pairs(spark):
    r = random.Random(4)
    link = lambda: "https://" + "".join(r.choice("ab/1") for _ in range(r.randint(0, 14)))
    rows = [(i, [link() for _ in range(r.randint(0, 3))] if r.random() < 0.9 else None) for i in range(120)]
    parts = sorted({"".join(r.choice("ab/1") for _ in range(r.randint(1, 9))) for _ in range(80)}) + ["", None, "https://", "\nhttps", "zzzzzzzzz"]
    records = [(n, p) for n, p in enumerate(parts)] + [(0, parts[0])]
    df = spark.createDataFrame(rows, "id long, links array<string>")
    got = A.containing(df, spark.createDataFrame(records, "n long, identifier string"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    want = {(n, p): min((i for i, ls in rows if p in "\n".join(ls or [])), default=None) for n, p in set(records) if p is not None}
    found = got.collect()
    assert {(x.n, x.identifier): x.row for x in found} == {k: v for k, v in want.items() if v is not None} and len(found) == len({(x.n, x.identifier) for x in found})
    assert A.containing(df.limit(0), spark.createDataFrame(records, "n long, identifier string")).collect() == []
    assert A.containing(df, spark.createDataFrame([], "n long, identifier string")).collect() == []


@pytest.mark.parametrize("n", [0, 1, 2, 500])
def test_previous_over_ranges(spark, n):
    r = random.Random(n)
    rows = [(i, r.choice([None, "a", "a", "b"]), r.randint(0, 3)) for i in range(n)]
    df = spark.createDataFrame(r.sample(rows, n), "i long, v string, k int").repartition(3)
    ordered = sorted(rows, key=lambda x: (x[2], x[0]))
    want = {a[0]: (b[1] if b else None) for a, b in zip(ordered, [None, *ordered], strict=False)}
    assert {x.i: x.previous for x in D.with_previous(df, "v", "k", "i").collect()} == want
    new = {a[0]: b is None or a[1] != b[1] for a, b in zip(ordered, [None, *ordered], strict=False)}
    got = D.breaks(df, "v", "k", "i")
    assert got.columns == ["i", "v", "k", "is_new"] and {x.i: x.is_new for x in got.collect()} == new


def test_gaps_over_all(spark):
    df = spark.createDataFrame([(x,) for x in [1, 2, 2, 3, 7, 8, None, 20]], "n long")
    assert sorted(map(tuple, D.gaps_over_all(df, "n").collect())) == [(3, 7), (8, 20)]
    assert D.gaps_over_all(df.limit(0), "n").collect() == []


def test_postings_of_a_long_text(spark):
    """A text of 200,000 letters is cut in one go; each place cost all letters before it."""
    text = "".join(chr(97 + i * i % 23) for i in range(200_000)) + "😀日"
    row = spark.createDataFrame([(1, text)], "id long, ft string")
    began = time.time()
    got = {r.gram for r in T.postings(row, ("ft",)).collect()}
    assert time.time() - began < 15
    filled = text + T.END * 2
    assert got == {filled[i : i + 3] for i in range(len(text))}


def test_a_whole_field_has_postings_of_its_borders_only(view):
    rows = T.postings(view).collect()
    texts = {r.id: r for r in view.collect()}
    of = lambda i, f: (texts[i][f] or "") + T.END * 2
    grams = lambda i, f: {of(i, f)[j : j + 3] for j in range(len(of(i, f)) - 2)} - {T.END * 2}
    whole = {(r.id, r.gram) for r in rows if r.field == "fall"}
    assert whole == {(i, g) for i in texts for g in grams(i, "fall") - grams(i, "fa") - grams(i, "ft") - grams(i, "fo")}
    assert len(whole) < len(rows) / 5 and len(rows) == len(set(rows))
