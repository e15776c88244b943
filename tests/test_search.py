"""The query language and its answers against a plain rendering of the rules."""

import pytest

from lectern.operators import search as S

BOOKS = [
    (1, "Satow, E.", "Japan: a history", 1874, "", "", ["https://archive.org/details/a"], "Imprint: London", "UC", "book", "open", "English"),
    (2, "", "History of old Japan", 1899, "", "", ["https://gallica.bnf.fr/1"], "Note: Korea", "UC", "book", "borrow", "English"),
    (3, "Ōmori, F.", "Café life in Nippon", None, "", "", None, "japan", "BO", "book", "", "French"),
    (4, "X", "Japan article", 1880, "", "", [], "", "BO", "article", "", "English"),
    (5, "Y", "The Japan of japanese Japan", 1910, "", "", ["https://archive.org/details/b"], "", "UC", "periodical", "open", ""),
]
BOOKS = [(*b[:3], str(b[3] or "n.d."), *b[3:]) for b in BOOKS]
SCHEMA = "id long, author string, title string, year string, year_num int, edition string, volume string, links array<string>, other string, source string, type string, access string, language string"


@pytest.fixture(scope="module")
def view(spark):
    return S.with_search_columns(spark.createDataFrame(BOOKS, SCHEMA)).cache()


def ids(df):
    return [r.id for r in df.collect()]


def test_parse():
    assert S.parse('japan -Title:"Old Times" type:book Ō') == [S.Term("japan"), S.Term("old times", "title", True), S.Term("book", "type"), S.Term("o")]
    assert S.parse("") == []
    assert S.phrase_of('japan -korea title:"old times"') == "japan old times"


@pytest.mark.parametrize(
    ("request_", "want"),
    [
        (S.Request("japan"), {1, 2}),
        (S.Request("japan", show="all"), {1, 2, 3}),
        (S.Request("japan -korea"), {1}),
        (S.Request("title:japan type:all", show="all"), {1, 2, 4, 5}),
        (S.Request("type:art", show="all"), {4}),
        (S.Request("-type:book type:any", show="all"), {4, 5}),
        (S.Request("author:omori", show="all"), {3}),
        (S.Request("cafe", show="noia"), {3}),
        (S.Request(y1=1880, show="all"), {2}),
        (S.Request(show="all", undated=False), {1, 2}),
        (S.Request(host="G"), {2}),
        (S.Request(lang="French", show="all"), {3}),
        (S.Request(show="borrow"), {2}),
        (S.Request("japan", field="source", show="all"), set()),
        (S.Request("1899", show="all"), {2}),
        (S.Request("french", show="all"), {3}),
        (S.Request("other:1874"), {1}),
        (S.Request("other:english type:all", show="all"), {1, 2, 4}),
        (S.Request("other:uc", show="all"), {1, 2}),
        (S.Request('"e. japan"', show="all"), set()),
        (S.Request('"1874 uc"', show="all"), {1}),
    ],
)
def test_conditions(view, request_, want):
    assert set(ids(S.search(view, request_))) == want


def plain_relevance(r, words, phrase):
    t, a, o = r.ft, r.fa, r.fo
    whole = lambda s, i, w: (i == 0 or not s[i - 1].isalnum()) and not s[i + len(w) : i + len(w) + 1].isalnum()
    s = 400 if t == phrase else 230 if t.startswith(phrase) else 170 if " " in phrase and phrase in t else 0
    if " " in phrase:
        s += 90 if phrase in a else 30 if phrase in o else 0
    spans, other = [], 0
    for w in words:
        if (i := t.find(w)) >= 0:
            spans.append((i, i + len(w)))
            s += (20 if whole(t, i, w) else 11) + (8 if i == 0 else 0)
        elif (j := a.find(w)) >= 0:
            other += 1
            s += 14 if whole(a, j, w) else 8
        elif w in o:
            other += 1
            s += 4
    s += 70 if len(spans) == len(words) else 25 if len(spans) + other == len(words) else 0
    if len(spans) > 1:
        apart = max(e for _, e in spans) - min(b for b, _ in spans) - sum(map(len, words)) - len(words) + 1
        s += max(0, 45 - int((apart / 3 + 0.5) // 1))
    return round(s - min(25, len(t) / 30) + (2 if r.nlinks else 0), 6)


@pytest.mark.parametrize("q", ["japan", "history japan", "old japan", "japan satow", "japanese of"])
def test_relevance(view, q):
    r = S.Request(q + " type:all", show="all")
    rows = S.search(view, S.Request("type:all", show="all")).withColumn("got", S.relevance(r)).collect()
    assert {x.id: x.got for x in rows} == {x.id: plain_relevance(x, q.split(), S.phrase_of(r.q)) for x in rows}


def test_orders_pages_and_positions(view):
    r = S.Request("japan type:all", show="all", size=2)
    order = ids(S.page(view, S.Request("japan type:all", show="all", size=None)))
    assert ids(S.page(view, r)) == order[:2] and ids(S.page(view, S.Request("japan type:all", show="all", size=2, page=1))) == order[2:4]
    for i, entry in enumerate(order):
        found = S.page_of(view, r, entry).first()
        assert (found.position, found.page) == (i + 1, i // 2)
    assert ids(S.page(view, S.Request("type:all", show="all", sort="author"))) == [3, 1, 4, 5, 2]
    assert ids(S.page(view, S.Request("type:all", show="all", sort="-author")))[0] == 2  # blank authors last, so first in reverse
    assert ids(S.page(view, S.Request("type:all", show="all", sort="year_num")))[-1] == 3
    assert ids(S.page(view, S.Request("type:all", show="all", sort="-year_num")))[-1] == 3
    for sort in ("year_num", "-year_num", "author", "-title"):
        r = S.Request("type:all", show="all", sort=sort, size=2)
        order = ids(S.page(view, S.Request("type:all", show="all", sort=sort, size=None)))
        assert [S.page_of(view, r, i).first().position for i in order] == [1, 2, 3, 4, 5]


def test_pages_beyond_the_last(view, monkeypatch):
    r = S.Request("type:all", show="all", size=2, page=99)
    assert ids(S.page(view, r)) == [5] and ids(S.page(view, S.Request("nothing", size=2, page=3))) == []
    monkeypatch.setattr(S, "TOP", 1)  # by numbers instead
    order = ids(S.page(view, S.Request("japan type:all", show="all", size=None)))
    got = [ids(S.page(view, S.Request("japan type:all", show="all", size=2, page=k))) for k in range(3)]
    assert got == [order[:2], order[2:4], order[4:]] and ids(S.page(view, r)) == [5]


def test_labels_of_requests(view):
    counts = S.facet_counts(view).cache()
    label = lambda **kw: {r.language: r.label for r in S.labels_of(counts, S.Request(**kw)).collect()}["English"]
    assert label(show="all") == "English (2/3)" and label(q="type:all", show="all") == "English (3)"
    assert label(q="type:article", show="all") == "English (1/3)" and label(q="-type:book") == "English (2/3)"
    assert label(q="japan") == label(y1=1900) == label(host="IA") == "English" and label(lang="French", show="open") == "English (1/3)"


def test_facets(view):
    counts = {(r.language, r.show, r.type): r.n for r in S.facet_counts(view).collect()}
    assert counts["English", "all", ""] == 3 and counts["English", "ia", "book"] == 2 and counts["English", "open", ""] == 1
    assert counts["French", "noia", "book"] == 1 and not any(k[0] == "" for k in counts)
    labels = {r.language: r.label for r in S.facet_labels(S.facet_counts(view), "open", "book").collect()}
    assert labels == {"English": "English (1/3)", "French": "French (0/1)"}


def test_highlight(spark):
    df = spark.createDataFrame([("Café <life>",)], "t string")
    assert df.select(S.highlighted(df.t, S.parse("cafe x"))).first()[0] == "<mark>Café</mark> &lt;life&gt;"


def test_filter_reaches_the_scan(spark, tmp_path):
    S.with_search_columns(spark.createDataFrame(BOOKS, SCHEMA)).write.parquet(f"{tmp_path}/v")
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    plan = S.search(spark.read.parquet(f"{tmp_path}/v"), S.Request(lang="French", y1=1850))._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(language,French)" in plan and "GreaterThanOrEqual(year_num,1850)" in plan
