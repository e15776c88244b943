"""The cascade against a plain sequential one, joins and verdicts on small tables."""

import random

import pytest
from pyspark.sql import functions as F

from lectern.functions import udfs as U
from lectern.functions.agreement import same_title
from lectern.operators import attach as A
from lectern.operators import dedupe as D
from lectern.operators import graph
from lectern.operators import linkage as L


def plain_main(t):
    import re

    m = re.match(r"(.{12,}?)[;:]\s", t) or re.match(r"(.{20,}?)\.\s", t)
    return (m[1] if m else t).strip(" .,;:")


def plain_surname(a):
    words = U.key(a.split(",")[0]).split() if "," in a else []
    return words[-1] if 0 < len(words) <= 3 else ""


def all_pairs(spark, rows):
    """Whether two titles are the same, by title and strictness."""
    keys = sorted({(U.key(plain_main(r[2])), U.key(r[2])) for r in rows})
    one = spark.createDataFrame(keys, "a string, fa string")
    pairs = one.crossJoin(one.toDF("b", "fb")).crossJoin(spark.createDataFrame([(True,), (False,)], "strict boolean"))
    found = pairs.withColumn("same", same_title(*map(F.col, ("a", "b", "fa", "fb", "strict"))))
    return {(r.a, r.b, r.fa, r.fb, r.strict): r.same for r in found.collect()}


def plain_merge(existing, new, c, same_titles):
    """Records one by one, against everything that is live."""
    make = lambda r: dict(ord=r[0], sur=plain_surname(r[1]), tk=U.key(plain_main(r[2])), full=U.key(r[2]), year=r[3], kind=r[4])
    live, out = [make(r) for r in existing], {}
    everyone = [make(r) for r in [*existing, *new]]
    first = {}
    for it in everyone:
        first.setdefault(it["sur"], it["ord"])
    n_old = len(live)

    def find(r, sur, strict):
        best = None
        for it in live if c.self_dedupe else live[:n_old]:
            if it["sur"] != sur or it["kind"] != r["kind"]:
                continue
            known = r["year"] is not None and it["year"] is not None
            if known and abs(r["year"] - it["year"]) > 3 or not known and r["tk"] != it["tk"]:
                continue
            a, b = set(r["tk"].split()), set(it["tk"].split())
            if len(a & b) * 2 < min(len(a), len(b)) or not same_titles[r["tk"], it["tk"], r["full"], it["full"], strict or r["kind"] == "part"]:
                continue
            d = abs(r["year"] - it["year"]) if known else 99
            if best is None or (d, it["ord"]) < best[0]:
                best = ((d, it["ord"]), it)
        return best and best[1]

    for row in new:
        r = make(row)
        hit, stage = find(r, r["sur"], False), 1
        if not hit and r["sur"] and c.variants:
            for sur in sorted({s for s in first if s and s != r["sur"] and s[0] == r["sur"][0] and U.ratio(r["sur"], s) >= 0.8}, key=first.get):
                if hit := find(r, sur, False):
                    stage = 2
                    break
        if not hit and r["sur"] and c.anonymous and len(r["tk"]) >= 25:
            hit, stage = find(r, "", len(r["tk"]) < 40), 3
        if not hit and c.exact is not None and len(r["tk"]) >= c.exact and r["year"] is not None:
            same = [it for it in live if it["tk"] == r["tk"] and it["kind"] == r["kind"] and it["year"] is not None and abs(it["year"] - r["year"]) <= 3]
            hit, stage = (min(same, key=lambda it: (abs(it["year"] - r["year"]), it["ord"])) if same else None), 4
        if hit:
            out[r["ord"]] = (hit["ord"], stage)
        else:
            out[r["ord"]] = (None, None)
            live.append(r)
    return out


def corpus(seed):
    r = random.Random(seed)
    words = ["history", "japan", "letters", "travels", "art", "empire", "people", "religion", "story", "notes", "temple", "garden"]
    names = ["Satow, E.", "Satou, E.", "Uyehara, G.", "Uehara, G.", "", "Aston, W.", "Japan Society"]
    base = [(" ".join(r.sample(words, r.randint(3, 7))), r.choice(names), r.choice([1870, 1880, 1890, None])) for _ in range(12)]
    rows = []
    for i in range(60):
        title, author, year = r.choice(base)
        if r.random() < 0.3:
            title += r.choice(["s", ": second edition", " volume 2", " volume 3"])
        if r.random() < 0.3:
            author = r.choice(names)
        rows.append((i, author, title, None if year is None or r.random() < 0.1 else year + r.randint(-3, 4), r.choice(["book", "book", "book", "part"])))
    return rows[:25], rows[25:]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_merge_equals_sequential(spark, seed):
    existing, new = corpus(seed)
    schema = "ord long, author string, title string, year int, kind string"
    got = L.merge(spark.createDataFrame(existing, schema), spark.createDataFrame(new, schema).repartition(seed + 1), L.CASCADES["borton"])
    assert {r.ord: (r.match, r.stage) for r in got.collect()} == plain_merge(existing, new, L.CASCADES["borton"], all_pairs(spark, existing + new))


def test_years_and_kinds(spark):
    df = spark.createDataFrame([(1, 4), (1, 5), (1, None)], "a int, b int")
    assert [r[0] for r in df.select(L.years_close(df.a, df.b)).collect()] == [True, False, None]


def test_attach_lost_and_identifiers(spark):
    rows = spark.createDataFrame([(1, "k", ["u"]), (2, "k", None), (3, "m", [])], "id long, rowkey string, links array<string>")
    links = spark.createDataFrame([("k", "u"), ("k", "v"), ("z", "w")], "rowkey string, url string")
    got = {r.id: r.links for r in A.attach_by_key(rows, links).collect()}
    assert got == {1: ["u", "v"], 2: ["u", "v"], 3: []}
    assert [r.url for r in A.lost(rows, links).collect()] == ["w"]
    books = spark.createDataFrame([(1, ["https://archive.org/details/ab"]), (2, ["https://archive.org/details/abc", "https://archive.org/details/ab"])], "id long, links array<string>")
    ids = spark.createDataFrame([("ab",), ("abc",)], "identifier string")
    assert {r.identifier: r.row for r in A.attach_by_identifier(books, ids).collect()} == {"ab": 1, "abc": 2}
    only = books.filter("id = 2")
    assert {r.identifier for r in A.containing(only, spark.createDataFrame([("a",)], "identifier string")).collect()} == {"a"}
    wrong = spark.createDataFrame([(2, "https://archive.org/details/ab")], "id long, url string")
    assert {r.id: len(r.links) for r in A.remove_links(books, wrong).collect()} == {1: 1, 2: 1}


def test_identified_links_are_verified(spark):
    url = "https://archive.org/details/"
    books = spark.createDataFrame([(1, "Griffis, W. E.", "The Mikado's Empire", "book", [url + "a"]), (2, "Doe, J.", "Gardens of Kyoto", "book", [url + "b", url + "c"])], "id long, author string, title string, type string, links array<string>")
    records = spark.createDataFrame([("a", "Mikado's empire: history of Japan", "Griffis, William"), ("b", "Railways of Tokyo", "Roe, R."), ("z", "None", "")], "identifier string, r_title string, r_author string")
    got = {r.identifier: (r.row, r.agrees) for r in A.verified_by_identifier(books, records).collect()}
    assert got == {"a": (1, True), "b": (2, False)}
    left = A.without_false_links(books, records)
    assert {r.id: r.links for r in left.collect()} == {1: [url + "a"], 2: [url + "c"]} and left.columns == books.columns


def test_links_order_and_fallback(spark):
    df = spark.createDataFrame([(["https://archive.org/details/r", "https://archive.org/details/o", "https://x.org", "https://archive.org/details/h"], {"r": "restricted", "o": "open"}, {"https://archive.org/details/h": "borrow"})], "links array<string>, acc map<string,string>, chk map<string,string>")
    got = df.select(A.ordered_links(df.links, df.acc, df.chk).alias("o")).first().o
    assert [(x.url.rsplit("/", 1)[-1], x.access, x.checked) for x in got] == [("h", "borrow", True), ("o", "open", False), ("x.org", "open", False), ("r", "restricted", False)]
    pick = spark.createDataFrame([(None, [], ["l"]), ([], [], ["l"]), ([], ["o"], ["l"]), (["s"], [], ["l"])], "s array<string>, o array<string>, l array<string>")
    assert [r[0] for r in pick.select(A.fallback(pick.s, pick.o, pick.l)).collect()] == [None, ["l"], [], ["s"]]


def test_numbering_tools(spark):
    rows = spark.createDataFrame([(i % 3, i) for i in range(40)], "g int, n int")
    got = D.numbered(rows, "g", "n").orderBy("g", "n").collect()
    assert [r.id for r in got] == list(range(1, 41))
    log = spark.createDataFrame([("a", 1, "x"), ("a", 3, None), ("b", 2, "y")], "k string, at int, v string")
    assert {(r.k, r.at, r.v) for r in D.collapse_log(log, "k", "at").collect()} == {("a", 3, None), ("b", 2, "y")}
    assert {(r.k, r.at) for r in D.last_wins(log, ["k"], "at").collect()} == {("a", 3), ("b", 2)}
    keys = spark.createDataFrame([("k", 2), ("k", 1), ("j", 3)], "key string, id int")
    assert {r.id: r.key for r in D.suffixed(keys, "key", "id").collect()} == {1: "k", 2: "k2", 3: "j"}
    r = random.Random(2)
    many = [(i, r.choice(["k", "k2", "k22", "k3", "j", "j1", "m9", "m"]), "x") for i in range(120)]
    used, want = set(), {}
    for i, base, _ in many:
        key, n = base, 2
        while key in used:
            key, n = f"{base}{n}", n + 1
        used.add(key)
        want[i] = key
    table = spark.createDataFrame(many, "id long, key string, _n string").repartition(5)
    assert {r.id: r.made for r in D.suffixed(table, "key", "id", "made").collect()} == want
    assert D.suffixed(table, "key", "id", "made").columns == ["id", "key", "_n", "made"]
    edges = spark.createDataFrame([(3, 2), (2, 1), (5, 4), (7, 7)], "a long, b long")
    assert {r.node: r.component for r in graph.components(edges).collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4}


def test_verdicts(spark):
    hits = spark.createDataFrame([(1, "a", 0, 4), (1, "b", 1, 4), (2, "c", 0, 2), (3, "d", 0, 5), (4, "e", 0, 1), (4, "f", 1, 9)], "r int, c string, pos int, points int")
    dec = spark.createDataFrame([(3, "d", "no"), (4, "e", "edition")], "r int, c string, verdict string")
    got = {r.r: (r.c, r.verdict, r.by) for r in A.with_verdicts(hits, dec, "r", "c").collect()}
    assert got == {1: ("a", "yes", "score"), 4: ("e", "edition", "hand")}
