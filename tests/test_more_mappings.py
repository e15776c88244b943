"""Mappings of collections, cards, printed books and archive items: nulls, empty tables, repeats."""

from pyspark.sql import functions as F

from lectern.operators import mapping as M

ITEM = "n int, title string, date string, urls array<string>, authors array<string>, editors array<string>, translators array<string>, contributors array<string>, subjects array<string>, place string, publisher string, pages string, series string, language string, abstract string"


def test_collected(spark):
    rows = [
        (1, " A title ", "1890-05", ["http://www.archive.org/details/a"], ["Ann Roe", "not available", None], None, None, None, None, None, None, "12", None, None, "77 88"),
        (2, "Twice", "1891", ["https://archive.org/details/a"], None, None, None, None, None, None, None, None, None, None, None),
        (3, None, None, ["https://x.org/1"], [], ["Ed Poe", "Japan Society"], ["Tr One"], ["Cy Two"], [f"s{i}" for i in range(20)], "Paris", "Doe", "xii, 3", "S", "fr", "Digitized by Google"),
        (4, "No link", "x", ["ark:/1", "http://localhost/1"], None, None, None, None, None, None, None, None, None, None, None),
        (5, "Null links", "x", None, None, None, None, None, None, None, None, None, None, None, None),
        (6, "Out", "x", ["https://gone.org"], None, None, None, None, None, None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, ITEM)
    got = [tuple(r) for r in M.collected(df, "n", ["https://gone.org"]).orderBy("n").collect()]
    assert got == [
        (1, "Roe, Ann", "A title", "1890", 1890, ["https://archive.org/details/a"], "Extent: 12 p."),
        (3, "Poe, Ed, ed.; Japan Society, ed.", "", "n.d.", None, ["https://x.org/1"], "Imprint: Paris, Doe | Extent: xii, 3 | Series: S | Language: fr | Translator: One, Tr | Contributor: Two, Cy | Subjects: " + "; ".join(f"s{i}" for i in range(12))),
    ]
    assert M.collected(df.limit(0), "n").collect() == []


def test_cards_books_items(spark):
    cards = spark.createDataFrame([("T / x", "Gil (1801-1870)|y", "1850?", None, None, None, None, "u", "v", None), (None, "a", "1", "p", "q", "e", "s", "u", "v", None), ("T", None, None, "p", "q", "e", "s", "u", "v", "bad")], "title string, author string, date string, place string, publisher string, extent string, signature string, id string, viewer string, error string")
    assert [tuple(r)[:6] for r in M.library_cards(cards).collect()] == [("Gil", "T", "1850", 1850, ["v"], "Language: Spanish | Biblioteca Nacional de España, BNE Digital u")]
    books = spark.createDataFrame([(2, "Doe, J.", "Art, ca.", "1890", None, "3 p.", None), (1, "Doe, Jane", "ART", None, 1890, None, None), (3, None, "Art", "1849", None, None, None), (4, None, "Art", None, None, None, None)], "n int, author string, title string, year string, list_year int, collation string, error string")
    assert [tuple(r) for r in M.one_per_work(books, "n").collect()] == [(1, "Doe, Jane", "ART", "1890", 1890, "")]
    items = spark.createDataFrame([("a", None, None, None, None, None), ("b", "X Y Z", "t  t", "1777", "p", 0)], "identifier string, creator string, title string, date string, publisher string, imagecount int")
    assert [tuple(r)[1:7] for r in M.archive_items(items).orderBy("identifier").collect()] == [("", "", "n.d.", None, "", ""), ("Z, X Y", "t t", "1777", 1777, "p", "")]


def test_pairs_ruled_out(spark):
    df = spark.createDataFrame([("Duus, P.", "The Abacus and the Sword"), ("Duus, P.", "Other"), (None, "Abacus"), ("DÜUS", "äbacus")], "a string, t string")
    assert [r.x for r in df.select(M.ruled_out(F.col("a"), F.col("t"), [("duus", "abacus")]).alias("x")).collect()] == [True, False, False, True]
    assert not any(r.x for r in df.select(M.ruled_out(F.col("a"), F.col("t"), []).alias("x")).collect())
