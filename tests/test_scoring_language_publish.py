"""Scores, tiers, languages, labelled parts, published rows and sinks, by hand-worked cases."""

import pytest
from pyspark.sql import functions as F

from lectern.operators import language, publish, scoring
from lectern.plans import catalogue
from lectern.sources import sinks


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def years(*ys):
    return F.array(*map(F.lit, ys)).cast("array<int>")


def lit(x):
    return F.lit(x).cast("string") if x is None else F.lit(x)


@pytest.mark.parametrize(
    ("rules", "args", "points"),
    [
        ("gallica", ("Le Japon illustré", "Humbert, Aimé", (1870,), "Le Japon illustré / A. Humbert", "Humbert", 1871, "text"), 4),
        ("gallica", ("Le Japon illustré", "Humbert, Aimé", (1870,), "Japon illustré", None, 1880, "image"), 0),
        ("gallica", ("Voyage au Japon central", "X, Y", (), "Voyage au Japon", "Z", 1880, None), 0),
        ("gallica", ("le la", "X, Y", (), "x", "y", None, None), 0),
        ("europeana", ("Japan", "Rein, J.", (1881,), "Japan nach Reisen und Studien im Auftrage", "Anders", 1881, None), 2),
        ("onlinebooks", ("Old Japan tales", "Mitford", (1871,), "Tales of old Japan", "Mitford, A. B.", 1871, None), 4),
    ],
)
def test_points(spark, rules, args, points):
    title, author, ys, hit, creator, year, kind = args
    got = scoring.points(scoring.RULES[rules], lit(title), lit(author), years(*ys), lit(hit), lit(creator), F.lit(year).cast("int"), lit(kind), copies=F.lit(1) if rules == "onlinebooks" else None, has_object=F.lit(True) if rules == "europeana" else None)
    assert value(spark, got)["points"] == points


def test_points_without_copies(spark):
    got = scoring.points(scoring.RULES["onlinebooks"], F.lit("Old Japan"), F.lit(""), years(), F.lit("Old Japan"), F.lit(""), F.lit(None).cast("int"), copies=F.lit(0))
    assert tuple(value(spark, got)) == (-9, ["no freely readable copy"])


@pytest.mark.parametrize(
    ("words", "author", "title", "hit", "cov_r", "cov_c", "auth", "want"),
    [
        (2, "Doe, J.", "Tales", "Tales", 0.8, 0.8, True, "ACCEPT"),
        (5, "Doe, J.", "Tales", "Tales", 0.9, 0.9, None, "ACCEPT"),
        (5, "Doe, J.", "Tales", "Tales", 0.9, 0.9, False, "REVIEW"),
        (4, "", "Tales", "Tales", 1.0, 1.0, None, "ACCEPT"),
        (3, "Japan. Laws, statutes", "Laws", "Laws", 0.9, 0.9, True, "REVIEW"),
        (9, "", "Report 1899", "Report 1900", 1.0, 1.0, True, "reject"),
        (9, "", "Report", "Report", 1.0, 0.4, False, "reject"),
        (4, "", "Report", "Report", 0.6, 0.6, None, "REVIEW"),
        (3, "", "Report", "Report", 0.6, 0.6, None, "reject"),
    ],
)
def test_tier(spark, words, author, title, hit, cov_r, cov_c, auth, want):
    got = scoring.tier(F.lit(words), F.lit(author), F.lit(title), F.lit(hit), F.lit(cov_r), F.lit(cov_c), F.lit(auth).cast("boolean"))
    assert value(spark, got) == want


@pytest.mark.parametrize(
    ("title", "other", "want"),
    [
        ("Die Geschichte der Welt", "", "German"),
        ("Études sur le Japon", "", "French"),
        ("A history of Japan", "", "English"),
        ("日本の歴史", "", ""),
        ("Япония", "", "Russian"),
        ("123", "", "English"),
        ("Anything", "Language: fre | x", "French"),
        ("Anything", "Language: jpn", "English"),
        ("Anything", "Language: finnish", "Finnish"),
        ("Über die Kunst im Osten", "", "German"),
        ("Japón", "", "English"),
    ],
)
def test_language(spark, title, other, want):
    assert value(spark, language.guess(F.lit(title), F.lit(other)))["language"] == want


def test_markers_shared_by_languages_count_for_none():
    assert language.unambiguous([("A", "x"), ("B", "x"), ("B", "y"), ("B", "y")]) == {"B": ["y"]}


def test_hand_fixes(spark):
    fixes = F.create_map(F.lit("k"), F.lit("Dutch"), F.lit("blank"), F.lit(""))
    assert value(spark, language.language_of(F.lit("k"), fixes, F.lit("A title"), F.lit(""))) == "Dutch"
    assert value(spark, language.language_of(F.lit("blank"), fixes, F.lit("A title"), F.lit(""))) == "English"


def test_parts(spark):
    r = {"place": F.lit("London"), "publisher": F.lit("Murray"), "extent": F.lit("2 v."), "series": F.lit(""), "holdings": F.array(F.lit("NDL"), F.lit("TY")), "rare": F.lit(True), "printed_page": F.lit(None), "pdf_page": F.lit(12), "col": F.lit("L"), "note": F.lit("n")}
    assert value(spark, publish.catalogue_parts(r)) == "Imprint: London, Murray | Extent: 2 v. | Holdings: NDL TY | Rare (starred in catalogue) | Catalogue p. ? (PDF p. 12, col. L) | Note: n"
    b = {"type": F.lit("article"), "container": F.lit("Journal"), "place": F.lit(""), "publisher": F.lit("P"), "extent": F.lit(""), "section": F.lit("I"), "annotation": F.lit("good"), "note": F.lit(None)}
    assert value(spark, publish.bibliography_parts(b, F.lit("Borton 12"), F.array(F.lit("Also in X (3)")))) == "Type: article | In: Journal | Imprint: P | Section: I | Borton 12 | Annotation: good | Also in X (3)"
    other = F.lit("Imprint: A | plain | A very long label indeed it is: v")
    assert [tuple(p) for p in value(spark, publish.parsed(other))] == [("Imprint", "A"), ("Info", "plain"), ("Info", "A very long label indeed it is: v")]
    assert value(spark, publish.strip_annotations(F.lit("Imprint: A | Annotation: good book | Also in Dower (p. 3): his words | Note: n"))) == "Imprint: A| Also in Dower (p. 3)| Note: n"
    assert value(spark, publish.year_number(F.lit(None), years(1700, 1900, 1890))) == 1890
    assert value(spark, publish.year_number(F.lit(None), years(1700, 1750))) == 1700
    assert value(spark, publish.add_source(F.lit("A; B"), "B")) == "A; B" and value(spark, publish.add_source(F.lit(""), "C")) == "C"
    assert value(spark, publish.fullness(F.lit("a"), F.lit(""), F.lit(None), F.lit(3))) == 2


def test_places(spark):
    assert value(spark, publish.numbered_place("B", F.lit(159), F.lit(20), F.lit('printed as "159a"'))) == "B no. 159a, p. 20"
    assert value(spark, publish.paged_place("W", F.lit(3), F.lit("Swedish list"))) == "W, Swedish list p. 3"
    assert value(spark, publish.paged_place("D", F.lit(None))) == "D p. ?"
    assert value(spark, publish.identified_place("N", F.lit("000123"), F.lit("DS/1"))) == "N 000123 (DS/1)"
    assert value(spark, publish.cross_reference(F.lit("D p. 3"), F.lit("1900"), F.lit("good"))) == "Also in D p. 3 (as 1900): good"
    assert tuple(value(spark, publish.printed_page(F.lit(510)))) == (2, "Pagès supplement")
    assert value(spark, publish.edition_and_volume(F.lit("2"), F.lit("Bd. 1"))) == "ed. 2, Bd. 1"


def test_overrides_and_publication(spark):
    rows = spark.createDataFrame([("k", "old", "x"), ("m", "stays", "y")], "rowkey string, title string, author string")
    fixes = spark.createDataFrame([("k", "new", None, True)], "rowkey string, title string, author string, has_author boolean")
    assert {tuple(r) for r in publish.overridden(rows, fixes, "rowkey", ["title", "author"]).collect()} == {("k", "new", None), ("m", "stays", "y")}
    books = spark.createDataFrame([(1, "Latin", 1900, "a"), (2, "English", None, "b"), (3, "English", 1960, "c"), (4, "English", 1900, "d")], "id int, language string, year_num int, rowkey string")
    assert {r.id for r in publish.published(books, spark.createDataFrame([("d",)], "rowkey string")).collect()} == {2}


def test_sinks(spark, tmp_path):
    row = (7, "Satow, E.", 'A "title"', "1874", 1874, "2nd", "1 v.", ["https://archive.org/details/a"], "Imprint: London, Murray & Co | In: J", "UC", "chapter", "open", ["open"], [True], "English")
    books = spark.createDataFrame([row, (8, "", "Other", "", None, "", "", None, "", "BO", "book", "", None, None, "")], publish.BOOKS)
    sinks.write_books(books, f"{tmp_path}/books")
    back = spark.read.parquet(f"{tmp_path}/books")
    assert back.schema.fieldNames() == publish.BOOKS.fieldNames() and back.count() == 2
    sinks.write_csv(books, f"{tmp_path}/csv")
    lines = sorted(r.value for r in spark.read.text(f"{tmp_path}/csv").collect())
    assert lines[0].startswith('"7","Satow, E.","A ""title""","1874"') and lines[-1].lstrip("\ufeff") == sinks.csv_header()[1:]
    one = books.filter("id = 7")
    assert one.select(sinks.bibtex_key(F.col("author"), F.col("title"), F.col("year_num"))).first()[0] == "satow1874"
    assert "booktitle = {J}" in one.select(sinks.bibtex_entry(F.lit("k"))).first()[0]
    assert "rft.genre=bookitem" in one.select(sinks.coins()).first()[0] and "rft.btitle=" not in one.select(sinks.coins()).first()[0].replace("rft.atitle", "")
    assert one.select(sinks.citation()).first()[0] == 'Satow, E. A "title". 2nd London, Murray & Co 1874.'
    assert one.select(sinks.markdown_entry()).first()[0] == '**Satow, E.** *A "title"*. 1874, 2nd, 1 v., chapter, English. London, Murray & Co. read at IA, checked by hand: <https://archive.org/details/a> [UC; no. 7]'
    sinks.write_markdown(books, f"{tmp_path}/md")
    text = [r.value for r in spark.read.text(f"{tmp_path}/md").collect()]
    assert "## O" in text and "## S" in text
    sinks.write_report(books.select("id"), f"{tmp_path}/tsv")
    sinks.append_log(one.select("id"), f"{tmp_path}/log")
    sinks.append_log(one.select("id"), f"{tmp_path}/log")
    assert spark.read.json(f"{tmp_path}/log").count() == 2


def test_build_links_appends_and_publishes(spark):
    schema = "ord long, author string, title string, year string, year_num int, edition string, volume string, links array<string>, other string, source string, type string"
    old = spark.createDataFrame([(0, "Satow, E.", "a diplomat in japan.", "1921", 1921, "", "", None, "Imprint: L | Annotation: x", "UC", "book"), (1, "Aston, W.", "grammar of the japanese written language.", "1872", 1872, "", "", [], "", "UC", "book")], schema)
    new = spark.createDataFrame([(0, "Satow, E.", "A diplomat in Japan", "1922", 1922, "", "", None, "", "Borton", "book"), (1, "Sansom, G.", "japan: a short cultural history", "1931", 1931, "", "", None, "", "Borton", "book")], schema)
    copies = spark.createDataFrame([("aston w|grammar of the japanese written language|1872", "https://gallica.bnf.fr/1")], "rowkey string, url string")
    rows = {r.title: r for r in catalogue.build(old, [("borton", new)], copies).collect()}
    assert set(rows) == {"A Diplomat in Japan", "Grammar of the Japanese Written Language", "Japan: A Short Cultural History"}
    assert rows["A Diplomat in Japan"].source == "UC; Borton" and rows["A Diplomat in Japan"].other == "Imprint: L"
    assert rows["Grammar of the Japanese Written Language"].links == ["https://gallica.bnf.fr/1"]
    assert sorted(r.id for r in rows.values()) == [1, 2, 3]


def test_points_of_every_row(spark):
    """The registered scores beside a plain rendering of the rules."""
    import os
    import re

    import pytest as _pytest

    from lectern.functions import udfs as U
    from lectern.plans import queries as Q

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        _pytest.skip("the driver's tables are not here")
    rules = scoring.RULES["gallica"]
    rows = {r.id: r for r in Q.catalog(spark, sf).collect()}
    got = {r.id: r.points for r in Q.point_scores(spark, sf).collect()}
    assert got.keys() == rows.keys()
    for i, r in rows.items():
        m = re.match(r"(.{12,}?)[;:]\s", r.title) or re.match(r"(.{20,}?)\.\s", r.title)
        mine = [w for w in U.key((m[1] if m else r.title).strip(" .,;:")).split() if len(w) >= 3 and w not in rules.stop]
        told = r.title if i % 3 == 0 else " ".join(r.title.split(" ")[:2]) if i % 3 == 1 else "other words"
        theirs = U.key(told).split()
        if not mine:
            assert got[i] == 0
            continue
        share = sum(w in theirs for w in mine) / len(mine)
        want = 2 if share == 1 else int(share >= 0.75)
        heads = [n.split(",")[0] if "," in n else n.split()[-1] if n.split() else "" for n in re.split(";| and ", r.author)]
        pool = U.key(f"{r.source if i % 2 == 0 else 'nobody'} {told}").split()
        want += int(any(U.key(h).split()[-1:] and U.key(h).split()[-1] in pool for h in heads))
        if r.year_num is not None:
            want += 1 if i % 7 <= 3 else -1
        assert got[i] == want, (i, r)


def test_languages_checked_by_hand_win_and_guesses_come_before_corrections(spark):
    from lectern.plans.catalogue import build

    schema = "ord long, author string, title string, year string, year_num int, edition string, volume string, links array<string>, other string, source string, type string"
    old = spark.createDataFrame([(0, "A, B", "Viajes por Japon", "1900", 1900, "", "", None, "", "UC", "book"), (1, "C, D", "Kunst und Leben", "1901", 1901, "", "", None, "", "UC", "book")], schema)
    fixes = spark.createDataFrame([("a b|viajes por japon|1900", "Travels in Japan")], "rowkey string, title string")
    hand = spark.createDataFrame([("c d|kunst und leben|1901", "Dutch"), ("a b|viajes por japon|1900", "")], "rowkey string, language string")
    got = {r.title: r.language for r in build(old, [], fixes=fixes, languages=hand).collect()}
    assert got == {"Travels in Japan": "Spanish", "Kunst und Leben": "Dutch"}
