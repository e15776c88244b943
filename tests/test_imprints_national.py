"""Imprints, first names, a national library's records: fixed cases, nulls, empty tables, repeats."""

from pyspark.sql import functions as F

from lectern.functions import text as X
from lectern.operators import mapping as M


def cut(spark, f, *lines):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "n int, x string")
    return [tuple(r.y) if not isinstance(r.y, str) else r.y for r in df.select("n", f(F.col("x")).alias("y")).orderBy("n").collect()]


def test_catalogue_imprint(spark):
    got = cut(spark, X.catalogue_imprint, "Madrid : [s.n.] (Imp. Hispánica)", "[S.l.] : [s.n.] (Madrid : Imp. del Asilo)", "Paris: Doe", "", None, "(x)", "Roma", "A (B : C)", "A : D (B : C)", "(: y)")
    assert got == [("Madrid", "Imp. Hispánica"), ("Madrid", "Imp. del Asilo"), ("Paris", "Doe"), ("", ""), ("", ""), ("", "x"), ("Roma", ""), ("A", "C"), ("A", "D"), ("", "y")]


def test_title_page_imprint(spark):
    long = "Paris: " + ", ".join(["Some Long Name Of A House"] * 4)
    got = cut(spark, X.title_page_imprint, "PARIS: FIRMIN-DIDOT FRÈRES, IMPRIMEURS, RUE JACOB, 56, M.DCCC.L.", "London; John Murray, Albemarle Street, 1890", None, " ;:, ", "Leyden. At the press of X: E. J. Brill. Sold there", long, "Wien [1888 ca.], XII, ab")
    assert got[:5] == [("Paris", "Firmin-Didot Frères"), ("London", "John Murray"), ("", ""), ("", ""), ("Leyden", "E. J")]  # a stop before a capitalised word ends a phrase, after an initial too
    assert got[5] == ("Paris", ", ".join(["Some Long Name Of A House"] * 2)) and got[6] == ("Wien", "")


def test_first_inverted(spark):
    got = cut(spark, X.first_inverted, "Paul H. Clyde & Burton F. Beers", "James Morley, ed.", "Ministry of Finance", "", None, "Plato", "Ann Roe and Bob Poe, eds.", "Ann Roe, Bob Poe, ed. & trs.", "A B C D E")
    assert got == ["Clyde, Paul H. & Burton F. Beers", "Morley, James, ed.", "Ministry of Finance", "", "", "Plato", "Roe, Ann and Bob Poe, eds.", "Roe, Ann, Bob Poe, ed. & trs.", "A B C D E"]


COLUMNS = "n int, pid string, title string, issued string, volume string, place string, publisher string, extent string, series string, language string, issued_all array<string>, creators array<string>, headings array<string>, subjects array<string>, descriptions array<string>, error string, _note string"


def test_national_records(spark):
    none = [None] * 12
    rows = [
        (1, "a", "Momotaro.", "大正6", "The Peach Boy", "Tokyo", "X", None, None, "und", None, ["[by] E. H. House 著", "Walter Medhurst"], [], ["GB-1", "Tales"], None, None, "clash"),
        (2, "a", "Later", "1999", *none[:11], None, None),
        (3, "b", None, *none, None, None),
        (4, "c", "Failed", *none, "timeout", None),
        (5, "d", "Only a title", *none, None, None),
        (6, "e", "Series, part 2", "明治三十年", "part 2", None, None, None, None, "jpn", ["x", "1898"], None, ["House, E. H., 1836-1901", None], None, ["n1"], None, None),
    ]
    df = spark.createDataFrame(rows, COLUMNS)
    got = {r.pid: tuple(r)[1:8] for r in M.national_records(df, "n").collect()}
    assert got == {
        "a": ("House, E. H.; Medhurst, Walter", "Momotaro. The Peach Boy", "1917", 1917, "", "Imprint: Tokyo, X | Subjects: Tales | Statement of responsibility: E. H. House; Walter Medhurst | Date as printed: 大正6 | NDL Digital Collections pid a", "unknown"),
        "d": ("", "Only a title", "n.d.", None, "", "NDL Digital Collections pid d", "unknown"),
        "e": ("House, E. H.", "Series, part 2", "1897", 1898, "", "Language: Japanese | Note: n1 | Date as printed: 明治三十年 | NDL Digital Collections pid e", "unknown"),
    }
    told = spark.createDataFrame([("d", "open"), ("zz", "open"), ("d", "limited")], "pid string, access string")
    notes = spark.createDataFrame([("d", "by hand")], "pid string, note string")
    with_both = {r.pid: (r.access, r.other) for r in M.national_records(df, "n", told, notes).collect()}
    assert with_both["d"] == ("open", "Note: by hand | NDL Digital Collections pid d") and len(with_both) == 3
    assert M.national_records(df.limit(0), "n").collect() == []


def test_build_brings_links_and_notes(spark):
    """A linked record leaves its links and note on the row, in order and once; rows and records without any stay as they are."""
    from lectern.plans.catalogue import build

    schema = "author string, title string, year string, year_num int, edition string, volume string, links array<string>, other string, source string, type string, ord long"
    title = "A long account of gardens in Kyoto"
    old = spark.createDataFrame(
        [("Roe, Ann", title, "1890", 1890, "", "", ["https://a"], "Note: x", "One", "book", 1), ("Poe, Bob", "Another work of some length here", "1880", 1880, "", "", None, "", "One", "book", 2)], schema
    )
    rows = [("Who, Else", title, "1891", 1891, "", "", ["https://b", "https://a"], "", "Two", "book", 1, "Two 1"), ("Who, Else", title, "1890", 1890, "", "", None, "", "Two", "book", 2, None), ("Who, Else", "A third work that is not known yet", "1890", 1890, "", "", None, "", "Two", "book", 3, "Two 3")]
    new = spark.createDataFrame(rows, schema + ", place_in string")
    got = [(r.id, r.source, r.links, r.other) for r in build(old, [("bne", new)]).orderBy("id").collect()]
    assert got == [(1, "One; Two", ["https://a", "https://b"], "Note: x | Two 1"), (2, "One", None, ""), (3, "Two", None, "")]
    again = build(old, [("bne", new.drop("place_in")), ("bne", new.limit(0))])
    assert [r.other for r in again.orderBy("id").collect()] == ["Note: x", "", ""]


def test_sharing_none(spark):
    from lectern.operators.dedupe import sharing_none

    items = spark.createDataFrame([(1, ["a", "b"]), (2, ["c", None]), (3, []), (4, None), (5, [None]), (1, ["z"])], "id int, urls array<string>")
    known = spark.createDataFrame([(["b", "b", None],), (None,), ([],)], "urls array<string>")
    assert sorted(r.id for r in sharing_none(items, known, "id", "urls").collect()) == [2, 3, 4, 5]  # an id's rows go together
    assert sharing_none(items, known.limit(0), "id", "urls").count() == 6 and sharing_none(items.limit(0), known, "id", "urls").count() == 0
