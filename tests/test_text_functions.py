"""Text functions: hand-worked cases, and agreement of the built-in and the exact fold."""

import unicodedata

import pytest
from pyspark.sql import functions as F

from lectern.functions import agreement as A
from lectern.functions import text as X
from lectern.functions import udfs as U
from lectern.operators import attach
from lectern.operators.similar import letters_bound


def one(spark, column, **values):
    kinds = {int: "long", str: "string", list: "array<string>", type(None): "string"}
    schema = ", ".join(f"{k} {kinds[type(v)]}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("given", "want"), [("Łódź, 1874–75", "odz 1874 75"), ("ﬁn de siècle", "fin de siecle"), ("½ œuvre ß", "1 2 uvre"), ("ＡＢＣ１２", "abc12"), ("  A--B  ", "a b"), ("日本", ""), ("", "")])
def test_norm(spark, given, want):
    assert one(spark, X.norm(F.col("t")), t=given) == want == U.key(given)


def test_folds_agree_on_latin_text(spark):
    texts = [chr(c) + "x" for c in range(0x20, 0x250)] + [chr(c) for c in range(0x1E00, 0x1F00)] + ["ﬀ ﬃ", "Ĳsselmeer"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", X.norm(F.col("t")).alias("a")).collect()
    assert all(r.a == U.key(r.t) for r in rows)


def test_norm_is_idempotent(spark):
    df = spark.createDataFrame([("Ünï  cödé -- 12",), ("Straße",)], "t string")
    once = X.norm(F.col("t"))
    assert all(r.a == r.b for r in df.select(once.alias("a"), X.norm(once).alias("b")).collect())


@pytest.mark.parametrize(
    ("given", "want"),
    [
        ("A history of Japan: from the beginning", "A history of Japan"),
        ("Japan: a history", "Japan: a history"),
        ("The story of old Japan. Second part", "The story of old Japan"),
        ("Short. Second part of it", "Short. Second part of it"),
        ("Letters Translated by X", "Letters"),
        ("Japan; its people;", "Japan; its people"),
    ],
)
def test_main_title(spark, given, want):
    assert one(spark, X.main_title(F.col("t")), t=given) == want


def test_candidate_and_proper_titles(spark):
    assert one(spark, X.candidate_title(F.col("t")), t="Japan : a history / by X") == "Japan"
    assert one(spark, X.title_proper(F.col("t")), t="Tales of old Japan, with illustrations") == "Tales of old Japan"


@pytest.mark.parametrize(("given", "want"), [("Satow, Ernest", "satow"), ("(Satow, Ernest)", "satow"), ("Van der Berg, A", "berg"), ("One two three four, A", ""), ("Japan Society", ""), (None, "")])
def test_surname(spark, given, want):
    assert one(spark, X.surname(F.col("a")), a=given) == want


def test_surname_variants(spark):
    assert one(spark, X.surname(F.col("a"), plain_names=True), a="Ernest Satow") == "satow"
    assert one(spark, X.surnames(F.col("a")), a="Satow, E. and Basil Hall Chamberlain; Aston") == ["satow", "chamberlain", "aston"]


@pytest.mark.parametrize(("given", "want"), [("Willard Price", "Price, Willard"), ("Price, Willard", "Price, Willard"), ("The Japan Society", "The Japan Society"), ("Plato", "Plato"), ("not available", "")])
def test_invert_name(spark, given, want):
    assert one(spark, X.invert_name(F.col("a")), a=given) == want


def test_years(spark):
    assert one(spark, X.years_in(F.col("t")), t="c1874, 21874 and 1905") == [1874, 1905]
    assert one(spark, X.tail_year(F.col("t")), t="1874-75") == 1875
    assert one(spark, X.tail_year(F.col("t")), t="1905-6") == 1906
    assert one(spark, X.record_years(F.col("t"), F.lit(None).cast("int")), t="1899-1900") == [1899, 1900]
    assert one(spark, X.in_range(X.years_in(F.col("t"))), t="n.d.") is None
    assert one(spark, X.in_range(X.years_in(F.col("t"))), t="1849 1956") is True
    assert one(spark, X.leading_year(F.lit(None).cast("string"), F.col("t")), t="1899-05-01") == 1899


def test_volume_and_stop(spark):
    assert one(spark, X.volume(F.col("e"), F.lit("")), e="xii, 2v. (maps)") == "2 v. (maps)"
    assert one(spark, X.volume(F.lit(""), F.col("t")), t="Reisen, Bd. IV") == "Bd. IV"
    assert one(spark, X.trim_stop(F.col("t")), t="A title. ") == "A title"
    assert one(spark, X.trim_stop(F.col("t")), t="By W. A.") == "By W. A."
    assert one(spark, X.trim_stop(F.col("t")), t="And so ...") == "And so ..."


def test_links_and_access(spark):
    assert one(spark, X.holder(F.col("u")), u="https://archive.org/details/x") == "IA"
    assert one(spark, X.holder(F.col("u")), u=None) == ""
    assert one(spark, X.archive_ids(F.col("l")), l=["https://archive.org/details/abc", "https://x.org/1"]) == ["abc"]
    assert one(spark, X.normal_url(F.col("u")), u="http://www.archive.org/details/x ") == "https://archive.org/details/x"
    assert one(spark, X.reachable(F.col("u")), u="http://shelf.local/a") is False
    assert one(spark, X.rights_access(F.col("r")), r=["Internet"]) == "open"
    assert one(spark, X.rights_access(F.col("r")), r=["館内"]) == "limited"
    assert one(spark, X.rights_access(F.array().cast("array<string>")), r="") == "unknown"
    assert one(spark, X.item_access(F.col("r"), F.array(F.lit("is_lendable")), F.lit(True)), r="true") == "borrow"
    assert one(spark, X.offered_access(F.col("a"), F.lit(True)), a="printdisabled-only") == "borrow"


def test_imprint_split_and_script(spark):
    got = one(spark, X.imprint_parts(F.col("o")), o="Imprint: Cambridge, Mass., Harvard, Press | In: Journal")
    assert tuple(got) == ("Cambridge, Mass.", "Harvard, Press", "Journal")
    assert one(spark, X.split_volume(F.col("v"), F.lit(1925)), v="1925").designation == ""
    assert one(spark, X.split_volume(F.col("v"), F.lit(1925)), v="巻1").designation == "巻1"
    assert one(spark, X.split_volume(F.col("v"), F.lit(1925)), v="MOMOTARO The Story").part_title == "MOMOTARO The Story"
    assert one(spark, X.mostly_latin(F.col("t")), t="Satow 薩") is True
    assert one(spark, X.bucket_letter(F.col("a"), F.lit("x")), a="*[Étude") == "E"


def test_similarity_keeps_the_defaults():
    long = "ab" * 130
    assert U.ratio("abcd", "bcde") == 0.75
    assert U.ratio("z" + long, long) < 0.1  # popular characters are junk from 200 on


def answers(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + schema).orderBy("i").select(column).collect()]


def test_same_title(spark):
    cases = [
        ("Japanese architecture of today", "Japanese architecture of today and tomorrow", False, True),
        ("Die Architektur Japans", "Die Architeckur Japans", False, True),
        ("Criminal code of Japan", "Civil code of Japan", False, False),
        ("Report 1899", "Report 1900", False, False),
        ("Report 1899 of 1900", "Report 1900 of 1899", True, False),
        ("", "x", False, False),
        (None, "x", False, False),
        ("equal", "equal", True, True),
        ("Japanese architecture of today", "Japanese architecture of today and tomorrow", True, False),
        ("On the art of a garden in old Kyoto", "On the art of a gardens in old Kyoto", True, True),
        ("A history of it", "A history of us", False, False),
    ]
    a, b = X.norm(F.col("a")), X.norm(F.col("b"))
    got = answers(spark, [c[:3] for c in cases], "a string, b string, strict boolean", A.same_title(a, b, a, b, F.col("strict")))
    assert got == [c[3] for c in cases]
    fit = A.spelled_alike(F.col("a"), F.col("b"))
    assert answers(spark, [("a b", "a b"), ("a color", "a colour"), ("my color", "at colour"), ("of color", "ox colour"), ("red house", "blue house")], "a string, b string", fit) == [True, True, False, True, False]


def test_titles_agree(spark):
    cases = [
        ("The Mikado's Empire", "Griffis, W. E.", "Mikado's empire: history of Japan", "Griffis, William Elliot", False, True),
        ("Japan and Korea: questions and answers", "Doe, J.", "Japan and Korea, map of missions", "Roe, R.", True, False),
        ("Annual report 3", "A, B", "Annual report 4", "A, B", False, False),
        ("", "", "x", "", False, False),
        (None, None, "x", None, False, False),
        ("Gardens of Kyoto", "Doe, J.", "Gardens of Kyoto", "Roe, R.", True, False),
        ("Stone gardens of Kyoto", "Doe, J.", "Stone gardens of Kyoto", "Roe, R.", False, True),
        ("Gardens of Kyoto", "Doe, J.", "Gardens of Kyoto", "", True, True),
        ("Old stone gardens of Kyoto, translated by X", "Doe, J.", "Old stone gardens of Kyotoo", "Roe, R.", True, True),
    ]
    df = spark.createDataFrame([(i, *c[:5]) for i, c in enumerate(cases)], "i int, t1 string, a1 string, t2 string, a2 string, strict boolean")
    got = attach.with_titles_agree(df, "agrees", "t1", "a1", "t2", "a2", F.col("strict"))
    assert got.columns == [*df.columns, "agrees"] and [r.agrees for r in got.orderBy("i").collect()] == [c[5] for c in cases]


@pytest.mark.parametrize(("given", "want"), [("the history of old japan", "The History of Old Japan"), ("notes: the end", "Notes: The End"), ("O'Brien and the KBS", "O'Brien and the KBS"), ("japan's (new) art-life", "Japan's (New) Art-Life"), ("", "")])
def test_title_case(given, want):
    assert U.title_case(given) == want


def test_capitals(spark):
    forms = {"ghq": "GHQ", "macarthur": "MacArthur"}
    cases = [
        ("THE MCCOY REPORT OF GHQ: A STORY", "The McCoy Report of GHQ: A Story"), ("Already Mixed", "Already Mixed"), ("", ""), (None, None), ("MACARTHUR'S  JAPAN'S", "MacArthur's  Japan's"),
        ("(THE) END-OF-THE-ROAD AND \u201cÉTÉ\u201d", "(The) End-of-the-Road and \u201cÉté\u201d"), ("  A : THE - OF MC", "  A : The - of Mc"), ("1945: OF WAR; OF PEACE", "1945: Of War; of Peace"), ("...", "..."),
    ]
    assert answers(spark, [c[:1] for c in cases], "c string", X.from_capitals(F.col("c"), forms)) == [c[1] for c in cases]
    assert answers(spark, [("GHQ OF",)], "c string", X.from_capitals(F.col("c"))) == ["Ghq of"]


def test_templates():
    assert U.decode_template("caf{g0nae} {x1} {zz}", {"x1": "★"}) == unicodedata.normalize("NFC", "café") + " ★ {zz}"


def test_eras(spark):
    texts = [("大正6年, 昭和12.8, 明治元", "1917, 1937.8, 1868"), ("no date", "no date"), ("明治二十三年", "1890"), (None, ""), ("昭和 十年と大正一年", "1935と1912"), ("明治0", "明治0")]
    assert answers(spark, [t[:1] for t in texts], "c string", X.to_western(F.col("c"))) == [t[1] for t in texts]
    assert answers(spark, [("二十三",), ("十",), ("x",), ("17",), ("九",)], "c string", X.numeral(F.col("c"))) == [23, 10, 0, 17, 9]
    years = answers(spark, [("大正6", "1930"), (None, "昭和二年"), ("", ""), ("x 1899", "1900")], "a string, b string", X.western_year(F.col("a"), F.col("b")))
    assert years == [1930, 1927, None, 1899]


def test_coverage_and_scores(spark):
    cases = [
        (["japan", "historical"], ["japanese", "history"], 0.5), ([], ["a"], 0.0), (None, None, 0.0), (["1868"], ["18680", "1869"], 0.0), (["1868", "1868"], ["1868"], 1.0),
        (["abcd"], ["abcde"], 1.0), (["abc"], ["abcd"], 0.0), (["letters"], ["lettars"], 1.0), (["letter"], ["lettar"], 0.0), (["japan", "x"], [], 0.0), (["art", "arts"], ["art"], 0.5),
    ]
    df = spark.createDataFrame([(i, *c[:2]) for i, c in enumerate(cases)], "i int, w array<string>, p array<string>")
    got = A.with_found_share(df, "x", F.col("w"), F.col("p"))
    assert got.columns == ["i", "w", "p", "x"] and [r.x for r in got.orderBy("i").collect()] == [c[2] for c in cases]
    assert sorted(r.i for r in got.filter("x >= 0.5").collect()) == [i for i, c in enumerate(cases) if c[2] >= 0.5]
    named = [
        ("history of japan", "history of japan", "satow", "History of Japan", "Satow, E.", 1.1), ("history of japan", "history of japan", "satow", "History of Japan", "Other", 0.75),
        ("", "", "", "x", None, 0.0), ("a b", "a b", "s", "***", "S", 0.0), (None, None, None, None, None, 0.0), ("history", "history of art", "", "History of Art", "Anyone", 1.0),
        ("history", "history x", "s", "History and more of it", None, 2 * 7 / 17 - 0.05),
    ]
    columns = [F.col(c) for c in "mfstc"]
    assert answers(spark, [c[:5] for c in named], "m string, f string, s string, t string, c string", A.offer_score(*columns)) == [pytest.approx(c[5]) for c in named]
    bound = answers(spark, [c[:5] for c in named], "m string, f string, s string, t string, c string", A.offer_score(*columns, ratio_of=letters_bound))
    assert all(b >= c[5] - 1e-9 for b, c in zip(bound, named, strict=True))
