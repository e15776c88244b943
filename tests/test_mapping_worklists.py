"""Mapping of sources, work lists, look-ups, verdicts, page checks and linking of streams, on small cases."""

import json
import random

import pytest
from pyspark.sql import functions as F

from lectern.functions import text as X
from lectern.functions.udfs import ratio
from lectern.operators import mapping, publish, validate, worklists
from lectern.streaming.linking import online_links


def test_flags_and_decisions(spark):
    rows = spark.createDataFrame([(1, "true"), (2, "false"), (3, "uncertain"), (4, "uncertain"), (5, None), (6, "uncertain")], "id int, japan string")
    said = spark.createDataFrame([(3, True, 1), (4, True, 1), (4, False, 2), (2, True, 1)], "id int, decision boolean, at int")
    got = mapping.with_decisions(rows, said, "id", "japan", "at")
    assert {r.id: r.wanted for r in got.collect()} == {1: True, 2: False, 3: True, 4: False, 5: False, 6: False}
    assert got.columns == ["id", "japan", "wanted"]


@pytest.mark.parametrize("name,want", [("Adams (Francis Ottiwell)", "Adams, Francis Ottiwell"), (" Adams ( F. ) ", "Adams, F."), ("Adams, F.", "Adams, F."), ("(F.)", "(F.)"), ("A (b) c", "A (b) c"), ("", "")])
def test_bracketed_names(spark, name, want):
    assert spark.createDataFrame([(name,)], "n string").select(mapping.bracketed_name(F.col("n"))).first()[0] == want


def entry(**changes):
    return {"author": "Doe, J.", "title": " Japan ", "year": "1880", "year_num": 1880, "section": "I. General", "language": "", "note": "", "skip": None, "pdf_page": 30, "entry_no": 7} | changes


ENTRY = "author string, title string, year string, year_num int, section string, language string, note string, skip string, pdf_page int, entry_no int"


def test_common_records(spark):
    rows = [entry(), entry(skip="article"), entry(title="Япония"), entry(note="Text IN RUSSIAN"), entry(year="", year_num=None, title="Undated"), entry(year_num=1960), entry(section="XXI. China", title="China"), entry(language="Russian", title="Told"), entry(title=None, author=None, note=None, section=None, language=None, pdf_page=510)]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], ENTRY)
    nachod = mapping.common(df, mapping.RULES["nachod"])
    assert sorted(r.title for r in nachod.collect()) == ["", "China", "Japan", "Told"]
    assert nachod.filter("title = 'Japan'").first().place_in == "Nachod (1928) no. 7, p. 179"
    wenckstern = {r.title: r for r in mapping.common(df, mapping.RULES["wenckstern"]).collect()}
    assert set(wenckstern) == {"", "Japan", "Undated"}
    assert wenckstern["Undated"].year == "n.d." and wenckstern["Undated"].year_num is None
    assert wenckstern[""].place_in == "Wenckstern (1907), Pagès supplement p. 2" and wenckstern["Japan"].place_in == "Wenckstern (1907) p. 10"
    gone = spark.createDataFrame([("doe j|japan|1880",), ("doe j|japan|1880",)], "rowkey string")
    assert {r.title for r in mapping.common(df, mapping.RULES["wenckstern"], gone).collect()} == {"", "Undated"}
    assert mapping.common(df.limit(0), mapping.RULES["nachod"]).count() == 0


def test_catalogued_kinds(spark):
    schema = ENTRY + ", kind string, volumes string, wanted boolean"
    rows = [(*entry(author="Adams (F. O.)").values(), "book", "2 v.", True), (*entry(title="M", note="torn").values(), "map", None, True), (*entry(title="P").values(), "periodical", "", True), (*entry(title="N").values(), "book", "", False)]
    got = {r.title: r for r in mapping.common(spark.createDataFrame(rows, schema), mapping.RULES["asj"]).collect()}
    assert set(got) == {"Japan", "M"} and got["Japan"].author == "Adams, F. O." and got["Japan"].volumes == "2 v." and got["Japan"].note == ""
    assert got["M"].note == "torn; A map in the catalogue" and got["M"].place_in.endswith("PDF p. 30, entry 7")


def test_work_lists(spark):
    rows = [(1, "book", 1900, "1900", ["x"]), (2, "book", None, "n.d.", None), (3, "article", 1900, "1900", None), (4, "periodical", 1890, "1890", []), (5, "book", 1950, "c1950", None), (6, None, 1900, None, None)]
    df = spark.createDataFrame(rows, "id int, type string, year_num int, year string, links array<string>").withColumns({"language": F.lit("English"), "rowkey": F.col("id").cast("string")})
    assert [r.id for r in worklists.targets(df, "English").collect()] == [4, 5, 2]
    assert [r.id for r in worklists.targets(df, "English", df.filter("id = 4").select("rowkey"), limit=1).collect()] == [5]
    assert worklists.targets(df, "French").count() == 0
    got = df.select("id", worklists.wants_lookup(F.col("type"), F.col("year_num"), F.col("year")).alias("w"))
    assert {r.id: r.w for r in got.collect()} == {1: True, 2: False, 3: False, 4: True, 5: True, 6: False}


def test_cached_matches(spark):
    cache = spark.createDataFrame([("k", [("far", 1950, "c", 0.9), ("near", 1902, "", 0.9), ("undated", None, "", 0.98), ("exact", 1900, "", 0.8), ("nameless", 1950, "", 1.0)]), ("none", [])], "lkey string, matches array<struct<identifier: string, year: int, creator: string, score: double>>")
    rows = spark.createDataFrame([(1, "k", "Doe, J.", "Short", [1900]), (2, "k", "", "Short", [1900]), (3, "k", None, "One two three four five six", None), (4, "none", "", "x", [1900]), (5, "never", "", "x", [1900])], "id int, lkey string, author string, title string, years array<int>")
    got = {r.id: (r.links, r.others) for r in worklists.split_matches(rows, cache).collect()}
    assert got == {1: (["exact", "near", "undated"], ["far"]), 2: (["exact", "near"], []), 3: (["undated"], []), 4: ([], []), 5: (None, None)}


def test_candidate_filters(spark):
    rows = spark.createDataFrame([(1, ["railway", "japan"], ["railways", "of", "japan"]), (2, ["railway", "japan"], ["korea"]), (3, [], ["x"])], "id int, words array<string>, pool array<string>")
    assert {r.id: r.cov for r in worklists.covering(rows).collect()} == {1: 1.0}
    made = spark.createDataFrame([(1, "old japan", "old japan", "doe", "Old Japan", "Doe, J."), (2, "old japan", "old japan", "doe", "Old Japan", "Roe"), (3, "old japan", "old japan", "", None, None)], "id int, main string, full string, surname string, c_title string, c_creator string")
    assert {r.id: round(r.score, 6) for r in worklists.scored(made).collect()} == {1: 1.1}


def test_verdicts_and_fresh_items(spark):
    review = spark.range(6).withColumnRenamed("id", "line")
    assert [(r.line, r.verdict) for r in worklists.batch_verdicts(review, "line", 4, [1, 9]).orderBy("line").collect()] == [(0, "n"), (1, "y"), (2, "n"), (3, "n")]
    assert {r.verdict for r in worklists.batch_verdicts(review, "line", 2, []).collect()} == {"n"}
    items = spark.createDataFrame([(1, ["a", "b"]), (2, ["c"]), (3, []), (4, None), (5, ["a", "c"])], "id int, urls array<string>")
    known = spark.createDataFrame([(["a", "z"],), (["a"],), (None,)], "urls array<string>")
    assert {r.id for r in worklists.fresh(items, known, "id").collect()} == {2, 3, 4}
    assert worklists.fresh(items, known.limit(0), "id").count() == 5


def test_fuller_descriptions(spark):
    z = "struct<author: string, title: string, year: string, year_num: int, edition: string, volume: string, place: string, publisher: string, pages: string, series: string, abstract: string>"
    schema = f"id int, author string, title string, year string, year_num int, edition string, volume string, other string, z {z}"
    full = ("Doe, J.", "Japan, old and new", "1901", None, "", "", "London", "Kelly", "320", "Lives", "good")
    poor = ("", "Japan", "", None, "", "", "", "", "xii", "", "")
    rows = [(1, "Doe", "Japan", "1900", 1900, "2nd", "", "Cat. p. 3", full), (2, "Doe", "Japan", "1900", 1900, "", "", "", poor), (3, "Doe", "Japan", "1900", 1900, "", "", "Also in Z: x", full), (4, "Doe", "Japan", "1900", 1900, "", "", "x", None)]
    got = {r.id: r for r in publish.fuller_description(spark.createDataFrame(rows, schema), "Z").collect()}
    assert {i: r.fuller for i, r in got.items()} == {1: True, 2: False, 3: False, 4: False}
    assert (got[1].author, got[1].title, got[1].year, got[1].year_num, got[1].edition) == ("Doe, J.", "Japan, old and new", "1901", 1900, "2nd")
    assert got[1].other == "Imprint: London, Kelly | Extent: 320 p. | Series: Lives | Note: good | Description from Z; entered elsewhere as: Doe. Japan. 2nd. 1900 | Cat. p. 3"
    assert got[2].other == "Also in Z: Japan" and got[3].other.endswith("(320 p.)") and got[4].other == "x"


def test_page_numbers(spark):
    rows = [(1, 1, 5, False), (1, 2, 6, False), (1, 3, 6, False), (1, 4, 8, False), (2, 1, 12, False), (3, 1, 13, False), (3, 2, 12, False), (4, 1, 20, True), (4, 2, 21, False), (5, 1, 22, False), (7, 1, 40, False), (8, 1, None, False)]
    own = spark.createDataFrame(rows, "page int, line int, number int, lettered boolean")
    assert {tuple(r) for r in validate.neighbour_errors(own).collect()} == {(1, 6, 6, "repeated"), (1, 6, 8, "jumps"), (3, 13, 12, "goes back")}
    marked = own.withColumn("s", F.col("number") == 6)
    assert {r.error for r in validate.neighbour_errors(marked, suffixed="s").filter("page = 1").collect()} == {"jumps"}
    assert {tuple(r) for r in validate.border_errors(own).collect()} == {(1, 8, 12), (3, 12, 20)}
    assert {tuple(r) for r in validate.border_errors(own, lettered="lettered").collect()} == {(1, 8, 12)}
    assert {tuple(r) for r in validate.order_errors(own).collect()} == {(1, True, False), (3, False, True)}


def test_summaries(spark):
    line = lambda page, n, **r: (page, n, json.dumps(r))
    rows = [line(21, 0, entries_on_page=2, printed_page=1, books=1, skipped=1), line(21, 1, seq=1), line(21, 2, seq=2, skip="article"), line(510, 0, entries_on_page=0, printed_page=490, books=0), line(22, 1, seq=1), (23, 0, "bad")]
    got = validate.summary_errors(spark.createDataFrame(rows, "page int, line int, raw string"), validate.SHAPES["wenckstern"])
    assert {tuple(r) for r in got.collect()} == {(510, "printed_page 490, not 2"), (510, "summary says 0 books and none skipped, file has 0 and 0")}


def plainly(rows, least=0.9, tolerance=3):
    """Every record against every one accepted before it, in order."""
    taken, out = [], {}
    for o, block, key, year in rows:
        fit = [(t, k) for t, b, k, y in taken if b == block and (year is None or y is None or abs(y - year) <= tolerance)] if key else []
        equal, close = [t for t, k in fit if k == key], [t for t, k in fit if ratio(key, k) >= least]
        out[o] = (equal or close or [None])[0]
        if out[o] is None and key:
            taken.append((o, block, key, year))
    return out


def test_stream_links_equal_a_plain_rendering(spark, tmp_path):
    rng = random.Random(5)
    titles = ["Old Japan", "Old Japann", "Old Japan and new", "The inland sea", "Inland sea", "Inland seas", "", None, "Old Korea"]
    schema = "ord long, author string, title string, year int"
    rows = [(n, rng.choice(["Doe, J.", "Roe, R.", None]), rng.choice(titles), rng.choice([None, 1900, 1902, 1910])) for n in range(90)]
    for part in range(3):
        spark.createDataFrame(rows[part * 30 : part * 30 + 30], schema).coalesce(1).write.parquet(f"{tmp_path}/in/p{part}")
    key = X.title_key(F.coalesce("title", F.lit("")))
    keyed = spark.createDataFrame(rows, schema).select("ord", F.concat_ws("|", X.surname(F.col("author")), F.substring_index(key, " ", 1)), key, "year")
    want = plainly([tuple(r) for r in keyed.orderBy("ord").collect()])
    got = {}
    for part in range(3):  # one run for each arrival: what was accepted is in the checkpoint
        (tmp_path / "now").mkdir(exist_ok=True)
        for f in (tmp_path / "in" / f"p{part}").glob("*.parquet"):
            f.rename(tmp_path / "now" / f"{part}-{f.name}")
        made = online_links(spark.readStream.schema(schema).parquet(f"{tmp_path}/now"))
        made.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start().awaitTermination()
    got = {r.ord: r.match for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == want and any(v is not None for v in got.values())
