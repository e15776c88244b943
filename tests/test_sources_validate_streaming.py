"""Readers on small files with faults, validators with faults put in, resumable streams."""

import json

import pytest
from pyspark.sql import functions as F

from lectern.operators import validate as V
from lectern.sources import fixture_source as R
from lectern.sources import readers
from lectern.streaming import logs


def pages(tmp_path, files):
    for name, lines in files.items():
        (tmp_path / name).write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines), encoding="utf-8")
    return str(tmp_path)


def uc(page, **changes):
    return {"pdf_page": page, "printed_page": page, "col": "L", "rare": False, "author": "A", "title": "T", "edition": "", "place": "", "publisher": "", "year": "1900", "year_start": 1900, "extent": "", "series": "", "holdings": ["NDL"], "note": ""} | changes


def test_pages_and_records(spark, tmp_path):
    path = pages(tmp_path, {"p011.jsonl": [uc(11), {"empty": True}, "not json", uc(11, title="Second")], "p012.jsonl": [{"entries_on_page": 1}, uc(12)]})
    lines = readers.pages(spark, path)
    assert {(r.page, r.line) for r in lines.collect()} == {(11, 1), (11, 2), (11, 3), (11, 4), (12, 1), (12, 2)}
    got = readers.records(lines, "title string, year_start int").orderBy("page_of_file", "line").collect()
    assert [(r.page_of_file, r.line, r.title) for r in got] == [(11, 1, "T"), (11, 4, "Second"), (12, 2, "T")]


def test_union_catalog_faults(spark, tmp_path):
    missing, extra = uc(11), uc(11) | {"more": 1}
    del missing["note"]
    path = pages(tmp_path, {"p011.jsonl": [uc(11), missing, extra, uc(12), uc(11, col="M"), uc(11, year_start=1960), uc(11, year_start="x"), uc(11, title=" "), uc(11, holdings="NDL"), "{bad", uc(11, year_start=None)]})
    found = {(r.line, r.error) for r in V.check(readers.pages(spark, path), V.SHAPES["union_catalog"]).filter("line IS NOT NULL").collect()}
    assert found == {(2, "missing note"), (3, "extra more"), (4, "pdf_page is not the page"), (5, "col M"), (6, "year_start 1960"), (7, "year_start x"), (8, "empty title"), (9, "holdings is not a list"), (10, "bad JSON")}
    shape = V.SHAPES["union_catalog"]
    assert V.missing_pages(readers.pages(spark, path), shape).count() == 542


def asj(page, n, **changes):
    return {"pdf_page": page, "entry_no": n, "author": "A", "title": "T", "place": "", "year": "c1850", "year_num": 1850, "volumes": "", "kind": "book", "japan": True, "japan_why": "", "note": ""} | changes


def test_headers_and_numbering(spark, tmp_path):
    path = pages(tmp_path, {"p005.jsonl": [{"entries_on_page": 2}, asj(5, 1), asj(5, 2, japan="uncertain", kind="map")], "p006.jsonl": [{"entries_on_page": 3}, asj(6, 1), asj(6, 3, year="1851")], "p007.jsonl": [asj(7, 1), asj(7, 2, kind="film", title="", note="a Cross-reference")]})
    errors = {(r.page, r.line, r.error) for r in V.check(readers.pages(spark, path), V.SHAPES["asj"]).filter("error <> 'missing page'").collect()}
    assert errors == {(6, None, "numbers are not 1..2"), (6, None, "summary says 3 entries, file has 2"), (6, 3, "year does not contain its number"), (7, None, "first line is not a page summary"), (7, 2, "kind film")}


def test_consecutive_numbers(spark, tmp_path):
    entry = lambda page, n: {k: "" for k in V.SHAPES["borton"].keys} | {"pdf_page": page, "entry_no": n, "type": "book", "title": "T", "year_start": None}
    path = pages(tmp_path, {"p001.jsonl": [entry(1, 1), entry(1, 2), {"pdf_page": 1, "entry_no": 3, "skipped": "index"}], "p002.jsonl": [entry(2, 5), entry(2, 7)]})
    errors = {(r.page, r.error) for r in V.check(readers.pages(spark, path), V.SHAPES["borton"]).filter("error <> 'missing page'").collect()}
    assert errors == {(1, "ends at 3, next page starts at 5"), (2, "gap between 5 and 7")}
    assert tuple(V.totals(readers.pages(spark, path), V.SHAPES["borton"]).first()) == (2, 5)


@pytest.mark.parametrize("source", V.SHAPES)
def test_every_shape_runs_on_nothing(spark, tmp_path, source):
    path = pages(tmp_path, {"p999.jsonl": [""]})
    errors = V.check(readers.pages(spark, path), V.SHAPES[source]).collect()
    assert errors and {r.error for r in errors} == {"missing page"}


def test_keyed_log_decisions_and_lists(spark, tmp_path):
    (tmp_path / "log.jsonl").write_text('{"key":"a","v":1}\nbad\n{"key":"b","v":2}\n{"key":"a","v":3}\n{"v":4}\n')
    assert {(r.key, r.v) for r in readers.keyed_log(spark, f"{tmp_path}/log.jsonl", "key string, v int", "key").collect()} == {("a", 3), ("b", 2)}
    (tmp_path / "d.tsv").write_text("# comment\nk1\tark1\tYES\textra\nk2\tark2\n\n k3 \tark3\tno\n")
    got = readers.decisions(spark, f"{tmp_path}/d.tsv", ["rowkey", "candidate", "verdict"], lower=["verdict"])
    assert {tuple(r) for r in got.collect()} == {("k1", "ark1", "yes"), ("k3", "ark3", "no")}
    (tmp_path / "ids.txt").write_text("https://x.org/pid/12 a\n# no\nhttps://x.org/pid/7\nhttps://x.org/pid/12\n")
    assert [r.id for r in readers.id_list(spark, f"{tmp_path}/ids.txt", r"/pid/(\d+)").orderBy("pos").collect()] == ["12", "7"]


def test_xml_rdf_html(spark):
    xml = "<r><oai:record x='1'><dc:title>A &amp; B</dc:title><dc:creator>X</dc:creator><dc:creator>Y</dc:creator></oai:record><oai:record><dc:title>C</dc:title></oai:record></r>"
    df = spark.createDataFrame([(1, xml)], "id int, xml string")
    rows = readers.xml_records(df, "xml", "record", {"title": "title", "creators": "creator"}, ["creators"]).collect()
    assert [(r.title, r.creators) for r in rows] == [("A & B", ["X", "Y"]), ("C", [])]
    rdf = '<rdf:RDF xmlns:rdf="r" xmlns:d="d" xmlns:b="b" xmlns:f="f"><b:Book rdf:about="https://x.org/1"><d:title>T</d:title><d:date>1900</d:date><b:authors><rdf:Seq><rdf:li><f:Person><f:surname>S</f:surname><f:givenName>E</f:givenName></f:Person></rdf:li></rdf:Seq></b:authors><d:subject>art</d:subject><d:identifier><rdf:value>https://x.org/1</rdf:value></d:identifier><d:identifier><rdf:value>https://y.org</rdf:value></d:identifier></b:Book></rdf:RDF>'
    row = readers.rdf_items(spark.createDataFrame([(rdf,), ("broken <",)], "value string")).first()
    assert (row.title, row.date, row.authors, row.subjects, set(row.urls)) == ("T", "1900", ["S, E"], ["art"], {"https://x.org/1", "https://y.org"})
    page = "<table><tr><th>Title:</th><td>My <b>book</b></td></tr><tr><td>Year</td><td>1900</td></tr></table><a class=x href=\"/a?b=1&amp;c=2\">Go</a>"
    got = spark.createDataFrame([(page,)], "h string").select(readers.html_fields(F.col("h"), ["Title", "Year", "Place"]).alias("f"), readers.anchors(F.col("h")).alias("a")).first()
    assert got.f == {"Title": "My book", "Year": "1900"} and [tuple(a) for a in got.a] == [("/a?b=1&c=2", "Go")]
    block = '<ul class="nodot"><li><a href="/lookupid?key=olbp1">[Info]</a> Doe: <a href="https://archive.org/details/x">read</a> <a href="https://hathitrust.org/1">H</a> <cite>Old Japan</cite> (London, 1871)</li><li><a href="/lookupid?key=olbp2">i</a> <cite>Other</cite> x</li></ul>'
    one = spark.createDataFrame([(block,)], "h string").select(readers.result_blocks(F.col("h")).alias("r")).first().r
    assert [(x.key, x.title, [c.url for c in x.copies], [c.url for c in x.dropped]) for x in one] == [("olbp1", "Old Japan", ["https://archive.org/details/x"], ["https://hathitrust.org/1"]), ("olbp2", "Other", [], [])]
    pick = spark.createDataFrame([([("de", "a"), ("en", "b")],)], "v array<struct<lang:string,value:string>>")
    assert pick.select(readers.preferred(F.col("v"), "en"), readers.preferred(F.col("v"), "fr")).first() == ("b", "a")


def test_connector_retries_and_batches(spark):
    calls, waits = [], []

    def flaky(q):
        calls.append(q)
        if len(calls) < 3:
            raise OSError("busy")
        return q.upper()

    assert R.with_retries(flaky, 4, 1, 3, waits.append)("a") == ("A", None) and waits == [1, 3]
    assert R.with_retries(lambda q: 1 / 0, 2, 1, 2, waits.append)("a")[1].startswith("ZeroDivisionError")
    asked = spark.createDataFrame([(f"q{i}",) for i in range(7)], "request string")
    got = R.fetched(asked, lambda qs: [(q + str(len(qs)), None) for q in qs], batch=3).collect()
    assert len(got) == 7 and all(r.answer[-1] in "123" for r in got)
    saved = spark.createDataFrame([("q1", "x")], "request string, answer string")
    assert {r.request: r.error for r in R.saved_answers(asked, saved).collect()}["q2"] == "no saved answer"


def test_resume_answers_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    write = lambda n, keys: (tmp_path / "in" / f"{n}.json").write_text("\n".join(json.dumps({"key": k}) for k in keys))
    run = lambda: logs.resume(logs.stream_requests(spark, f"{tmp_path}/in", "key string"), "key", lambda df: df.withColumn("answer", F.upper("key")), f"{tmp_path}/log", f"{tmp_path}/cp").awaitTermination(60)
    write(1, ["a", "b", "a"])
    run()
    write(2, ["b", "c"])
    run()
    got = spark.read.json(f"{tmp_path}/log").collect()
    assert sorted((r.key, r.answer) for r in got) == [("a", "A"), ("b", "B"), ("c", "C")]
