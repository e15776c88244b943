"""Records and fields of XML documents by path."""

from lectern.sources.xml import Field, xml_table


def test_fields_by_path(spark):
    good = """<?xml version="1.0" encoding="UTF-8"?><!-- a list --><r xmlns:dc="u"><rec n="1"><dc:t xml:lang="ja">題</dc:t><dc:t xml:lang="en"> A &#x26; B <![CDATA[<i>]]> </dc:t>
      <by><p><s>Satow</s></p><p><s>Aston</s><s/></p></by><rel><rec><dc:t>inner</dc:t></rec></rel></rec><rec><dc:t>only</dc:t></rec><x:rec xmlns:x="v" n="3"/></r>"""
    docs = [(1, good), (2, "no xml <"), (3, None), (4, ""), (5, "<r/>"), (6, "<r><rec><t>" + "long " * 50_000 + "</t></rec></r>")]
    df = spark.createDataFrame(docs, "id int, xml string")
    fields = {"title": Field("t", langs=("en", "ja")), "all": Field("t", many=True), "who": Field("by/p/s", many=True), "n": Field("@n"), "in_": Field("rel/rec/t")}
    got = [tuple(r) for r in xml_table(df, "xml", "rec", fields).filter("id < 6").collect()]
    assert [r for r in got if r[0] == 1] == [
        (1, "A & B <i>", ["題", "A & B <i>"], ["Satow", "Aston"], "1", "inner"),
        (1, "only", ["only"], [], None, None),
        (1, None, [], [], "3", None),
    ]
    assert {r[0] for r in got} == {1}
    (long,) = xml_table(df, "xml", "rec", {"t": Field("t")}).filter("id = 6").collect()
    assert len(long.t) == 249_999
