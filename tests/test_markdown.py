import pytest

from lectern.functions import markdown as M


@pytest.mark.parametrize(
    ("source", "want"),
    [
        (None, ""),
        ("# A title\ntext *em* and **strong**\nmore", '<h1 id="a-title">A title</h1>\n<p>text <em>em</em> and <strong>strong</strong> more</p>'),
        ("- a\n  - b\n  - c\n- d", "<ul>\n<li>a\n<ul>\n<li>b\n</li>\n<li>c\n</li></ul>\n</li>\n<li>d\n</li></ul>"),
        ("[x](http://a.b/?c=1&d=2) <b> `2*3*4`", '<p><a href="http://a.b/?c=1&amp;d=2">x</a> &lt;b&gt; <code>2*3*4</code></p>'),
        ("- a\nafter", "<ul>\n<li>a\n</li></ul>\n<p>after</p>"),
    ],
)
def test_render(source, want):
    assert M.render(source) == want


def test_column(spark):
    rows = spark.createDataFrame([("# A",), (None,)], "t string").select(M.to_html("t")).collect()
    assert [r[0] for r in rows] == ['<h1 id="a">A</h1>', ""]
