"""Layouts by hand, and the words of random documents against what was put into them."""

import random

import pytest

from lectern.llm import html_text as H

CASES = {
    "": "",
    "plain  text\n here": "plain text here",
    "<p>a<p>b": "a\n\nb",
    "<p>a</p>b<br>c<br><br>d": "a\n\nb\nc\n\nd",
    "<b>x<p>y</b>z<p>w": "x\n\nyz\n\nw",
    "<div>a<div>b</div>c</div>": "a\nb\nc",
    "<ul><li>a<li>b<ul><li>c</ul><li>d</ul>": "- a\n- b\n  - c\n- d",
    "<ol start=9><li>a<li>b<li value=3>c</ol>": "9. a\n10. b\n3. c",
    "<ol type=i reversed><li>a<li>b</ol>": "ii. a\ni. b",
    "<ol type=A start=27><li>a": "AA. a",
    "<li>alone": "- alone",
    "<table><tr><th>name<th>n<tr><td>long name<td>1</table>": "name       n\nlong name  1",
    "<table><td>a<td>b<tr><td colspan=2>wide wide wide<tr><td>cc<td>d</table>": "a   b\nwide wide wide\ncc  d",
    "<table><tr><td rowspan=2>r<td>x<tr><td>y</table>": "r  x\n   y",
    "<table><tr><td>a<p>b<td>c</table>": "a  c\n\nb",
    "<table><caption>cap</caption>stray<tr><td>x</table>after": "stray\ncap\n\nx\n\nafter",
    "<table><tr><td>a<table><tr><td>in<td>ner</table><td>b</table>": "a        b\n\nin  ner",
    "<dl><dt>t<dd>one<dd>two</dl>": "t\n  one\n  two",
    "<pre>\n a\n\tb </pre>": " a\n\tb",
    "a&nbsp;&nbsp;b &amp;lt; &copy": "a\xa0\xa0b &lt; ©".replace("\xa0", " "),
    "<style>.h,#k{display:none} p.v{visibility:hidden}</style><p class=h>no</p><p id=k>no<p class=v>no <b style=visibility:visible>yes</b></p><p hidden>no<p>end": "yes\n\nend",
    "<script>if (a < b) '</p>'</script><title>t</title>x<!-- <p>no --><noscript>no</noscript><template>no</template>": "x",
    "<head><title>no</title></head><body>x": "x",
    "<details><summary>s</summary>no</details><details open><summary>s</summary>yes</details>": "s\ns\nyes",
    "<select><option>a<option selected>b<option>c</select>": "b",
    "<input type=submit value=Go><input type=hidden value=no><input value=typed><input type=checkbox value=no><input placeholder=hint>x<textarea>\n t</textarea>": "Go typed hint x t",
    "1 < 2 <> 3 </ 4 > x": "1 < 2 <> 3 x",
    "<p title='a>b' class=\"x>y\">q</p": "q",
    "<a href=x>one<a href=y>two</a>": "onetwo",
    "<td>no table<tr>x": "no tablex",
    "<h1>t</h2>u<h2>v</h2>": "t\n\nu\n\nv",
    "</p>x</br>y": "x\ny",
    "<blockquote>q<p>r</blockquote>s": "  q\n\n  r\n\ns",
    "<p style='DISPLAY : none !important'>no</p><div style='display:block' hidden>no</div>z": "z",
}


@pytest.mark.parametrize("source", CASES)
def test_layout(source):
    assert H.render(source) == CASES[source]


SHEETS = {
    "div.x p{display:none}": "<div class=x><b><p>no</b></div><p>yes",
    "div > p{display:none}": "<div><p>no</p><section><p>yes</section></div>",
    "ul.a > li b{display:none}": "<ul class='b a'><li><i><b>no</b></i>yes</ul><li><b>more</b>",
    "p{display:none} p.on{display:block}": "<p>no<p class=on>yes",
    "p.on{display:block} p{display:none !important}": "<p>no<p class=on>no</p>yes",
    "#k .c.d{visibility:hidden} .c.d.e{visibility:visible}": "<div id=k><p class='d c'>no<p class='e d c'>no</p><p class=c>yes</div>",
    "a:hover, b::after, i[x], q + u, s{display:none}": "<a>yes</a><s>no</s>",
    "div p, em{display:none} .w p{display:block}": "<div class=w><p>yes</p></div><div><p>no</div><em>no</em>",
    "*{visibility:hidden} p{visibility:visible}": "<div>no<p>yes</p></div>",
}


@pytest.mark.parametrize("sheet", SHEETS)
def test_selectors(sheet):
    shown = H.render(f"<style>{sheet}</style>{SHEETS[sheet]}")
    assert "no" not in shown and "yes" in shown


def test_long_cells_stay_aligned():
    long = " ".join(f"word{i}" for i in range(30))
    lines = H.render(f"<table><tr><td>{long}<td>b<tr><td>c<td>d</table>").split("\n")
    assert max(map(len, lines)) <= H.CELL_WIDTH + 3 and lines[0].index(" b") == lines[-1].index(" d")
    assert " ".join(" ".join(lines[:-1]).split()).replace(" b", "", 1) == long
    whole = "x" * 200
    lines = H.render(f"<table><tr><td>{whole}<td>b<tr><td>c<td>d</table>").split("\n")
    assert lines[0].index("  b") == lines[1].index("  d") == 200
    assert list(H.wrapped("  a " + "b" * 9 + " c d", 6)) == ["  a", "  bbbbbbbbb", "  c d"]


def test_wide_tables_take_time_in_proportion():
    import time

    began = time.time()
    text = H.render("<table>" + ("<tr>" + "<td>x" * 20_000) * 3 + "</table>")
    assert text.split("\n")[0] == "  ".join("x" * 20_000) and time.time() - began < 10


def test_many_rules_and_depth():
    sheet = "".join(f".a{i} p.b{i}{{display:none}}" for i in range(2000))
    assert H.render(f"<style>{sheet}</style>" + "<div class=a7>" * 3000 + "<p class=b7>no<p class=b8>yes") == "yes"


def random_document(seed):
    """A document, and its visible words in order; tables have one row each so that reading order is plain."""
    r, shown, n = random.Random(seed), [], [0]

    def word(visible):
        n[0] += 1
        if visible:
            shown.append(f"w{n[0]}")
        return f"w{n[0]}"

    def inside(depth, visible):
        out = []
        for _ in range(r.randint(1, 4)):
            kind = r.choice(["text", "p", "div", "ul", "ol", "b", "hidden", "comment", "script", "table", "h2", "pre", "dl", "span"]) if depth < 5 else "text"
            if kind == "text":
                out.append(" " + " ".join(word(visible) for _ in range(r.randint(1, 5))) + r.choice([" ", "<br>", "\n"]))
            elif kind == "hidden":
                out.append(f"<div {r.choice(['hidden', 'style=display:none'])}>{inside(depth + 1, False)}</div>")
            elif kind == "comment":
                out.append("<!-- w0 <p> -->")
            elif kind == "script":
                out.append("<script>'<p>w0</p>'</script>")
            elif kind in ("ul", "ol"):
                out.append(f"<{kind}>" + "".join(f"<li>{inside(depth + 1, visible)}" + r.choice(["", "</li>"]) for _ in range(2)) + f"</{kind}>")
            elif kind == "table":
                out.append(f"<table><tr><td>{' '.join(word(visible) for _ in range(3))}<td>{word(visible)}</table>")
            elif kind == "dl":
                out.append(f"<dl><dt>{word(visible)}<dd>{inside(depth + 1, visible)}</dl>")
            elif kind == "p":
                out.append(f"<p>{word(visible)} <i>{word(visible)}</i>" + r.choice(["", "</p>"]))
            else:
                out.append(f" <{kind}>{inside(depth + 1, visible) if kind not in ('h2', 'pre', 'b', 'span') else word(visible)}</{kind}> ")
        return "".join(out)

    return inside(0, True), shown


@pytest.mark.parametrize("seed", range(60))
def test_all_visible_words_and_no_others(seed):
    source, shown = random_document(seed)
    words = [w for w in H.render(source).split() if w.startswith("w")]
    assert words == shown


def test_depth_and_length_cost_memory_only():
    assert H.render("<div>" * 50_000 + "x" + "</div>" * 50_000) == "x"
    assert H.render("<table><tr><td>" * 300 + "x") == "x"
    assert len(H.render("<p>word " * 50_000).split()) == 50_000
    assert H.render("<p " + 'a="b" ' * 20_000) == ""
    assert H.render('<p a="' * 300) == ""


def test_query_cases(spark):
    rows = spark.createDataFrame([(1, None, "t"), (2, "", "t"), (None, "<p>a", "t"), (2, "<p>b", "t"), (2, "<p>b", "t")], "page_id long, html string, text string")
    got = sorted(((r.page_id, r.text, r.n_chars) for r in H.extract(rows).collect()), key=repr)
    assert got == [(1, "", 0), (2, "", 0), (2, "b", 1), (2, "b", 1), (None, "a", 1)]
    assert H.extract(rows.limit(0)).collect() == []


@pytest.mark.parametrize(
    ("source", "shown"),
    [
        ("<style>@media print{.n{display:none}}</style><p class=n>x", "x"),
        ("<style>@media screen and (max-width:600px){.n{display:none}} @media(max-width:9px){p{visibility:hidden}}</style><p class=n>x", "x"),
        ("<style media=print>.n{display:none}</style><p class=n>x", "x"),
        ("<style>@import 'a'; @media print, screen{.n{display:none} .m{color:red}} .k{display:none}</style><p class=n>no<p class=k>no<p class=m>x", "x"),
        ("<head><title>no</title>plain <b>bold</b><p>x", "plain bold\n\nx"),
        ("<head><title>no</title>\n<a href=y>link</a> <span>more</span>", "link more"),
        ("<head>\n<meta charset=utf-8><script>no</script><link rel=x>\n<style>i{display:none}</style><i>no</i>x", "x"),
    ],
)
def test_visible_text_is_kept(source, shown):
    assert H.render(source) == shown


def test_spanning_cells_have_room():
    wide = "a spanning cell that is wide"
    lines = H.render(f"<table><tr><td colspan=2>{wide}<td>x<tr><td>a<td>b<td>c<tr><td colspan=3>all<td>d</table>").split("\n")
    assert lines[0].index("x") == lines[1].index("c") == len(wide) + 2 and lines[1].index("b") == 3
    assert lines[2].index("d") > lines[0].index("x")
    # one that spans columns that no other row has, one without text, one inside of what it needs
    assert H.render("<table><tr><td colspan=9>t<tr><td>a<td>b</table>") == "t\na  b"
    assert H.render("<table><tr><td colspan=2><td>x<tr><td>a<td>b<td>c</table>") == "      x\na  b  c"
    assert H.render("<table><tr><td colspan=2>abcd<td>x<tr><td>a<td>b<td>c</table>") == "abcd  x\na  b  c"
    assert H.render("<table><tr><td colspan=1000>" + "w " * 40 + "<td>x</table>").count("x") == 1


def test_kept_text_in_cells_is_not_wrapped():
    code = "if  x:" + "   y =  1;" * 12
    lines = H.render(f"<table><tr><td><pre>{code}\n  z</pre><td>n<tr><td>{'word ' * 20}<td>m</table>").split("\n")
    assert lines[0] == code + "  n" and lines[1] == "  z"
    assert max(map(len, lines[2:])) < len(code) + 4 and lines[2].endswith("m") and lines[2].index("m") == lines[0].index("n", len(code))
    # text after the kept one is wrapped again; a line that is longer than a column can be moves its own line only
    after = H.render(f"<table><tr><td><pre>{code}</pre>{'word ' * 20}</table>").split("\n")
    assert after[0] == code and all(len(x) <= H.CELL_WIDTH for x in after[1:]) and " ".join(after[1:]).split() == ["word"] * 20
    long = "k" * (H.WIDEST + 50)
    first, second = H.render(f"<table><tr><td>{long}<td>n<tr><td>a<td>m</table>").split("\n")
    assert first == long + "  n" and second.index("m") == H.WIDEST + 2
