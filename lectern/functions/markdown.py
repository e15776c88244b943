"""A small Markdown renderer for the published pages: headings with ids, paragraphs, nested bullet lists, emphasis, links."""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_INLINE = (
    (re.compile(r"`([^`]+)`"), r"<code>\1</code>"),
    (re.compile(r"\[([^\]]+)\]\(([^)\s]+)\)"), r'<a href="\2">\1</a>'),
    (re.compile(r"\*\*(.+?)\*\*"), r"<strong>\1</strong>"),
    (re.compile(r"(?<![\w*])\*([^*\s](?:[^*]*[^*\s])?)\*(?![\w*])"), r"<em>\1</em>"),
)


def heading_id(text: str) -> str:
    return re.sub(r"[^a-z0-9]+", "-", text.lower()).strip("-")


def inline(text: str) -> str:
    out = html.escape(text, quote=True)
    for pattern, made in _INLINE:
        out = pattern.sub(made, out)
    return out


def render(source: str | None) -> str:
    """HTML of a Markdown text; '' for null. Indents of bullets make levels, whatever their width."""
    out: list[str] = []
    paragraph: list[str] = []
    indents: list[int] = []

    def end_paragraph() -> None:
        if paragraph:
            out.append(f"<p>{inline(' '.join(paragraph))}</p>")
            paragraph.clear()

    def close_lists(to: int = -1) -> None:
        while indents and indents[-1] > to:
            indents.pop()
            out.append("</li></ul>")

    for line in (source or "").splitlines():
        bullet = re.match(r"(\s*)[-*]\s+(.*)", line)
        heading = re.match(r"(#{1,6})\s+(.*?)\s*#*$", line)
        if bullet:
            end_paragraph()
            depth = len(bullet[1].expandtabs(4))
            close_lists(depth)
            if indents and indents[-1] == depth:
                out.append("</li>")
            else:
                indents.append(depth)
                out.append("<ul>")
            out.append(f"<li>{inline(bullet[2])}")
        elif heading:
            end_paragraph()
            close_lists()
            n = len(heading[1])
            out.append(f'<h{n} id="{heading_id(heading[2])}">{inline(heading[2])}</h{n}>')
        elif not line.strip():
            end_paragraph()
        elif indents and line[:1].isspace():
            out.append(" " + inline(line.strip()))
        else:
            close_lists()
            paragraph.append(line.strip())
    end_paragraph()
    close_lists()
    return "\n".join(out)


@F.pandas_udf(StringType())
def to_html(source: pd.Series) -> pd.Series:
    return source.map(render)
