"""Sinks: the published table, Markdown, CSV, BibTeX, COinS, reports, logs. Lines are made by column expressions and written by
Spark's writers, in order where order matters (a range partitioning, not one task)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lectern.functions import text as X
from lectern.operators.publish import BOOKS

CSV_COLUMNS = ["id", "author", "title", "year", "edition", "volume", "type", "language", "access", "links", "links_access", "links_checked", "other", "source"]


def _blank(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def _joined(df: DataFrame, c: str) -> Column:
    kind = dict(df.dtypes)[c]
    if kind == "array<boolean>":
        return F.array_join(F.transform(c, lambda x: F.when(x, "1").otherwise("0")), "\n")
    return F.coalesce(F.array_join(c, "\n"), F.lit("")) if kind.startswith("array") else _blank(c)


def write_books(books: DataFrame, path: str) -> None:
    """The published table, sorted by id within ranges of ids, so that a lookup by id reads few row groups."""
    missing = [f for f in BOOKS if f.name not in books.columns]
    whole = books.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}) if missing else books
    whole.select(*BOOKS.fieldNames()).repartitionByRange("id").sortWithinPartitions("id").write.mode("overwrite").parquet(path)


def csv_line(df: DataFrame, columns: Sequence[str] = CSV_COLUMNS) -> Column:
    """All cells quoted, quotes doubled, line breaks as spaces."""
    cell = lambda c: F.concat(F.lit('"'), F.replace(F.replace(_joined(df, c), F.lit('"'), F.lit('""')), F.lit("\n"), F.lit(" ")), F.lit('"'))
    return F.concat_ws(",", *map(cell, columns))


def csv_header(columns: Sequence[str] = CSV_COLUMNS) -> str:
    return "﻿" + ",".join(columns)


def write_csv(books: DataFrame, path: str, columns: Sequence[str] = CSV_COLUMNS) -> None:
    """The answer to a search as CSV, in its order; the header stands in the first part file."""
    head = books.sparkSession.createDataFrame([(-1, csv_header(columns))], "n long, value string")
    lines = books.select(F.col("id").alias("n"), csv_line(books, columns).alias("value"))
    head.unionByName(lines).repartitionByRange("n").sortWithinPartitions("n").select("value").write.mode("overwrite").text(path)


def _escaped(c: Column) -> Column:
    return F.btrim(F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), r"[{}\\]", ""), r"\s+", " "))


def bibtex_key(author: Column, title: Column, year: Column) -> Column:
    """Surname, year and the first word of more than three letters, folded; dedupe.suffixed makes keys distinct."""
    last = F.regexp_extract(F.btrim(F.substring_index(F.coalesce(author, F.lit("")), ",", 1)), r"(\S+)$", 1)
    word = F.coalesce(F.get(F.filter(F.split(F.coalesce(title, F.lit("")), r"\s+"), lambda w: (F.length(w) > 3) & w.rlike("^[A-Za-z]")), F.lit(0)), F.lit(""))
    made = F.concat(X.search_fold(F.when(last == "", "anon").otherwise(last)), F.coalesce(year.cast("string"), F.lit("nd")), X.search_fold(word))
    return F.regexp_replace(made, "[^a-z0-9]", "")


def bibtex_entry(key: Column) -> Column:
    """An entry of books, under a key; fields without a value are left out."""
    kind = F.when(F.col("type") == "article", "article").when(F.col("type") == "chapter", "incollection").when(F.col("type") == "periodical", "periodical").otherwise("book")
    parts = X.imprint_parts(F.col("other"))
    note = F.when(_blank("source") != "", F.concat(F.lit("Listed in "), "source"))
    fields = [("author", F.col("author")), ("title", F.col("title")), ("year", F.col("year")), ("publisher", parts["publisher"]), ("address", parts["place"]), ("edition", F.col("edition")), ("volume", F.col("volume")), ("language", F.col("language"))]
    made = [F.when(_escaped(v) != "", F.concat(F.lit(f"  {n} = {{"), _escaped(v), F.lit("}"))) for n, v in fields]
    container = _escaped(parts["container"])
    made.append(F.when(container != "", F.concat(F.lit("  "), F.when(F.col("type") == "article", "journal").otherwise("booktitle"), F.lit(" = {"), container, F.lit("}"))))
    made += [F.when(_escaped(v) != "", F.concat(F.lit(f"  {n} = {{"), _escaped(v), F.lit("}"))) for n, v in (("url", F.get("links", F.lit(0))), ("note", note))]
    return F.concat(F.lit("@"), kind, F.lit("{"), key, F.lit(",\n"), F.concat_ws(",\n", *made), F.lit("\n}"))


def _component(c: Column) -> Column:
    """Percent-encoded as in an address's component: spaces as %20."""
    out = F.replace(F.url_encode(c), F.lit("+"), F.lit("%20"))
    for code, char in (("%21", "!"), ("%27", "'"), ("%28", "("), ("%29", ")"), ("%7E", "~")):
        out = F.replace(out, F.lit(code), F.lit(char))
    return out


def coins() -> Column:
    """An entry of books as an OpenURL context object, in a span."""
    parts = X.imprint_parts(F.col("other"))
    article = F.col("type").isin("article", "chapter")
    genre = F.when(F.col("type") == "chapter", "bookitem").when(F.col("type") == "article", "article").otherwise("book")
    fields = [
        (F.lit("ctx_ver"), F.lit("Z39.88-2004")),
        (F.lit("rft_val_fmt"), F.when(article, "info:ofi/fmt:kev:mtx:journal").otherwise("info:ofi/fmt:kev:mtx:book")),
        (F.lit("rft.genre"), genre),
        (F.when(article, "rft.atitle").otherwise("rft.btitle"), F.col("title")),
        (F.lit("rft.title"), F.when(article, parts["container"]).otherwise(F.col("title"))),
        (F.lit("rft.jtitle"), F.when(F.col("type") == "article", parts["container"])),
        (F.lit("rft.au"), F.col("author")),
        (F.lit("rft.date"), F.col("year")),
        (F.lit("rft.pub"), parts["publisher"]),
        (F.lit("rft.place"), parts["place"]),
        (F.lit("rft.edition"), F.col("edition")),
        (F.lit("rft.volume"), F.col("volume")),
        (F.lit("rft.language"), F.col("language")),
        (F.lit("rft_id"), F.get("links", F.lit(0))),
    ]
    pairs = [F.when(F.coalesce(v, F.lit("")) != "", F.concat(k, F.lit("="), _component(v))) for k, v in fields]
    return F.concat(F.lit('<span class="Z3988" title="'), X.html_escape(F.concat_ws("&", *pairs)), F.lit('"></span>'))


def citation() -> Column:
    """Author, title, edition, imprint and year in a line; the title gets a full stop unless it ends a sentence itself."""
    title = F.concat("title", F.when(F.col("title").rlike("[.?!]$"), "").otherwise("."))
    made = F.btrim(F.regexp_extract(_blank("other"), r"Imprint: ([^|]+)", 1))
    parts = F.concat_ws(" ", *(F.nullif(c, F.lit("")) for c in (_blank("author"), title, _blank("edition"), made, _blank("year"))))
    return F.concat(F.regexp_replace(parts, r"\s+", " "), F.lit("."))


def archive_search_url() -> Column:
    """Where to look for an entry by hand: its title up to the first mark, and its author's surname."""
    creator = F.when(_blank("author") != "", F.concat(F.lit(" AND creator:("), F.substring_index("author", ",", 1), F.lit(")"))).otherwise("")
    asked = F.concat(F.lit("title:("), F.split("title", "[.;:]", 2)[0], F.lit(")"), creator)
    return F.concat(F.lit("https://archive.org/search?query="), _component(asked))


def markdown_entry() -> Column:
    """An entry as a line of the printed list, with its links and where it is listed."""
    author = F.when(_blank("author") != "", F.concat(F.lit("**"), F.regexp_replace("author", r"\.+$", ""), F.lit(".** "))).otherwise("")
    tail = F.concat_ws(", ", F.coalesce(F.nullif(_blank("year"), F.lit("")), F.lit("n.d.")), F.nullif(_blank("edition"), F.lit("")), F.nullif(_blank("volume"), F.lit("")), F.when(F.col("type") != "book", F.nullif(_blank("type"), F.lit(""))), F.nullif(_blank("language"), F.lit("")))
    imprint = F.btrim(F.regexp_extract(_blank("other"), r"Imprint: ([^|]+)", 1))
    zipped = F.transform(F.arrays_zip(F.coalesce("links", F.array().cast("array<string>")).alias("url"), F.coalesce("links_access", F.array().cast("array<string>")).alias("access"), F.coalesce("links_checked", F.array().cast("array<boolean>")).alias("checked")), lambda z: F.concat(F.when(z["access"] == "open", "read").when(z["access"] == "borrow", "borrow").otherwise("view"), F.lit(" at "), X.holder(z["url"]), F.when(z["checked"], ", checked by hand").otherwise(""), F.lit(": <"), z["url"], F.lit(">")))
    listed = F.concat(F.lit("["), _blank("source"), F.lit("; no. "), F.col("id").cast("string"), F.lit("]"))
    return F.concat_ws(" ", F.concat(author, F.lit("*"), _blank("title"), F.lit("*.")), F.concat(tail, F.lit(".")), F.when(imprint != "", F.concat(imprint, F.lit("."))), F.nullif(F.array_join(zipped, " "), F.lit("")), listed)


def markdown_lines(books: DataFrame) -> DataFrame:
    """(letter, key, id, value) of the list by author: entries under their letter, and a heading before each letter. Headings
    come from a distinct over letters, so no ordering of all rows is needed to find where letters begin."""
    letter = X.bucket_letter(F.col("author"), F.col("title"))
    sort = F.concat_ws(" ", X.search_fold(_blank("author")), F.lpad(F.coalesce(F.col("year_num"), F.lit(9999)).cast("string"), 4, "0"), X.search_fold(_blank("title")))
    rows = books.select(letter.alias("letter"), sort.alias("key"), "id", markdown_entry().alias("value"))
    heads = rows.select("letter").distinct().select("letter", F.lit("").alias("key"), F.lit(-1).cast("long").alias("id"), F.concat(F.lit("\n## "), "letter", F.lit("\n")).alias("value"))
    return heads.unionByName(rows)


def write_markdown(books: DataFrame, path: str) -> None:
    order = ("letter", "key", "id")
    markdown_lines(books).repartitionByRange(*order).sortWithinPartitions(*order).select("value").write.mode("overwrite").text(path)


def write_report(df: DataFrame, path: str) -> None:
    """A tab-separated report."""
    df.write.mode("overwrite").option("sep", "\t").option("header", "true").csv(path)


def append_log(df: DataFrame, path: str) -> None:
    """Append rows to a log of JSON lines."""
    df.write.mode("append").json(path)


def write_counted(df: DataFrame, path: str, flags: Sequence[tuple[str, Column]] = (), mode: str = "overwrite") -> dict[str, int]:
    """Write a table and give its counters (rows, and how many have each flag), which the writing job itself observes: the rows are
    not made a second time to be counted. flags must not be named rows."""
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("rows"), *(F.count_if(c).alias(n) for n, c in flags)]
    df.observe(seen, *counts).write.mode(mode).parquet(path)
    return {"rows": 0, **{n: 0 for n, _ in flags}} | {k: v for k, v in seen.get.items() if v is not None}
