"""Readers of the catalogue's inputs. All go through Spark's own readers, so any path that Spark knows will do."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.functions import text as X
from lectern.operators import dedupe


def pages(spark: SparkSession, path: str) -> DataFrame:
    """(file, page, line, raw) of page files, one record a line. The order is that of file names, then lines; the page is the
    number in the file's name."""
    files = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_name").alias("file"))
    lines = files.select("file", F.posexplode(F.split("value", "\r?\n")).alias("line", "raw")).filter("raw <> ''")
    return lines.select("file", F.regexp_extract("file", r"(\d+)", 1).try_cast("int").alias("page"), (F.col("line") + 1).alias("line"), "raw")


def records(lines: DataFrame, schema: T.StructType | str, stubs: Sequence[str] = ("empty", "skipped")) -> DataFrame:
    """Typed records of pages(), with file, page and line: no summaries, stubs, bad lines."""
    keys = F.json_object_keys("raw")
    kept = lines.filter(keys.isNotNull() & ~F.array_contains(keys, "entries_on_page") & ~F.arrays_overlap(keys, F.array(*map(F.lit, stubs))))
    parsed = F.from_json("raw", schema)
    fields = schema.fieldNames() if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema).fieldNames()
    return kept.withColumn("_r", parsed).select("file", F.col("page").alias("page_of_file"), "line", *(F.col(f"_r.{f}").alias(f) for f in fields))


def keyed_log(spark: SparkSession, path: str, schema: T.StructType | str, key: str) -> DataFrame:
    """An append-only log of JSON lines as a table: bad lines are passed by, and of each key the last line counts."""
    rows = pages(spark, path).filter(F.json_object_keys("raw").isNotNull())
    typed = rows.withColumn("_r", F.from_json("raw", schema)).select(F.struct("file", "line").alias("_at"), "_r.*").filter(F.col(key).isNotNull())
    return dedupe.collapse_log(typed, key, "_at").drop("_at")


def decisions(spark: SparkSession, path: str, columns: Sequence[str], least: int | None = None, lower: Sequence[str] = ()) -> DataFrame:
    """Tab-separated hand decisions: lines with # and blank ones are comments, rows may be ragged; fields are trimmed."""
    parts = F.split("value", "\t")
    rows = spark.read.text(path).filter(~F.col("value").startswith("#") & (F.size(parts) >= (least or len(columns))) & (F.btrim(parts[0]) != ""))
    made = {c: F.btrim(F.get(parts, F.lit(i))) for i, c in enumerate(columns)}
    return rows.select(*((F.lower(v) if c in lower else v).alias(c) for c, v in made.items()))


def id_list(spark: SparkSession, path: str, pattern: str = r"^\s*([^\s#]+)") -> DataFrame:
    """(id, pos): identifiers found in the lines of a list, the first mention of each, in order."""
    lines = pages(spark, path).withColumn("id", F.regexp_extract("raw", pattern, 1)).filter("id <> ''")
    return lines.groupBy("id").agg(F.min(F.struct("file", "line")).alias("pos"))


def xml_texts(c: Column, tag: str) -> Column:
    """Texts of all elements of a name, whatever their prefix, entities decoded."""
    every = F.regexp_extract_all(c, F.lit(rf"(?s)<(?:\w+:)?{tag}(?:\s[^>]*)?>(.*?)</(?:\w+:)?{tag}>"), F.lit(1))
    return F.filter(F.transform(every, X.strip_tags), lambda x: x != "")


def xml_records(df: DataFrame, xml: str, record: str, fields: dict[str, str], many: Sequence[str] = ()) -> DataFrame:
    """A row for each record element, with the text of each field's element (an array for those in many)."""
    each = df.withColumn("_x", F.explode(F.regexp_extract_all(xml, F.lit(rf"(?s)(<(?:\w+:)?{record}[\s>].*?</(?:\w+:)?{record}>)"), F.lit(1))))
    picked = {name: xml_texts(F.col("_x"), tag) for name, tag in fields.items()}
    return each.select(*(c for c in df.columns if c != xml), *((v if n in many else F.get(v, F.lit(0))).alias(n) for n, v in picked.items()))


_RDF = "urls array<string>, title string, date string, publisher string, authors array<string>, subjects array<string>"


def rdf_items(files: DataFrame) -> DataFrame:
    """Items of RDF/XML exports (a column value with the whole file): ordered distinct addresses, title, date, publisher,
    authors, subjects. Namespaces are ignored; documents that are no XML give no rows."""

    def parse(batches):
        import xml.etree.ElementTree as E

        name = lambda e: e.tag.rsplit("}", 1)[-1]
        inside = lambda e, *path: e if not path else next((x for c in e if name(c) == path[0] for x in [inside(c, *path[1:])] if x is not None), None)
        said = lambda e, *path: (inside(e, *path).text or "").strip() if inside(e, *path) is not None else ""
        for pdf in batches:
            rows = []
            for value in pdf["value"]:
                try:
                    root = E.fromstring(value)
                except E.ParseError:
                    continue
                for item in root:
                    kinds = [name(c) for c in item]
                    if "title" not in kinds:
                        continue
                    urls = [u for v in item.iter() for u in [*([v.text or ""] if name(v) in ("value", "URI", "identifier") else []), *(a for k, a in v.attrib.items() if k.endswith("about"))] if u.strip().startswith("http")]
                    people = [", ".join(x for x in (said(p, "surname"), said(p, "givenName")) if x) for g in item if name(g) == "authors" for p in g.iter() if name(p) == "Person"]
                    subjects = [(s.text or "").strip() for s in item if name(s) == "subject" and (s.text or "").strip()]
                    rows.append((list(dict.fromkeys(map(str.strip, urls))), said(item, "title"), said(item, "date"), said(item, "publisher", "Organization", "name"), people, subjects))
            yield pd.DataFrame(rows, columns=["urls", "title", "date", "publisher", "authors", "subjects"])

    return files.select("value").mapInPandas(parse, _RDF)


def html_fields(c: Column, labels: Sequence[str]) -> Column:
    """map from label to the text of the cell after it, for record pages laid out as label and value cells."""
    pair = lambda label: F.get(F.regexp_extract_all(c, F.lit(rf"(?is)<t[dh][^>]*>\s*{label}\s*:?\s*</t[dh]>\s*<td[^>]*>(.*?)</td>"), F.lit(1)), F.lit(0))
    return F.map_filter(F.create_map(*(x for label in labels for x in (F.lit(label), X.strip_tags(pair(label))))), lambda _, v: v != "")


def anchors(c: Column) -> Column:
    """array<struct(url, label)> of a page's links, in order."""
    found = F.regexp_extract_all(c, F.lit(r'(?is)(<a\s[^>]*href="[^"]+"[^>]*>.*?</a>)'), F.lit(1))
    return F.transform(found, lambda a: F.struct(F.replace(F.regexp_extract(a, r'(?is)href="([^"]+)"', 1), F.lit("&amp;"), F.lit("&")).alias("url"), X.strip_tags(a).alias("label")))


#: Fixed value: labels and hosts of copies that cannot be read freely.
RESTRICTED = r"(?i)hathitrust|US access only|access only in the US|restricted"


def result_blocks(c: Column, start: str = r'<li><a href="[^"]*lookupid\?key=') -> Column:
    """array<struct(key, title, imprint, copies, dropped)> of a result page: copies that may be read, and the others apart."""
    chunks = F.filter(F.split(c, rf"(?={start})"), lambda x: x.contains("lookupid?key="))

    def one(x: Column) -> Column:
        links = F.filter(anchors(x), lambda a: ~a["url"].contains("lookupid?key="))
        bad = lambda a: a["label"].rlike(RESTRICTED) | F.lower(a["url"]).contains("hathitrust.org")
        after = F.regexp_extract(x, r"(?is)</cite>(.*?)(?:<ul|</li>|$)", 1)
        return F.struct(
            F.regexp_extract(x, r"lookupid\?key=([\w.-]+)", 1).alias("key"),
            X.strip_tags(F.regexp_extract(x, r"(?is)<cite>(.*?)</cite>", 1)).alias("title"),
            F.left(X.strip_tags(after), F.lit(160)).alias("imprint"),
            F.slice(F.filter(links, lambda a: ~bad(a)), 1, 8).alias("copies"),
            F.slice(F.filter(links, bad), 1, 8).alias("dropped"),
        )

    return F.filter(F.transform(chunks, one), lambda r: r["title"] != "")


def preferred(values: Column, language: str) -> Column:
    """Of array<struct(lang, value)>: the value in a language, else the first."""
    own = F.get(F.filter(values, lambda v: v["lang"] == language), F.lit(0))["value"]
    return F.coalesce(own, F.get(values, F.lit(0))["value"])


def books(spark: SparkSession, path: str) -> DataFrame:
    """The published table, as written by sinks.write_books."""
    return spark.read.parquet(path)


def same_files(spark: SparkSession, left: str, right: str) -> DataFrame:
    """(name, same): whether files of one name hold the same bytes in two folders, by SHA-256."""
    digests = lambda path, name: spark.read.format("binaryFile").load(path).select(F.substring_index("path", "/", -1).alias("name"), F.sha2("content", 256).alias(name))
    return digests(left, "a").join(digests(right, "b"), "name", "full").select("name", F.col("a").eqNullSafe(F.col("b")).alias("same"))
