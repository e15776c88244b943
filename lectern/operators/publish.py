"""From linked rows to the published table: labelled parts, annotations, titles, ids, deletes, summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.functions import text as X
from lectern.functions.udfs import to_title_case
from lectern.operators import dedupe

#: Languages that the published copy leaves out.
HIDDEN_LANGUAGES = ("Vietnamese", "Latin")
FIRST_YEAR, LAST_YEAR = 1850, 1955

BOOKS = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("author", T.StringType()), T.StructField("title", T.StringType()), T.StructField("year", T.StringType()), T.StructField("year_num", T.IntegerType()), T.StructField("edition", T.StringType()), T.StructField("volume", T.StringType()), T.StructField("links", T.ArrayType(T.StringType())), T.StructField("other", T.StringType()), T.StructField("source", T.StringType()), T.StructField("type", T.StringType()), T.StructField("access", T.StringType()), T.StructField("links_access", T.ArrayType(T.StringType())), T.StructField("links_checked", T.ArrayType(T.BooleanType())), T.StructField("language", T.StringType())]
)


def labelled(parts: Sequence[tuple[str, Column]]) -> Column:
    """'Label: value | Label: value' of the parts that have a value; a label of '' gives the value alone."""
    made = [F.when(F.coalesce(v.cast("string"), F.lit("")) != "", F.concat(F.lit(f"{label}: " if label else ""), v.cast("string"))) for label, v in parts]
    return F.concat_ws(" | ", *made)


def imprint(place: Column, publisher: Column) -> Column:
    return F.concat_ws(", ", F.nullif(place, F.lit("")), F.nullif(publisher, F.lit("")))


def catalogue_parts(r: Mapping[str, Column]) -> Column:
    """What is kept of a catalogue record beside its main fields."""
    where = F.format_string("Catalogue p. %s (PDF p. %s, col. %s)", F.coalesce(r["printed_page"].cast("string"), F.lit("?")), r["pdf_page"].cast("string"), r["col"])
    parts = [("Imprint", imprint(r["place"], r["publisher"])), ("Extent", r["extent"]), ("Series", r["series"]), ("Holdings", F.array_join(r["holdings"], " ")), ("", F.when(r["rare"], "Rare (starred in catalogue)")), ("", where), ("Note", r["note"])]
    return labelled(parts)


def bibliography_parts(r: Mapping[str, Column], where: Column, also: Column | None = None) -> Column:
    """What is kept of a bibliography's record; also: array of cross-references to later duplicates."""
    kind = F.when(r["type"] != "book", r["type"])
    container = F.when(r["type"].isin("article", "chapter"), F.concat(F.lit("In: "), r["container"])).otherwise(F.concat(F.lit("Series / issuing body: "), r["container"]))
    parts = [("Type", kind), ("", F.when(F.coalesce(r["container"], F.lit("")) != "", container)), ("Imprint", imprint(r["place"], r["publisher"])), ("Extent", r["extent"]), ("Section", r["section"]), ("", where), ("Annotation", r["annotation"]), ("Note", r["note"])]
    return labelled([*parts, *([("", F.array_join(also, " | "))] if also is not None else [])])


#: Fixed value: how a transcriber notes a letter after an entry's number.
NUMBER_SUFFIX = r'(?i)printed (?:as|entry number is)(?: entry)? "?\d+([a-c])'


def numbered_place(source: str, number: Column, page: Column, note: Column | None = None) -> Column:
    """'Source no. 12a, p. 3': a bibliography that numbers its entries; the suffix is in the note."""
    suffix = F.regexp_extract(F.coalesce(note, F.lit("")), NUMBER_SUFFIX, 1) if note is not None else F.lit("")
    return F.concat(F.lit(f"{source} no. "), number.cast("string"), suffix, F.lit(", p. "), page.cast("string"))


def paged_place(source: str, page: Column, part: Column | None = None) -> Column:
    """'Source, part p. 3'; '?' for an unknown page."""
    middle = F.when(F.coalesce(part, F.lit("")) != "", F.concat(F.lit(", "), part)).otherwise("") if part is not None else F.lit("")
    return F.concat(F.lit(source), middle, F.lit(" p. "), F.coalesce(page.cast("string"), F.lit("?")))


def identified_place(source: str, identifier: Column, shelf: Column | None = None) -> Column:
    """'Source id (call number)'."""
    tail = F.when(F.coalesce(shelf, F.lit("")) != "", F.concat(F.lit(" ("), shelf, F.lit(")"))).otherwise("") if shelf is not None else F.lit("")
    return F.concat(F.lit(f"{source} "), identifier.cast("string"), tail)


def cross_reference(place: Column, year: Column, annotation: Column | None = None) -> Column:
    """'Also in place (as year): annotation', for a duplicate found in a later source."""
    tail = F.when(F.coalesce(annotation, F.lit("")) != "", F.concat(F.lit(": "), annotation)).otherwise("") if annotation is not None else F.lit("")
    return F.concat(F.lit("Also in "), place, F.lit(" (as "), year, F.lit(")"), tail)


#: A volume's parts by the first PDF page, with what to take off for the printed page.
PRINTED_PARTS = ((537, 536, "Swedish list"), (509, 508, "Pagès supplement"), (0, 20, ""))


def printed_page(pdf_page: Column) -> Column:
    """struct(page, part) of a PDF page."""
    out = None
    for first, less, part in reversed(PRINTED_PARTS):
        one = F.struct((pdf_page - less).alias("page"), F.lit(part).alias("part"))
        out = one if out is None else F.when(pdf_page >= first, one).otherwise(out)
    return out


def edition_and_volume(edition: Column, volume: Column) -> Column:
    """'2nd ed., vol. 3': bare numbers are told what they are."""
    said = lambda c, word: F.when(F.btrim(F.coalesce(c, F.lit(""))) == "", None).when(X.is_named(c), F.btrim(c)).otherwise(F.concat(F.lit(f"{word} "), F.btrim(c)))
    return F.concat_ws(", ", said(edition, "ed."), said(volume, "vol."))


def parsed(other: Column, longest: int = 22) -> Column:
    """array<struct(label, value)> of labelled parts; a part whose label would have longest characters or more, or none, is Info."""
    at = lambda p: F.instr(p, ": ")
    has = lambda p: (at(p) > 1) & (at(p) - 1 < longest)
    return F.transform(F.split(F.coalesce(other, F.lit("")), r" \| "), lambda p: F.struct(F.when(has(p), F.substring_index(p, ": ", 1)).otherwise("Info").alias("label"), F.when(has(p), F.substring(p, at(p) + 2, F.length(p))).otherwise(p).alias("value")))


def strip_annotations(other: Column) -> Column:
    """Without the compilers' annotations and the comments after cross-references."""
    out = F.regexp_replace(F.coalesce(other, F.lit("")), r"\s*\|\s*Annotation: [^|]*", "")
    out = F.regexp_replace(out, r"(Also in [^|:]*\([^)]*\)[^|:]*): [^|]*", "$1")
    return F.btrim(F.regexp_replace(out, r"\s*\|\s*\|", " |"), F.lit(" |"))


def year_number(start: Column, years: Column, first: int = FIRST_YEAR, last: int = LAST_YEAR) -> Column:
    """The year given, else the earliest inside the range, else the earliest."""
    inside = F.filter(years, lambda y: y.between(first, last))
    return F.coalesce(start, F.array_min(inside), F.array_min(years)).cast("int")


def fullness(*fields: Column) -> Column:
    """How many fields say something."""
    said = lambda c: F.coalesce(F.nullif(c.cast("string"), F.lit("")).isNotNull(), F.lit(False)).cast("int")
    return sum((said(c) for c in fields[1:]), said(fields[0]))


def fuller_description(rows: DataFrame, source: str) -> DataFrame:
    """rows with another source's record z beside them: whose description says more is the row's, the other becomes a note.

    rows: author, title, year, year_num, edition, volume, other; z: a struct of author, title, year, year_num, edition, volume,
    place, publisher, pages, series, abstract, all but year_num texts; null z: the row stays. A row that already names source as
    the origin of its description or of a note keeps its own. The record's fields win, but an empty author or edition and a null
    year_num do not. Gives rows without z, with fuller: whether the record won.
    """
    z = lambda name: F.coalesce(F.col(f"z.{name}"), F.lit(""))
    other = F.coalesce("other", F.lit(""))
    printed = F.regexp_extract(other, r"Imprint: ([^|]+)", 1)
    said = lambda *labels: F.when(F.greatest(*(other.contains(f"{x}: ") for x in (*labels, labels[0]))), 1)
    own = fullness(F.col("author"), F.col("title"), F.col("year_num"), F.col("edition"), F.col("volume"), printed, F.when(printed.contains(","), 1), said("Extent"), said("Series"), said("Annotation", "Note"))
    theirs = fullness(*map(z, ("author", "title")), F.col("z.year_num"), *map(z, ("edition", "volume", "publisher", "place", "pages", "series", "abstract")))
    named = other.contains(f"Also in {source}") | other.contains(f"Description from {source}")
    joined = lambda sep, *parts: F.concat_ws(sep, *(F.nullif(F.coalesce(p, F.lit("")), F.lit("")) for p in parts))
    before = joined(". ", F.col("author"), F.col("title"), F.col("edition"), F.col("year"))
    described = labelled([("Imprint", imprint(z("place"), z("publisher"))), ("Extent", F.when(z("pages") != "", F.concat(z("pages"), F.lit(" p.")))), ("Series", z("series")), ("Note", z("abstract"))])
    swapped = joined(" | ", described, F.concat(F.lit(f"Description from {source}; entered elsewhere as: "), before), other)
    line = joined(". ", z("author"), z("title"), joined(", ", z("place"), z("publisher"), z("year")))
    extent = F.when(z("pages").rlike("^[0-9]+$"), F.concat(F.lit(" ("), z("pages"), F.lit(" p.)"))).otherwise("")
    noted = joined(" | ", other, F.concat(F.lit(f"Also in {source}: "), line, extent))
    wins = F.col("z").isNotNull() & (theirs > own) & ~named
    value = {
        "author": F.coalesce(F.nullif(z("author"), F.lit("")), "author"),
        "title": z("title"),
        "year": z("year"),
        "year_num": F.coalesce("z.year_num", "year_num"),
        "edition": F.coalesce(F.nullif(z("edition"), F.lit("")), "edition"),
    }
    chosen = {c: F.when(F.col("_wins"), v).otherwise(F.col(c)) for c, v in value.items()}
    made = F.when(F.col("_wins"), swapped).when(F.col("z").isNotNull(), noted).otherwise(F.col("other"))
    kept = [c for c in rows.columns if c != "z"]
    return rows.withColumn("_wins", wins).select(*(made.alias(c) if c == "other" else chosen.get(c, F.col(c)).alias(c) for c in kept), F.col("_wins").alias("fuller"))


def overridden(df: DataFrame, fixes: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """df with the fields of fixes where it has a row for the key, null overrides too where fixes has a has_<field> column."""
    renamed = fixes.select(key, *(F.col(f).alias(f"_f_{f}") for f in fields), *(F.col(f"has_{f}").alias(f"_h_{f}") for f in fields if f"has_{f}" in fixes.columns))
    joined = df.join(renamed, key, "left")
    value = {f: F.when(F.coalesce(f"_h_{f}", F.lit(False)), F.col(f"_f_{f}")).otherwise(F.col(f)) if f"_h_{f}" in renamed.columns else F.coalesce(f"_f_{f}", f) for f in fields}
    return joined.withColumns(value).select(*df.columns)


def add_source(sources: Column, name: str) -> Column:
    """The '; '-joined sources with one more, unless the text already has that name in it."""
    return F.when(sources.contains(name), sources).otherwise(F.concat_ws("; ", F.nullif(sources, F.lit("")), F.lit(name)))


def display_title(title: Column, language: Column) -> Column:
    """As displayed: English titles in title case, without the full stop at the end."""
    return F.when(language == "English", to_title_case(X.trim_stop(title))).otherwise(X.trim_stop(title))


def published(rows: DataFrame, excluded: DataFrame | None = None, hidden: Sequence[str] = HIDDEN_LANGUAGES, last_year: int = LAST_YEAR) -> DataFrame:
    """The rows that are published: ids were given before, so they do not shift. excluded: (rowkey). Undated rows stay."""
    kept = rows.filter(~F.coalesce("language", F.lit("")).isin(list(hidden)) & (F.col("year_num").isNull() | F.col("year_num").between(FIRST_YEAR, last_year)))
    return kept if excluded is None else kept.join(excluded.select("rowkey").distinct(), "rowkey", "left_anti")


def with_ids(rows: DataFrame, *order: str) -> DataFrame:
    """Consecutive ids in the order of sources and records."""
    return dedupe.numbered(rows, *order)


def summary(books: DataFrame, by: str, most: int | None = None) -> DataFrame:
    """Entries by a column, the most frequent first."""
    out = books.groupBy(by).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc(by))
    return out if most is None else out.limit(most)


def totals(books: DataFrame) -> DataFrame:
    """One row: all entries, undated ones, those with a copy, open and to borrow."""
    linked = F.coalesce(F.size("links"), F.lit(0)) > 0
    return books.agg(F.count(F.lit(1)).alias("entries"), F.count_if(F.col("year_num").isNull()).alias("undated"), F.count_if(linked).alias("linked"), F.count_if(linked & (F.col("access") == "open")).alias("open"), F.count_if(linked & (F.col("access") == "borrow")).alias("borrow"))
