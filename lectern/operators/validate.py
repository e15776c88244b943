"""Checking transcribed pages: keys, types, ranges, headers and numbering. Every check is a column; what fails becomes a row.

Records are read with their raw JSON beside the typed fields, so missing and extra keys and wrong types can be told.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.operators import dedupe
from lectern.operators.publish import NUMBER_SUFFIX, printed_page


@dataclass(frozen=True)
class Shape:
    """What a source's records must have."""

    keys: tuple[str, ...]
    first_page: int
    last_page: int
    years: tuple[int, int]
    year_field: str = "year_start"
    number_field: str | None = None
    choices: dict[str, tuple[str, ...]] = field(default_factory=dict)
    arrays: tuple[str, ...] = ()
    header: bool = False  # the first line of a page is its summary
    skip_field: str | None = None  # records that are stubs
    page_offset: int | None = None  # printed page less PDF page
    parts: bool = False  # the printed page is that of publish.printed_page
    counted: bool = False  # the summary tells books and skipped entries too
    year_in_text: bool = False  # the year as printed contains the number
    numbering: str = ""  # per_page: 1..n on each page; ascending; printed: ascending, unique, running on over pages; consecutive over all


_ENTRY = ("author", "title", "edition", "place", "publisher", "year", "year_start", "extent")
#: The shapes by source.
SHAPES = {
    "union_catalog": Shape(("pdf_page", "printed_page", "col", "rare", *_ENTRY, "series", "holdings", "note"), 11, 553, (1700, 1955), choices={"col": ("L", "R")}, arrays=("holdings",)),
    "borton": Shape(("pdf_page", "entry_no", "type", "container", *_ENTRY, "section", "annotation", "note"), 1, 222, (1700, 1960), number_field="entry_no", choices={"type": ("book", "article", "chapter", "periodical")}, skip_field="skipped", numbering="consecutive"),
    "dower": Shape(("pdf_page", "printed_page", "entry_no", "type", "author", "title", "container", "edition", "publisher", "year", "year_start", "section", "annotation", "note"), 1, 162, (1850, 1960), number_field="entry_no", header=True, page_offset=251),
    "asj": Shape(("pdf_page", "entry_no", "author", "title", "place", "year", "year_num", "volumes", "kind", "japan", "japan_why", "note"), 5, 34, (1400, 1900), "year_num", "entry_no", {"kind": ("book", "periodical", "manuscript", "map"), "japan": ("true", "false", "uncertain")}, header=True, year_in_text=True, numbering="per_page"),
    "nachod": Shape(("pdf_page", "entry_no", "author", "title", "place", "publisher", "year", "year_num", "extent", "edition", "series", "language", "section", "note"), 1, 243, (1850, 1930), "year_num", "entry_no", {"skip": ("article", "russian", "out of range")}, header=True, skip_field="skip", numbering="printed"),
    "wenckstern": Shape(("pdf_page", "seq", "author", "title", "place", "publisher", "year", "year_num", "extent", "edition", "series", "language", "section", "note"), 21, 558, (1850, 1910), "year_num", "seq", {"skip": ("article", "russian", "out of range")}, header=True, skip_field="skip", parts=True, counted=True, numbering="per_page"),
}


def _json_field(name: str) -> Column:
    return F.get_json_object("raw", f"$.{name}")


def record_errors(lines: DataFrame, shape: Shape) -> DataFrame:
    """(file, page, line, error) of every fault in a source's records. lines: (file, page, line, raw), of sources.pages."""
    keys = F.json_object_keys("raw")
    wanted = F.array(*map(F.lit, shape.keys))
    stub = _json_field(shape.skip_field).isNotNull() if shape.skip_field else F.lit(False)
    empty = F.coalesce(_json_field("empty"), F.lit("")) == "true"
    header = F.array_contains(keys, "entries_on_page")
    missing, extra = F.array_except(wanted, keys), F.array_except(keys, wanted)
    full = ~stub
    faults: list[tuple[Column, Column]] = [(full & (F.size(missing) > 0), F.concat(F.lit("missing "), F.array_join(missing, ","))), (full & (F.size(extra) > 0), F.concat(F.lit("extra "), F.array_join(extra, ",")))]
    faults.append((F.coalesce(_json_field("pdf_page").try_cast("int") != F.col("page"), F.lit(True)), F.lit("pdf_page is not the page")))
    if shape.page_offset is not None:
        faults.append((F.coalesce(_json_field("printed_page").try_cast("int") != F.col("page") + shape.page_offset, F.lit(True)), F.lit("printed_page does not fit")))
    for name, values in shape.choices.items():
        there = F.array_contains(keys, name)
        faults.append((there & ~F.coalesce(_json_field(name).isin(list(values)), F.lit(False)), F.concat(F.lit(f"{name} "), F.coalesce(_json_field(name), F.lit("null")))))
    for name in shape.arrays:
        faults.append((F.array_contains(keys, name) & ~F.coalesce(_json_field(name).startswith("["), F.lit(False)), F.lit(f"{name} is not a list")))
    year = _json_field(shape.year_field)
    number = F.when(year.rlike("^-?[0-9]+$"), year.try_cast("int"))
    faults.append((year.isNotNull() & ~F.coalesce(number.between(*shape.years), F.lit(False)), F.concat(F.lit(f"{shape.year_field} "), year)))
    if shape.year_in_text:
        printed = F.coalesce(_json_field("year"), F.lit(""))
        faults.append((number.isNotNull() & (printed != "") & ~printed.contains(number.cast("string")), F.lit("year does not contain its number")))
    faults.append((full & (F.btrim(F.coalesce(_json_field("title"), F.lit(""))) == "") & ~F.lower(F.coalesce(_json_field("note"), F.lit(""))).contains("cross-reference"), F.lit("empty title")))
    if shape.number_field:
        faults.append((_json_field(shape.number_field).isNull(), F.lit(f"no {shape.number_field}")))
    bad = keys.isNull()
    errors = F.when(bad, F.array(F.lit("bad JSON"))).when(empty | header, F.array().cast("array<string>")).otherwise(F.array_compact(F.array(*(F.when(c, m) for c, m in faults))))
    return lines.filter(F.btrim("raw") != "").select("file", "page", "line", F.explode(errors).alias("error"))


def entries(lines: DataFrame, shape: Shape, stubs: bool = True) -> DataFrame:
    """(page, line, label, number, suffixed) of the records proper: no summaries, empty marks or bad lines. suffixed: whether the
    note tells that the number is printed with a letter."""
    keys = F.json_object_keys("raw")
    kept = lines.filter(keys.isNotNull() & ~F.array_contains(keys, "entries_on_page") & (F.coalesce(_json_field("empty"), F.lit("")) != "true"))
    kept = kept if stubs or not shape.skip_field else kept.filter(_json_field(shape.skip_field).isNull())
    label = _json_field(shape.number_field) if shape.number_field else F.lit(None).cast("string")
    suffixed = F.regexp_extract(F.coalesce(_json_field("note"), F.lit("")), NUMBER_SUFFIX, 1) != ""
    return kept.select("page", "line", label.alias("label"), F.regexp_extract(F.coalesce(label, F.lit("")), r"^(\d+)", 1).try_cast("int").alias("number"), suffixed.alias("suffixed"))


def header_errors(lines: DataFrame, shape: Shape) -> DataFrame:
    """(page, error): pages without a summary in their first line, or whose summary counts other entries than there are."""
    keys = F.json_object_keys("raw")
    heads = lines.filter(keys.isNotNull() & F.array_contains(keys, "entries_on_page")).groupBy("page").agg(F.min("line").alias("at"), F.first(_json_field("entries_on_page").try_cast("int")).alias("said"))
    counts = lines.filter(F.btrim("raw") != "").groupBy("page").agg(F.min("line").alias("first"), F.count_if(keys.isNotNull() & ~F.array_contains(keys, "entries_on_page")).alias("n"))
    error = F.when(F.coalesce(F.col("at") != F.col("first"), F.lit(True)), "first line is not a page summary").when(F.col("said") != F.col("n"), F.format_string("summary says %d entries, file has %d", "said", "n"))
    return counts.join(heads, "page", "left").select("page", error.alias("error")).filter("error IS NOT NULL")


def summary_errors(lines: DataFrame, shape: Shape) -> DataFrame:
    """(page, error) of summaries whose printed page is not the PDF page's, or which count other books and stubs than there are."""
    keys = F.json_object_keys("raw")
    head, stub = F.array_contains(keys, "entries_on_page"), _json_field(shape.skip_field or "skip").isNotNull()
    said = {n: F.max(F.when(head, _json_field(n).try_cast("int"))).alias(f"_{n}") for n in ("printed_page", "books", "skipped")}
    counts = [F.count_if(~head & ~stub).alias("_b"), F.count_if(~head & stub).alias("_s"), F.max(head).alias("_head")]
    found = lines.filter(keys.isNotNull()).groupBy("page").agg(*said.values(), *counts).filter("_head")
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("none"))
    faults = []
    if shape.parts:
        due = printed_page(F.col("page"))["page"]
        faults.append(F.when(~F.col("_printed_page").eqNullSafe(due), F.format_string("printed_page %s, not %d", shown("_printed_page"), due)))
    if shape.counted:
        same = F.col("_books").eqNullSafe(F.col("_b")) & F.col("_skipped").eqNullSafe(F.col("_s"))
        faults.append(F.when(~same, F.format_string("summary says %s books and %s skipped, file has %d and %d", shown("_books"), shown("_skipped"), "_b", "_s")))
    errors = F.array_compact(F.array(*faults)) if faults else F.array().cast("array<string>")
    return found.select("page", F.explode(errors).alias("error"))


def neighbour_errors(own: DataFrame, page: str = "page", line: str = "line", number: str = "number", suffixed: str | None = None) -> DataFrame:
    """(page, number, next, error): neighbours in printed order on a page whose numbers do not follow one another. A repeated number
    is right where some entry of that number has a printed suffix (boolean column suffixed), as 159 and 159a are both 159."""
    before = F.lag(number).over(Window.partitionBy(page).orderBy(line))
    rows = own.filter(F.col(number).isNotNull()).withColumn("_before", before)
    odd = rows.filter(F.col(number) != F.col("_before") + 1)
    if suffixed is not None:
        told = own.filter(F.col(suffixed)).select(F.col(number).alias("_n")).distinct()
        odd = odd.join(told, (odd[number] == F.col("_n")) & (odd[number] == odd["_before"]), "left_anti")
    error = F.when(F.col(number) == F.col("_before"), "repeated").when(F.col(number) < F.col("_before"), "goes back").otherwise("jumps")
    return odd.select(page, F.col("_before").alias("number"), F.col(number).alias("next"), error.alias("error"))


def border_errors(own: DataFrame, page: str = "page", line: str = "line", number: str = "number", lettered: str | None = None) -> DataFrame:
    """(page, last, next_first): pages whose successor is there and starts with another number than the one due. A jump is right
    where an entry of either page has a lettered number (boolean column lettered) that falls inside it: 3606a to 3606k, no 3606.
    Pages are joined to the next, so no task sees more than one page and its neighbour."""
    plain = F.col(number).isNotNull() & (~F.col(lettered) if lettered else F.lit(True))
    letters = F.collect_set(F.when(F.col(lettered), F.col(number))) if lettered else F.array().cast("array<int>")
    ends = own.groupBy(page).agg(F.min_by(number, F.when(plain, F.col(line))).alias("_first"), F.max_by(number, F.when(plain, F.col(line))).alias("_last"), letters.alias("_letters"))
    after = ends.select((F.col(page) - 1).alias(page), F.col("_first").alias("next_first"), F.col("_letters").alias("_more"))
    met = ends.join(after, page).filter(F.col("next_first") != F.col("_last") + 1)
    filled = F.exists(F.concat("_letters", "_more"), lambda x: (x > F.col("_last")) & (x <= F.col("next_first")))
    return met.filter(~filled).select(page, F.col("_last").alias("last"), "next_first")


def order_errors(own: DataFrame, page: str = "page", line: str = "line", number: str = "number") -> DataFrame:
    """(page, in_order, distinct_numbers) of pages whose numbers go back somewhere or are repeated."""
    before = F.lag(number).over(Window.partitionBy(page).orderBy(line))
    rows = own.filter(F.col(number).isNotNull()).withColumn("_before", before)
    back = F.coalesce(F.max(F.col(number) < F.col("_before")), F.lit(False))
    found = rows.groupBy(page).agg((~back).alias("in_order"), (F.countDistinct(number) == F.count(F.lit(1))).alias("distinct_numbers"))
    return found.filter("NOT in_order OR NOT distinct_numbers")


def numbering_errors(lines: DataFrame, shape: Shape) -> DataFrame:
    """(page, error) for numbers that are not as the source numbers its entries."""
    own = entries(lines, shape)
    if shape.numbering == "per_page":
        found = dedupe.one_to_n(own, "page", "number").filter("NOT complete")
        return found.select("page", F.format_string("numbers are not 1..%d", "n").alias("error"))
    if shape.numbering == "ascending":
        before = F.lag("number").over(Window.partitionBy("page").orderBy("line"))
        return own.withColumn("_p", before).filter("number < _p").select("page", F.format_string("%d after %d", "number", "_p").alias("error"))
    if shape.numbering == "printed":
        marked = own.withColumn("_lettered", F.coalesce(F.col("label").rlike("[a-z]$"), F.lit(False)))
        plain = marked.filter("NOT _lettered")
        faults = F.array_compact(F.array(F.when(~F.col("in_order"), "entry numbers are not in printed order"), F.when(~F.col("distinct_numbers"), "repeated entry numbers")))
        inside = order_errors(plain).select("page", F.explode(faults).alias("error"))
        borders = border_errors(marked, lettered="_lettered")
        return inside.unionByName(borders.select("page", F.format_string("ends at %d, next page starts at %d", "last", "next_first").alias("error")))
    if shape.numbering == "consecutive":
        runs = dedupe.continuity(own.filter("number IS NOT NULL"), "page", "number").filter("NOT follows")
        inside = neighbour_errors(own, suffixed="suffixed")
        told = F.when(F.col("error") == "jumps", F.format_string("gap between %d and %d", "number", "next")).otherwise(F.format_string("%d after %d", "next", "number"))
        ended = runs.select("page", F.format_string("ends at %d, next page starts at %d", "last", "next_first").alias("error"))
        return ended.unionByName(inside.select("page", told.alias("error")))
    return own.sparkSession.createDataFrame([], "page int, error string")


def missing_pages(lines: DataFrame, shape: Shape) -> DataFrame:
    """Pages that no file has."""
    return dedupe.missing_numbers(lines, "page", shape.first_page, shape.last_page)


def check(lines: DataFrame, shape: Shape) -> DataFrame:
    """(page, line, error) of everything that is wrong."""
    none = F.lit(None).cast("int")
    parts = [record_errors(lines, shape).select("page", "line", "error"), numbering_errors(lines, shape).select("page", none.alias("line"), "error")]
    if shape.header:
        parts.append(header_errors(lines, shape).select("page", none.alias("line"), "error"))
    if shape.parts or shape.counted:
        parts.append(summary_errors(lines, shape).select("page", none.alias("line"), "error"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.unionByName(missing_pages(lines, shape).select(F.col("page").cast("int").alias("page"), none.alias("line"), F.lit("missing page").alias("error")))


def totals(lines: DataFrame, shape: Shape, flags: Sequence[tuple[str, Column]] = ()) -> DataFrame:
    """One row: pages, entries and how many have each flag."""
    return entries(lines, shape).agg(F.countDistinct("page").alias("pages"), F.count(F.lit(1)).alias("entries"), *(F.count_if(c).alias(n) for n, c in flags))
