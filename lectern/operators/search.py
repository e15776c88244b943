"""Searching the catalogue: a small query language, type rule, facets, relevance, ordering, paging, facet counts.

A catalogue has id, author, title, year, year_num, edition, volume, links (array, null: never searched for), other, source, type,
access, language. All conditions are column expressions, so filters reach the scan and nothing leaves the JVM.
"""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions import text as X
from lectern.functions.udfs import plain
from lectern.operators.dedupe import numbered

FIELDS = {"author": "fa", "title": "ft", "other": "fo", "source": "fs"}


@dataclass(frozen=True)
class Term:
    text: str
    field: str = ""
    negated: bool = False


@dataclass(frozen=True)
class Request:
    """A search as a saved link has it."""

    q: str = ""
    field: str = "all"
    y1: int | None = None
    y2: int | None = None
    host: str = ""
    lang: str = ""
    show: str = "ia"  # ia, all, noia, open, borrow
    undated: bool = True
    sort: str = ""  # a column, with - before it for descending
    page: int = 0
    size: int | None = 1000  # None: all

    @property
    def terms(self) -> tuple[Term, ...]:
        return tuple(parse(self.q))


def parse(q: str) -> list[Term]:
    """Terms of a query: words and "phrases", each perhaps with field: before it, and - before that for its absence."""
    found = re.finditer(r'(-?)(?:(author|title|other|source|type):)?(?:"([^"]+)"|(\S+))', q, re.I)
    terms = (Term(plain(m[3] or m[4]).lower(), (m[2] or "").lower(), bool(m[1])) for m in found)
    return [t for t in terms if t.text]


def phrase_of(q: str) -> str:
    """What was typed as one phrase: without negated terms, field names and quotes."""
    out = re.sub(r"(^|\s)-\S+", " ", plain(q).lower())
    out = re.sub(r"\b(author|title|other|source):", " ", out)
    return " ".join(re.sub(r"[\"']", " ", out).split())


#: Between the fields of fall, so that no phrase goes from one field into the next.
BORDER = " \u0001 "


def with_search_columns(books: DataFrame) -> DataFrame:
    """books with folded columns fa, ft, fs, fo, fall and the number of links; written once, read by every search.

    fo is all that a line says besides author and title: other, edition, volume, year, source and language; fall has author,
    title and fo, with a border between them."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    folded = books.withColumns({k: X.search_fold(blank(c)) for k, c in {"fa": "author", "ft": "title", "fs": "source"}.items()})
    rest = F.concat_ws(" ", *(blank(c) for c in ("other", "edition", "volume", "year", "source", "language")))
    folded = folded.withColumn("fo", X.search_fold(rest))
    return folded.withColumns({"fall": F.concat_ws(BORDER, "fa", "ft", "fo"), "nlinks": F.when(F.col("links").isNull(), 0).otherwise(F.size("links"))})


def _all(conditions) -> Column:
    return functools.reduce(lambda a, b: a & b, conditions, F.lit(True))


def _any(conditions) -> Column:
    return functools.reduce(lambda a, b: a | b, conditions, F.lit(False))


def type_condition(terms: tuple[Term, ...], all_types: bool = False) -> Column:
    """Books unless types are asked for; type: takes beginnings of types, all or any; -type: takes types out."""
    own = [t for t in terms if t.field == "type"]
    wanted = [t.text for t in own if not t.negated]
    names = [w for w in wanted if w not in ("all", "any")]
    kept = _any(F.col("type").startswith(w) for w in names) if names else F.lit(True) if all_types or len(wanted) > len(names) else F.col("type") == "book"
    return kept & ~_any(F.col("type").startswith(t.text) for t in own if t.negated)


def condition(r: Request) -> Column:
    """The rows that answer a request. Undated rows go as soon as either year is given."""
    year, nlinks = F.col("year_num"), F.col("nlinks")
    parts = []
    if r.y1 or r.y2 or not r.undated:
        parts.append(year.isNotNull())
    parts += [year >= r.y1] if r.y1 else []
    parts += [year <= r.y2] if r.y2 else []
    if r.host:
        parts.append(F.exists(F.coalesce("links", F.array().cast("array<string>")), lambda u: X.holder(u) == r.host))
    parts.append(type_condition(r.terms))
    if r.lang:
        parts.append(F.col("language") == r.lang)
    if r.show == "noia":
        parts.append(nlinks == 0)
    elif r.show != "all":
        parts.append(nlinks > 0)
    if r.show in ("open", "borrow"):
        parts.append(F.col("access") == r.show)
    for t in r.terms:
        if t.field != "type":
            has = F.col(FIELDS.get(t.field or r.field, "fall")).contains(t.text)
            parts.append(~has if t.negated else has)
    return _all(parts)


def relevance(r: Request) -> Column:
    """How well an entry answers: the phrase in the title first, then its words there, on word boundaries and close together,
    then the author, then the rest. The weights are fixed values."""
    words = [t.text for t in r.terms if not t.negated and t.field not in ("source", "other", "type")]
    phrase = phrase_of(r.q)
    t, a, o = F.col("ft"), F.col("fa"), F.col("fo")
    score = F.lit(0.0)
    if phrase:
        several = " " in phrase
        score += F.when(t == phrase, 400).when(t.startswith(phrase), 230).when(F.lit(several) & t.contains(phrase), 170).otherwise(0)
        if several:
            score += F.when(a.contains(phrase), 90).when(o.contains(phrase), 30).otherwise(0)
    in_title, elsewhere, starts, ends = F.lit(0), F.lit(0), [], []
    for w in words:
        at, by = F.instr(t, w), F.instr(a, w)
        score += F.when(at > 0, F.when(_boundary(t, w), 20).otherwise(11) + F.when(at == 1, 8).otherwise(0)).when(by > 0, F.when(_boundary(a, w), 14).otherwise(8)).when(o.contains(w), 4).otherwise(0)
        in_title += (at > 0).cast("int")
        elsewhere += ((at == 0) & ((by > 0) | o.contains(w))).cast("int")
        starts.append(F.when(at > 0, at))
        ends.append(F.when(at > 0, at + len(w)))
    if words:
        score += F.when(in_title == len(words), 70).when(in_title + elsewhere == len(words), 25).otherwise(0)
        if len(words) > 1:
            ideal = sum(map(len, words)) + len(words) - 1
            spread = F.greatest(*ends) - F.least(*starts) - ideal
            score += F.when(in_title > 1, F.greatest(F.lit(0), 45 - F.floor(spread / 3 + 0.5))).otherwise(0)
    score -= F.least(F.lit(25.0), F.length(t) / 30)
    return F.round(score + F.when(F.col("nlinks") > 0, 2).otherwise(0), 6)


def _boundary(c: Column, w: str) -> Column:
    """Whether the first occurrence of w in c stands between characters that are no a-z or 0-9."""
    at = F.instr(c, w)
    before, after = F.substring(c, at - 1, F.lit(1)), F.substring(c, at + len(w), F.lit(1))
    return ((at == 1) | ~before.rlike("[a-z0-9]")) & ~after.rlike("[a-z0-9]")


def _sort_key(name: str) -> Column:
    """A column as it is sorted: blank authors after all others, titles folded."""
    return {"author": F.when(F.col("fa") == "", "￿").otherwise(F.col("fa")), "title": F.col("ft")}.get(name, F.col(name))


def ordering(r: Request) -> list[Column]:
    """By the column asked for, nulls last either way; else by relevance where words were typed; else by id."""
    if r.sort:
        key = _sort_key(r.sort.lstrip("-"))
        return [key.desc_nulls_last(), F.desc("id")] if r.sort.startswith("-") else [key.asc_nulls_last(), F.asc("id")]
    if any(not t.negated and t.field not in ("source", "other", "type") for t in r.terms):
        return [F.desc("rel"), F.coalesce("year_num", F.lit(9999)), F.asc("id")]
    return [F.asc("id")]


def search(view: DataFrame, r: Request) -> DataFrame:
    """The whole answer, with its relevance as rel; unordered. view: of with_search_columns."""
    return view.filter(condition(r)).withColumn("rel", relevance(r))


#: Rows that a page and all before it may have to be taken as a top-k, which goes through the driver.
TOP = 20_000


def page(view: DataFrame, r: Request) -> DataFrame:
    """One page of the answer, in order, the last one where there are not so many. Early pages are a top-k, not a sort of all;
    later ones are cut out of the numbered answer, so that no more than a page goes to one place."""
    found = search(view, r)
    if r.size is None:
        return found.orderBy(*ordering(r))
    at = min(r.page, max(0, -(-found.count() // r.size) - 1)) if r.page > 0 else 0
    if (at + 1) * r.size <= TOP:
        return found.orderBy(*ordering(r)).offset(at * r.size).limit(r.size)
    placed = numbered(found, *ordering(r), name="_place")
    return placed.filter(F.col("_place").between(at * r.size + 1, (at + 1) * r.size)).orderBy("_place").drop("_place")


def page_of(view: DataFrame, r: Request, entry: int) -> DataFrame:
    """(id, position, page) of an entry within the ordered answer: a count of the rows that come before it, not a sort."""
    answer = search(view, r)
    if r.sort:
        down = r.sort.startswith("-")
        answer = answer.withColumn("_k", _sort_key(r.sort.lstrip("-")))
        mine = answer.filter(F.col("id") == entry).select(F.col("_k").alias("_mk"), F.col("id").alias("_id"))
        k, mk = F.col("_k"), F.col("_mk")
        same = k.eqNullSafe(mk) & ((F.col("id") >= F.col("_id")) if down else (F.col("id") <= F.col("_id")))
        before = (k.isNotNull() & mk.isNull()) | ((k > mk) if down else (k < mk)) | same
    else:
        ranked = len(ordering(r)) > 1
        answer = answer.withColumns({"_r": F.col("rel") if ranked else F.lit(0.0), "_y": F.coalesce("year_num", F.lit(9999)) if ranked else F.lit(0)})
        mine = answer.filter(F.col("id") == entry).select(F.col("_r").alias("_mr"), F.col("_y").alias("_my"), F.col("id").alias("_id"))
        first = F.struct((-F.col("_r")).alias("a"), F.col("_y").alias("b"), F.col("id").alias("c"))
        before = first <= F.struct((-F.col("_mr")).alias("a"), F.col("_my").alias("b"), F.col("_id").alias("c"))
    counted = answer.join(F.broadcast(mine), F.coalesce(before, F.lit(False))).groupBy(F.col("_id").alias("id")).agg(F.count(F.lit(1)).alias("position"))
    return counted.withColumn("page", F.floor((F.col("position") - 1) / (r.size or 2**31 - 1)))


def facet_counts(view: DataFrame) -> DataFrame:
    """(language, show, type, n): entries that answer each pair of Show and Type, '' for all types; one pass, grouping sets."""
    shows = F.array_compact(F.array(F.lit("all"), F.when(F.col("nlinks") > 0, "ia").otherwise("noia"), F.when((F.col("nlinks") > 0) & F.col("access").isin("open", "borrow"), F.col("access"))))
    rows = view.filter(F.coalesce("language", F.lit("")) != "").select("language", "type", F.explode(shows).alias("show"))
    counted = rows.groupingSets([["language", "show"], ["language", "show", "type"]], "language", "show", "type").agg(F.count(F.lit(1)).alias("n"), F.grouping("type").alias("all_types"))
    return counted.select("language", "show", F.when(F.col("all_types") == 1, "").otherwise(F.col("type")).alias("type"), "n")


def facet_labels(counts: DataFrame, show: str, kind: str) -> DataFrame:
    """(language, label): 'language (shown/total)', or the total alone where all is shown."""
    shown = F.coalesce(F.max(F.when((F.col("show") == show) & (F.col("type") == kind), F.col("n"))), F.lit(0))
    total = F.max(F.when((F.col("show") == "all") & (F.col("type") == ""), F.col("n")))
    number = lambda c: F.format_number(c, 0)
    label = F.concat("language", F.lit(" ("), number("total") if show == "all" and not kind else F.concat(number("shown"), F.lit("/"), number("total")), F.lit(")"))
    return counts.groupBy("language").agg(shown.alias("shown"), total.alias("total")).select("language", label.alias("label"))


def labels_of(counts: DataFrame, r: Request) -> DataFrame:
    """(language, label) as a request shows them: counts for its Show and Type; the bare language once words, years or a host
    narrow the answer, as there are no counts for that. Several types, or types taken out, count as all."""
    own = [t for t in r.terms if t.field == "type"]
    wanted = [t.text for t in own if not t.negated and t.text not in ("all", "any")]
    if re.sub(r"(^|\s)-?type:\S+", "", r.q).strip() or r.y1 or r.y2 or r.host:
        return counts.select("language", F.col("language").alias("label")).distinct()
    every = any(t.negated or t.text in ("all", "any") for t in own) or len(wanted) > 1
    return facet_labels(counts, r.show, "" if every else wanted[0] if wanted else "book")


def highlighted(c: Column, terms: list[Term]) -> Column:
    """A text with <mark> around each word whose folded form has one of the terms of two letters or more."""
    wanted = [t.text for t in terms if not t.negated and len(t.text) > 1]
    if not wanted:
        return X.html_escape(c)
    hit = lambda w: _any(X.search_fold(w).contains(t) for t in wanted)
    marked = F.transform(F.split(c, r"(?<=\s)|(?=\s)"), lambda w: F.when(hit(w), F.concat(F.lit("<mark>"), X.html_escape(w), F.lit("</mark>"))).otherwise(X.html_escape(w)))
    return F.array_join(marked, "")
