"""Records of each source as one common record: what differs between sources is told by a Rules, the projection is one."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions import text as X
from lectern.operators import dedupe, publish

#: Text that shows a Russian work, and the sections of one bibliography that are left out whole.
CYRILLIC = "[Ѐ-ӿ]"
RUSSIAN_NOTE = "(?i)in russian|russisch"
LEFT_OUT = r"^(?:XXI\. |XIII\. Medicine / e\. )"

#: The fields of a common record that are texts, in order; year_num, pdf_page and place_in come besides.
TEXTS = "author title year edition place publisher extent volumes container section annotation series language note".split()


@dataclass(frozen=True)
class Rules:
    """How a source's records become common ones."""

    source: str
    place_in: Callable[[Mapping[str, Column]], Column]
    year_field: str = "year_num"
    years: tuple[int, int] = (publish.FIRST_YEAR, publish.LAST_YEAR)
    undated: bool = False  # records without a year stay, as n.d.
    skip: str | None = None  # the field that marks a stub
    kinds_out: tuple[str, ...] = ()
    flag: str | None = None  # a field of true, false or uncertain that must be true
    no_russian: bool = False  # works in Russian go, as title and note show
    told_language: bool = False  # and as the language field shows
    sections_out: str | None = None
    pairs_out: tuple[tuple[str, str], ...] = ()  # parts of author and title of records that a person has ruled out
    made: Mapping[str, Callable[[Mapping[str, Column]], Column]] = field(default_factory=dict)


def bracketed_name(name: Column) -> Column:
    """'Adams (Francis Ottiwell)' as 'Adams, Francis Ottiwell'; any other name as printed."""
    return F.regexp_replace(F.btrim(name), r"^([^()]*[^()\s])\s*\(\s*([^)]*?)\s*\)$", "$1, $2")


def _catalogued_kind(r: Mapping[str, Column]) -> Column:
    odd = F.when(r["kind"] != "book", F.concat(F.lit("A "), r["kind"], F.lit(" in the catalogue")))
    return F.concat_ws("; ", F.nullif(r["note"], F.lit("")), odd)


def _list_place(r: Mapping[str, Column]) -> Column:
    printed = publish.printed_page(r["pdf_page"])
    return publish.paged_place("Wenckstern (1907)", printed["page"], printed["part"])


#: The sources that are lists of entries.
RULES = {
    "asj": Rules(
        "Asiatic Society of Japan catalogue",
        lambda r: F.format_string("Asiatic Society of Japan catalogue, PDF p. %s, entry %s", r["pdf_page"].cast("string"), r["entry_no"]),
        kinds_out=("periodical",),
        flag="japan",
        made={"author": lambda r: bracketed_name(r["author"]), "note": _catalogued_kind},
    ),
    "nachod": Rules(
        "Nachod (1928)",
        lambda r: publish.numbered_place("Nachod (1928)", r["entry_no"], r["pdf_page"] + 149),
        skip="skip",
        no_russian=True,
    ),
    "dower": Rules(
        "Dower (1986)",
        lambda r: F.format_string("Dower (1986), p. %s", r["pdf_page"].cast("string")),
        made={"author": lambda r: X.first_inverted(r["author"]), "title": lambda r: X.from_capitals(r["title"])},
    ),
    "wenckstern": Rules("Wenckstern (1907)", _list_place, undated=True, skip="skip", no_russian=True, told_language=True, sections_out=LEFT_OUT),
}


def decided(flag: Column, decision: Column) -> Column:
    """A flag of true, false or uncertain: an uncertain one is as decided by hand, and false without a decision; null is false."""
    told = F.lower(flag.cast("string"))
    return F.when(told == "uncertain", F.coalesce(decision, F.lit(False))).otherwise(F.coalesce(told == "true", F.lit(False)))


def with_decisions(records: DataFrame, decisions: DataFrame, key: str, flag: str, order: str, name: str = "wanted") -> DataFrame:
    """records with a boolean of that name. decisions: (key, decision, order); of several for a key the last counts."""
    last = dedupe.collapse_log(decisions.select(key, "decision", order), key, order).select(key, F.col("decision").alias("_decision"))
    return records.join(last, key, "left").withColumn(name, decided(F.col(flag), F.col("_decision"))).drop("_decision")


def is_russian(author: Column, title: Column, note: Column, language: Column) -> Column:
    """False where all are null."""
    text = F.concat_ws(" ", author, title)
    return text.rlike(CYRILLIC) | F.coalesce(note, F.lit("")).rlike(RUSSIAN_NOTE) | (F.lower(F.coalesce(language, F.lit(""))) == "russian")


def ruled_out(author: Column, title: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """Whether a record is one that a person has ruled out by a part of its author and a part of its title, both normalised."""
    a, t = X.norm(F.coalesce(author, F.lit(""))), X.norm(F.coalesce(title, F.lit("")))
    out = F.lit(False)
    for part, other in pairs:
        out = out | (a.contains(part) & t.contains(other))
    return out


def common(records: DataFrame, rules: Rules, excluded: DataFrame | None = None) -> DataFrame:
    """The wanted records of a source as common ones: TEXTS, year_num, pdf_page, type (book), source, place_in.

    Fields that the source lacks or that are null are empty; texts are trimmed. A record with a flag must have been through
    with_decisions. excluded: (rowkey) of entries that a person has ruled out; it may have repeated keys.
    """
    have = set(records.columns)
    text = lambda c: F.btrim(F.coalesce(F.col(c).cast("string"), F.lit(""))) if c in have else F.lit("")
    r = {c: text(c) for c in {*TEXTS, "kind", "entry_no", "japan"}} | {"pdf_page": F.col("pdf_page")}
    year = F.col(rules.year_field).cast("int")
    inside = year.between(*rules.years)
    kept = [F.coalesce(inside, F.lit(rules.undated))]
    if rules.skip:
        kept.append(F.coalesce(F.col(rules.skip), F.lit("")) == "")
    if rules.kinds_out:
        kept.append(~r["kind"].isin(*rules.kinds_out))
    if rules.flag:
        kept.append(F.col("wanted"))
    if rules.no_russian:
        kept.append(~is_russian(r["author"], r["title"], r["note"], r["language"] if rules.told_language else F.lit("")))
    if rules.sections_out:
        kept.append(~r["section"].rlike(rules.sections_out))
    if rules.pairs_out:
        kept.append(~ruled_out(r["author"], r["title"], rules.pairs_out))
    wanted = records
    for condition in kept:
        wanted = wanted.filter(condition)
    if excluded is not None:
        keyed = wanted.withColumn("_key", X.row_key(r["author"], r["title"], r["year"]))
        wanted = keyed.join(excluded.select(F.col("rowkey").alias("_key")), "_key", "left_anti")
    made = {c: r[c] for c in TEXTS} | {c: f(r) for c, f in rules.made.items()}
    if rules.undated:
        made["year"] = F.coalesce(F.nullif(r["year"], F.lit("")), F.lit("n.d."))
    shown = [made[c].alias(c) for c in TEXTS]
    return wanted.select(*shown, year.alias("year_num"), "pdf_page", F.lit("book").alias("type"), F.lit(rules.source).alias("source"), rules.place_in(r).alias("place_in"))


#: Abstracts that a scanning service wrote; the span of an author's life behind a heading.
BOILERPLATE = "(?i)digitized by Google|uploaded to the Internet Archive|metadata below describe the original scanning"
LIFE = r"\s*\((?:[bd]\.\s*)?\d{3,4}\??(?:-\d{0,4}\??)?\)\s*$"


def _several(names: Column, after: str = "") -> Column:
    """Each name of an array with its surname first, without those that say nothing."""
    turned = F.transform(F.coalesce(names, F.array().cast("array<string>")), X.invert_name)
    return F.transform(F.filter(turned, lambda n: F.coalesce(n, F.lit("")) != ""), lambda n: F.concat(n, F.lit(after)) if after else n)


def collected(items: DataFrame, order: str, dropped: Sequence[str] = ()) -> DataFrame:
    """Items of a reference manager's collection as common records with links: author, title, year, year_num, links, other.

    items: order, title, date, urls, authors, editors, translators, contributors, subjects (arrays), place, publisher, pages, series,
    language, abstract. An item without an address that can be followed goes; of those with one first address the first stays.
    Editors stand for authors where there are none. Null texts and arrays count as empty.
    """
    t = lambda c: F.btrim(F.coalesce(F.col(c).cast("string"), F.lit("")))
    linked = items.withColumn("_urls", X.kept_urls(F.col("urls"), list(dropped))).filter(F.size("_urls") > 0)
    first = dedupe.first_wins(linked.withColumn("_first", F.get("_urls", F.lit(0))), ["_first"], order)
    own = _several(F.col("authors"))
    author = F.array_join(F.when(F.size(own) > 0, own).otherwise(_several(F.col("editors"), ", ed.")), "; ")
    found = F.regexp_extract(t("date"), r"(?<!\d)(1[5-9]\d\d|20[0-2]\d)(?!\d)", 1)
    plain_date = t("date").rlike(r"^\d{4}(-\d\d){0,2}$")
    year = F.when(t("date") == "", "n.d.").when(plain_date & (found != ""), found).otherwise(t("date"))
    pages = F.when(t("pages").rlike("^[0-9]+$"), F.concat(t("pages"), F.lit(" p."))).otherwise(t("pages"))
    says = F.when(t("abstract").rlike(BOILERPLATE) | t("abstract").rlike(r"^[\d\s]+$"), "").otherwise(t("abstract"))
    people = lambda c: F.array_join(_several(F.col(c)), "; ")
    parts = [
        ("Imprint", publish.imprint(t("place"), t("publisher"))), ("Extent", pages), ("Series", t("series")), ("Language", t("language")), ("Translator", people("translators")),
        ("Contributor", people("contributors")), ("Subjects", F.array_join(F.slice(F.coalesce("subjects", F.array().cast("array<string>")), 1, 12), "; ")), ("Note", says),
    ]
    return first.select(order, author.alias("author"), t("title").alias("title"), year.alias("year"), F.nullif(found, F.lit("")).cast("int").alias("year_num"), F.col("_urls").alias("links"), publish.labelled(parts).alias("other"))


def library_cards(cards: DataFrame, source: str = "Biblioteca Nacional de España", language: str = "Spanish") -> DataFrame:
    """Cards of a digital library as common records: author, title, year, year_num, links, other, source.

    cards: title, author, date, place, publisher, extent, signature, id, viewer, error. Cards with an error or without a title go. A
    title ends at its statement of responsibility, an author at the first | and before the span of a life. Where cards have a column
    imprint, with place and publisher in one line, both are taken from it.
    """
    if "imprint" in cards.columns:
        cut = X.catalogue_imprint(F.col("imprint"))
        cards = cards.withColumns({"place": cut["place"], "publisher": cut["publisher"]})
    t = lambda c: F.btrim(F.coalesce(F.col(c).cast("string"), F.lit("")))
    kept = cards.filter((t("error") == "") & (t("title") != ""))
    title = F.btrim(F.split(t("title"), r"\s+/\s+", 2)[0], F.lit(" ."))
    author = F.btrim(F.regexp_replace(F.substring_index(t("author"), "|", 1), LIFE, ""))
    year = F.nullif(F.regexp_extract(t("date"), r"(1[5-9]\d\d|20\d\d)", 1), F.lit(""))
    place_in = F.concat(F.lit(f"{source}, BNE Digital "), t("id"), F.when(t("signature") != "", F.concat(F.lit(" (signatura "), t("signature"), F.lit(")"))).otherwise(""))
    parts = [("Imprint", publish.imprint(t("place"), t("publisher"))), ("Extent", t("extent")), ("Language", F.lit(language)), ("", place_in)]
    return kept.select(author.alias("author"), title.alias("title"), F.coalesce(year, F.lit("n.d.")).alias("year"), year.cast("int").alias("year_num"), F.array(F.col("viewer")).alias("links"), publish.labelled(parts).alias("other"), F.lit(source).alias("source"))


#: Languages by code; what stands around a name in a statement of responsibility; subjects that are class marks.
LANGUAGES = {
    "eng": "English", "jpn": "Japanese", "fre": "French", "fra": "French", "ger": "German", "deu": "German", "ita": "Italian", "spa": "Spanish",
    "dut": "Dutch", "nld": "Dutch", "rus": "Russian", "lat": "Latin", "por": "Portuguese", "chi": "Chinese", "zho": "Chinese", "und": "",
}
ROLE_AFTER = r"\s*[\[［]?(?:著|編|訳|譯|撰|画|校訂|校閲|編纂|述|輯|共著|編著|編訳|編著者|監修|解説)+[\]］]?$"
ROLE_BEFORE = r"(?i)^\[?(?:by|ed\.? by|edited by|compiled by|translated by)\]?\s+"
CLASS_MARK = "^[A-Z0-9-]{1,10}$"


def stated_name(c: Column) -> Column:
    """A name without the words that say what its bearer did."""
    return F.btrim(F.regexp_replace(F.regexp_replace(F.btrim(c), ROLE_AFTER, ""), ROLE_BEFORE, ""), F.lit(" .,;[]"))


def national_records(records: DataFrame, order: str, access: DataFrame | None = None, notes: DataFrame | None = None, source: str = "NDL Digital Collections") -> DataFrame:
    """A national library's records as common ones: pid, author, title, year, year_num, volume, other, access, source.

    records: order, pid, title, issued, volume, place, publisher, extent, series, language (texts), issued_all, creators, headings, subjects,
    descriptions (arrays), error. Those with an error or without a title go; of several with one pid the first stays. Headings go
    before creators as authors, three at most; the other creators are told. Dates are Gregorian, as printed beside them. A volume field is a
    designation, or a part's title that the title gets unless it has it. access: (pid, access), unknown where there is none;
    notes: (pid, note), added by hand; of several rows for a pid one counts. Null texts and arrays count as empty.
    """
    t = lambda c: F.btrim(F.coalesce(F.col(c).cast("string"), F.lit("")))
    many = lambda c: F.filter(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda x: x.isNotNull())
    several = lambda c, n, sep="; ": F.array_join(F.slice(c, 1, n), sep)
    fields = "pid title issued volume place publisher extent series language issued_all creators headings subjects descriptions error".split()
    r = dedupe.first_wins(records.select(order, *fields).filter((t("error") == "") & (t("title") != "")), ["pid"], order)
    if notes is not None:
        r = r.join(notes.groupBy("pid").agg(F.max("note").alias("_note")), "pid", "left")
    known = F.lit(None).cast("string")
    if access is not None:
        r, known = r.join(access.groupBy("pid").agg(F.max("access").alias("_access")), "pid", "left"), F.col("_access")
    headed = F.transform(F.slice(many("headings"), 1, 3), lambda h: F.btrim(F.regexp_replace(h, r",\s*\d{4}-?\d{0,4}$", "")))
    stated = F.transform(many("creators"), stated_name)
    author = F.array_join(F.when(F.size(many("headings")) > 0, headed).otherwise(_several(F.slice(stated, 1, 3))), "; ")
    year_num = X.western_year(F.array_join(many("issued_all"), " ; "), t("issued"))
    year = F.coalesce(F.nullif(X.to_western(t("issued")), F.lit("")), F.lit("n.d."))
    # a column before the title, so that the parts of the field are cut once
    r = r.withColumns({"_author": author, "_year": year, "_year_num": year_num, "_stated": stated}).withColumn("_part", X.split_volume(F.col("volume"), F.col("_year_num")))
    part = F.col("_part.part_title")
    title = F.when((part != "") & ~X.norm(t("title")).contains(X.norm(part)), F.concat(F.rtrim(t("title"), F.lit(" .")), F.lit(". "), part)).otherwise(t("title"))
    codes = F.create_map(*(F.lit(x) for pair in LANGUAGES.items() for x in pair))
    others = F.filter("_stated", lambda c: (c != "") & ~F.col("_author").contains(c))
    said = F.concat(many("descriptions"), F.array_compact(F.array("_note"))) if notes is not None else many("descriptions")
    parts = [
        ("Imprint", publish.imprint(t("place"), t("publisher"))), ("Extent", t("extent")), ("Series", t("series")), ("Language", F.coalesce(codes[t("language")], t("language"))),
        ("Subjects", several(F.filter(many("subjects"), lambda s: ~s.rlike(CLASS_MARK)), 8)), ("Statement of responsibility", several(others, 3)), ("Note", several(said, 4)),
        ("Date as printed", F.when((F.col("_year") != t("issued")) & (t("issued") != ""), t("issued")).otherwise("")), ("", F.concat(F.lit(f"{source} pid "), F.col("pid").cast("string"))),
    ]
    return r.select(
        "pid", F.col("_author").alias("author"), title.alias("title"), F.col("_year").alias("year"), F.col("_year_num").alias("year_num"), F.col("_part.designation").alias("volume"),
        publish.labelled(parts).alias("other"), F.coalesce(known, F.lit("unknown")).alias("access"), F.lit(source).alias("source"),
    )


#: Words that make a creator a body, and what may stand at a title's end for an uncertain date.
BODY = r"(?i)\b(society|association|bureau|company|line|army|navy|railway|forces|government|ministry|office|department|scholar|mail)\b"
UNCERTAIN_END = r"(?i)[\s.,]*\b(ca|circa|n\.d)\.?$"


def one_per_work(items: DataFrame, order: str, years: tuple[int, int] = (1850, 1900)) -> DataFrame:
    """A collection's printed books as common records, copies of a work folded together: author, title, year, year_num, extent, order.

    items: order, author, title, year, list_year, collation, error. Those with an error, without a title or without a year inside the span go.
    Copies share surname, title key and year; the first in order stays. Where items have a column imprint, a title page's line, place and
    publisher are taken from it.
    """
    cut = X.title_page_imprint(F.col("imprint")) if "imprint" in items.columns else None
    imprint = [cut["place"].alias("place"), cut["publisher"].alias("publisher")] if cut is not None else []
    t = lambda c: F.btrim(F.coalesce(F.col(c).cast("string"), F.lit("")))
    printed = F.coalesce(F.nullif(t("year"), F.lit("")), t("list_year"))
    year = F.nullif(F.regexp_extract(printed, r"(1[5-9]\d\d|20\d\d)", 1), F.lit("")).cast("int")
    title = F.btrim(F.regexp_replace(t("title"), UNCERTAIN_END, ""), F.lit(" .,"))
    kept = items.filter((t("error") == "") & (t("title") != "") & year.between(*years))
    made = kept.select(order, t("author").alias("author"), title.alias("title"), year.cast("string").alias("year"), year.alias("year_num"), t("collation").alias("extent"), *imprint)
    keyed = made.withColumns({"_s": X.surname(F.col("author")), "_t": X.title_key(F.col("title"))})
    return dedupe.first_wins(keyed, ["_s", "_t", "year_num"], order).drop("_s", "_t")


def archive_items(items: DataFrame, fixes: DataFrame | None = None) -> DataFrame:
    """Items of an archive chosen by hand as common records: identifier, author, title, year, year_num, publisher, extent, links, place_in.

    items: identifier, creator, title, date, publisher, imagecount. A creator of two to four words without a comma is a person, turned
    round, unless a word makes it a body. fixes: (identifier, author, title), null where nothing is to be corrected.
    """
    t = lambda c: F.regexp_replace(F.btrim(F.coalesce(F.col(c).cast("string"), F.lit(""))), r"\s+", " ")
    words = F.split(t("creator"), " ")
    person = ~t("creator").rlike(BODY) & ~t("creator").contains(",") & F.size(words).between(2, 4)
    turned = F.concat(F.element_at(words, -1), F.lit(", "), F.array_join(F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))), " "))
    year = F.nullif(F.regexp_extract(t("date"), r"(1[6-9]\d\d|20\d\d)", 1), F.lit(""))
    images = F.when(F.coalesce(F.col("imagecount"), F.lit(0)) > 0, F.concat(F.col("imagecount").cast("string"), F.lit(" images"))).otherwise("")
    out = items.select(
        "identifier", F.when(person, turned).otherwise(t("creator")).alias("author"), t("title").alias("title"), F.coalesce(year, F.lit("n.d.")).alias("year"), year.cast("int").alias("year_num"), t("publisher").alias("publisher"), images.alias("extent"),
        F.array(F.concat(F.lit("https://archive.org/details/"), "identifier")).alias("links"), F.concat(F.lit("archive.org item "), "identifier", F.lit(", chosen by hand")).alias("place_in"),
    )
    return out if fixes is None else publish.overridden(out, fixes, "identifier", ["author", "title"])
