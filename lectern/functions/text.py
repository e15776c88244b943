"""Text functions on columns, JVM-side: folding, keys, title and name parts, years, links.

Each takes and returns a Column, so Catalyst sees one expression tree. Java's regular expressions get (?U) where classes and
boundaries are to be Unicode's.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that carry no meaning in a title, by use.
TITLE_STOP = (
    "the a an of and in on to for by with from its their his her de la le les du des et en der die das und von zu im dem den "
    "des el los las y del il di e da do dos das van het een au aux sur à zur zum ein eine or not ou oder och og"
).split()
#: Fixed value: the years that catalogues print.
YEAR = r"(?<!\d)(1[5-9]\d\d)(?!\d)"
YEAR_LATE = r"(?<!\d)(1[5-9]\d\d|20[0-2]\d)(?!\d)"
#: Fixed value: where a statement of responsibility starts.
RESPONSIBILITY = r"(?U)\s+(?:Tr\.|Trans\.|Translated|Ed\.|Edited|Text by|Comp\.|Compiled|With an? |Illus\.|Tr by|Uebers|Übers|Trad\.)"
RESPONSIBILITY_TAIL = (
    r"(?iu),\s+(?:trs?\.|ed\.|rev\.|illus\.|with |foreword|introduction|preface|préface|compiled|adapted|authorized|pub\.|"
    r"from the |avec |traduits?|übersetzt|aus dem |mit |collotypes)|\s+\((?:formerly|traduction)"
)
#: Holders of digitised copies by a part of the address.
HOLDERS = {
    "archive.org/": "IA",
    "gallica.bnf.fr/": "G",
    "dl.ndl.go.jp/": "NDL",
    "bne.es/": "BNE",
    "europeana.eu/": "EU",
    "nb.no/": "NB",
    "alvin-portal.org/": "Alvin",
    "onlinebooks.library.upenn.edu/": "OB",
    "hathitrust.org/": "H",
    "gutenberg.org/": "PG",
}


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value worked out once for a row, however often and inside whatever loop it is used. No Python UDF can be in it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


@functools.cache
def _fold_tables() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """From NFKD: characters that become one character, and those that become several; combining marks are left out of both."""
    one, to, several = [], [], []
    for code in (*range(0x80, 0x2000), *range(0x2000, 0x2200), *range(0x2460, 0x2500), *range(0x3300, 0x3400), *range(0xF900, 0xFFF0)):
        c = chr(code)
        if unicodedata.combining(c):
            continue
        d = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if len(d) == 1 and d != c:
            one.append(c)
            to.append(d)
        elif len(d) > 1 and any("0" <= x <= "9" or "A" <= x.upper() <= "Z" for x in d) and (code < 0x2460 or 0xFB00 <= code <= 0xFB06):
            several.append((c, d))
    return "".join(one), "".join(to), tuple(several)


def fold(c: Column, marks: str = r"[̀-ͯ᪰-᫿᷀-᷿⃐-⃰︠-︯]") -> Column:
    """Without diacritics: NFKD, combining marks dropped. A translate() table built from the Unicode data; the few characters
    that expand (ligatures, fractions) are replaced first, where the text has any.

    functions.udfs.fold_exact covers all of Unicode; the two agree on Latin text."""
    one, to, several = _fold_tables()
    there = "[" + "".join(a for a, _ in several) + "]"
    table = F.create_map(*(F.lit(x) for pair in several for x in pair))
    # letter by letter, so the expression stays small; few texts have any
    wide = lambda s: F.array_join(F.transform(F.split(s, ""), lambda x: F.coalesce(table[x], x)), "")
    spread = once(c, lambda s: F.when(s.rlike(there), wide(s)).otherwise(s))
    return F.regexp_replace(F.translate(spread, one, to), marks, "")


def norm(c: Column) -> Column:
    """The form that keys are made of: folded, lower case, runs of anything but a-z and 0-9 as one space, trimmed."""
    return F.btrim(F.regexp_replace(F.lower(fold(c)), "[^a-z0-9]+", " "))


def search_fold(c: Column) -> Column:
    """For searching: decomposed, marks U+0300 to U+036F dropped, lower case; punctuation stays."""
    return F.lower(fold(c, r"[\u0300-\u036f]"))


def row_key(author: Column, title: Column, year: Column) -> Column:
    """An entity's key: author, title and year as printed."""
    return F.concat_ws("|", *(norm(F.coalesce(x, F.lit(""))) for x in (author, title, year)))


def link_key(author: Column, title: Column) -> Column:
    return F.concat_ws("|", norm(F.coalesce(author, F.lit(""))), norm(F.coalesce(title, F.lit(""))))


def main_title(c: Column, responsibility: bool = True) -> Column:
    """The title proper: up to a statement of responsibility (unless titles are known to have none), then the first ; or : after
    12 characters, else the first full stop after 20."""
    head = F.split(c, RESPONSIBILITY, 2)[0] if responsibility else c
    found = lambda h, pattern: once(F.regexp_extract(h, pattern, 1), lambda x: F.when(x != "", x))
    return F.btrim(once(head, lambda h: F.coalesce(found(h, r"^(.{12,}?)[;:]\s"), found(h, r"^(.{20,}?)\.\s"), h)), F.lit(" .,;:"))


def title_proper(c: Column) -> Column:
    """main_title after dropping a tail of responsibility in lower case and the marks of omitted words."""
    return main_title(F.regexp_replace(F.split(c, RESPONSIBILITY_TAIL, 2)[0], r"\s+\.\s\.\s\.\s*", " "))


def candidate_title(c: Column) -> Column:
    """Of a search result's title, what stands before the first : ; / or dash set off by spaces."""
    return F.split(c, r"(?U)\s[:/]\s|;|\s[-–—]\s|\s?:\s", 2)[0]


def title_key(c: Column, responsibility: bool = True) -> Column:
    return norm(main_title(c, responsibility))


def _tokens(normed: Column) -> Column:
    return F.filter(F.split(normed, " "), lambda w: w != "")


def significant_words(c: Column, stop: list[str] = TITLE_STOP, least: int = 2, digits: bool = False) -> Column:
    """Words of at least `least` letters that are not stop words; with digits, numbers of any length too."""
    own = F.array(*map(F.lit, sorted(set(stop))))
    long = lambda w: (F.length(w) >= least) | (w.rlike("^[0-9]+$") if digits else F.lit(False))
    return F.filter(_tokens(norm(c)), lambda w: long(w) & ~F.array_contains(own, w))


def query_words(c: Column, n: int) -> Column:
    """The first n significant words, or of all words of two letters if fewer than two are significant."""
    every, telling = F.filter(_tokens(norm(c)), lambda w: F.length(w) > 1), significant_words(c)
    return F.slice(F.when(F.size(telling) >= 2, telling).otherwise(every), 1, n)


def surname(c: Column, raw_words: bool = False, strip_brackets: bool = True, plain_names: bool = False) -> Column:
    """Last word of what stands before the first comma, if that has three words at most; '' otherwise.

    raw_words counts the words as printed; plain_names takes the last word of a name of up to three words without a comma.
    """
    a = F.btrim(F.coalesce(c, F.lit("")))
    a = F.regexp_replace(a, r"^\(|\)$", "") if strip_brackets else a
    head = F.substring_index(a, ",", 1)
    words = _tokens(norm(head))
    count = F.size(F.filter(F.split(F.btrim(head), r"\s+"), lambda w: w != "")) if raw_words else F.size(words)
    inverted = F.when((F.size(words) > 0) & (count <= 3), F.element_at(words, -1)).otherwise("")
    if plain_names:
        whole = _tokens(norm(a))
        return F.when(a.contains(","), inverted).when(F.size(whole).between(1, 3), F.element_at(whole, -1)).otherwise("")
    return F.when(a.contains(","), inverted).otherwise("")


def surnames(c: Column, between: str = r";| and ") -> Column:
    """The surname of each of several names: the last word before the comma, or of the whole name."""
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), between), lambda p: F.btrim(p))
    heads = F.transform(parts, lambda p: F.when(p.contains(","), F.substring_index(p, ",", 1)).otherwise(F.element_at(F.split(p, r"\s+"), -1)))
    last = F.transform(heads, lambda h: F.regexp_extract(norm(h), "([^ ]+)$", 1))
    return F.filter(last, lambda w: w != "")


#: Words that make a heading a body's, not a person's.
CORPORATE = (
    r"(?iU)\b(society|office|department|dept|japan|company|co|inc|press|university|bureau|commission|library|museum|association|"
    r"board|church|mission|missions|government|ministry|institute|committee|united|states|railways?|hotel|firm|group|deputation|"
    r"kaisha|kyokai|kōsha|of|the|and|for|club|bank|league|army|navy|council)\b|[&(\[]|[a-z]{3,}\.(\s|$)"
)


def invert_name(c: Column) -> Column:
    """'First Second Last' as 'Last, First Second', for two to four words; bodies and names with a comma stay."""
    name = F.btrim(c)
    words = F.split(name, r"\s+")
    turned = F.concat(F.element_at(words, -1), F.lit(", "), F.array_join(F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))), " "))
    plain = ~name.contains(",") & ~name.rlike(CORPORATE) & F.size(words).between(2, 4)
    return F.when(F.lower(name).isin("", "not available"), "").when(plain, turned).otherwise(name)


def years_in(c: Column, pattern: str = YEAR) -> Column:
    """All years in a text, in order, as integers."""
    return F.transform(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(pattern), F.lit(1)), lambda y: y.cast("int"))


def tail_year(c: Column) -> Column:
    """The end of a span written short: 1875 for 1874-75, 1906 for 1905-6; null without one."""
    text = F.coalesce(c, F.lit(""))
    parts = r"(1[89]\d\d)\s*[-–]\s*(\d{1,2})(?!\d)"
    a, b = F.regexp_extract(text, parts, 1), F.regexp_extract(text, parts, 2)
    return F.when(a != "", F.concat(F.left(a, F.lit(4) - F.length(b)), b).cast("int"))


def record_years(printed: Column, start: Column) -> Column:
    """Years printed, the year given, and the end of a short span: all that are there."""
    return F.concat(years_in(printed), F.array_compact(F.array(start.cast("int"), tail_year(printed))))


def in_range(years: Column, first: int = 1850, last: int = 1955) -> Column:
    """Whether the span of years meets first..last; null where there is no year."""
    return F.when(F.size(years) > 0, (F.array_min(years) <= last) & (F.array_max(years) >= first))


def first_year(c: Column, pattern: str = YEAR_LATE) -> Column:
    return F.regexp_extract(F.coalesce(c, F.lit("")), pattern, 1).try_cast("int")


def leading_year(year: Column, date: Column) -> Column:
    """A result's year: the year given, else four digits that start its date."""
    return F.coalesce(F.nullif(year, F.lit("")), F.nullif(F.regexp_extract(F.coalesce(date, F.lit("")), r"^(\d{4})", 1), F.lit(""))).try_cast("int")


#: How volumes are written in an extent and in a title.
VOLUME_EXTENT = r"(?i)\(?\d+\)?\s*(?:v\.|vols?\.|sets\.|pts?\. in \d+\s*v\.)(?:\s*in\s*\d+\.?)?(?:\s*\([^)]*\))?"
VOLUME_TITLE = r"\b(?:v\.|vol\.|Bd\.|Band|Tome|Tom|t\.|T\.|Deel|Pt\.|pt\.|Part|Book|Chast'|Heft|Fasciculus|no\.)\s*[IVX\d]+(?:\s*[-–,]\s*[IVX\d]+)*\b"


def volume(extent: Column, title: Column) -> Column:
    """The volume as the extent has it ('2v.' as '2 v.'), else as the title has it, else ''."""
    a = F.regexp_replace(F.btrim(F.regexp_extract(F.coalesce(extent, F.lit("")), VOLUME_EXTENT, 0)), r"(?i)(\d\)?)\s*(v\.|vols?\.)", "$1 $2")
    return F.coalesce(F.nullif(a, F.lit("")), F.btrim(F.regexp_extract(F.coalesce(title, F.lit("")), VOLUME_TITLE, 0)))


#: Fixed value: abbreviations whose full stop stays at a title's end.
ABBREVIATION = r"(?:\b[A-Z]\.|\b(?:etc|Co|Ltd|Inc|Jr|Sr|St|Bros|Bd|Nr|Pt|no|vol|ed|U\.S|U\.S\.S\.R)\.)$"


def trim_stop(c: Column) -> Column:
    """Without the full stop at the end, unless it belongs to an abbreviation or marks an omission."""
    t = F.rtrim(c)
    return F.when(t.endswith(".") & ~t.endswith("..") & ~t.rlike(ABBREVIATION), F.rtrim(F.regexp_replace(t, r"\.$", ""))).otherwise(t)


def holder(url: Column) -> Column:
    """Short code of who holds a copy, '' if unknown."""
    out = F.lit("")
    for part, code in reversed(HOLDERS.items()):
        out = F.when(F.coalesce(url, F.lit("")).contains(part), code).otherwise(out)
    return out


def last_segment(url: Column) -> Column:
    return F.substring_index(url, "/", -1)


def archive_ids(links: Column) -> Column:
    """Identifiers of the archive.org items among links (an array); none for null."""
    own = F.filter(F.coalesce(links, F.array().cast("array<string>")), lambda u: u.contains("archive.org/details/"))
    return F.transform(own, last_segment)


def normal_url(url: Column) -> Column:
    return F.regexp_replace(F.btrim(url), r"^http://(www\.)?archive\.org/", "https://archive.org/")


def reachable(url: Column) -> Column:
    """False for hosts of an internal network."""
    host = F.lower(F.regexp_extract(url, r"^https?://([^/]*)", 1))
    return ~(host.endswith(".local") | host.startswith("localhost"))


def kept_urls(urls: Column, dropped: list[str] = []) -> Column:  # noqa: B006
    """The addresses of a record that can be followed, in their normal form and order, each once: those on the network at large, not
    taken out by hand, and whole ones, not a partner's bare identifier. A null array stays null."""
    normal = F.array_distinct(F.transform(F.filter(urls, lambda u: u.isNotNull()), normal_url))
    out = F.array(*map(F.lit, dropped)).cast("array<string>")
    return F.filter(normal, lambda u: u.startswith("http") & reachable(u) & ~F.array_contains(out, u))


def strip_tags(c: Column) -> Column:
    """Markup out, the five named entities decoded, white space collapsed."""
    out = F.regexp_replace(F.coalesce(c, F.lit("")), r"(?s)<[^>]*>", " ")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(char))
    return F.btrim(F.regexp_replace(out, r"\s+", " "))


def html_escape(c: Column) -> Column:
    out = F.coalesce(c, F.lit(""))
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(char), F.lit(entity))
    return out


def slug(c: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), F.lit("-"))


def mostly_latin(c: Column) -> Column:
    """Whether more than seven tenths of the letters are Latin ones; false without letters."""
    letters = F.length(F.regexp_replace(c, r"[^\p{L}]", ""))
    return F.coalesce(F.length(F.regexp_replace(c, r"[^A-Za-zÀ-ɏ]", "")) / F.nullif(letters, F.lit(0)) > 0.7, F.lit(False))


def bucket_letter(author: Column, title: Column) -> Column:
    """The letter an entry is filed under: of its author, else its title; # if it is none."""
    named = F.when(F.coalesce(author, F.lit("")) != "", author).otherwise(F.coalesce(title, F.lit("")))
    letter = F.left(F.upper(fold(F.regexp_replace(named, r"^[*\[\"'( ]+", ""))), F.lit(1))
    return F.when(letter.rlike(r"^\p{L}$"), letter).otherwise("#")


def is_named(c: Column) -> Column:
    """Whether an edition or volume says what it is, rather than being a bare number."""
    return F.coalesce(c, F.lit("")).rlike("[A-Za-zÀ-ÿ]")


#: Statements of rights that open a copy to all, and lending states that allow a loan.
OPEN_RIGHTS = ["インターネット公開", "Internet"]
LENDABLE = ["is_lendable", "is_borrowable", "is_browsable", "available_to_borrow", "available_to_browse"]


def rights_access(rights: Column) -> Column:
    """open, limited, or unknown without any statement; rights: an array."""
    says = F.exists(rights, lambda r: functools.reduce(lambda x, y: x | y, (r.contains(w) for w in OPEN_RIGHTS)))
    return F.when(F.coalesce(F.size(rights), F.lit(0)) <= 0, "unknown").when(says, "open").otherwise("limited")


def item_access(restricted: Column, lending: Column, found: Column) -> Column:
    """open, borrow, printdisabled-only, or missing where the item was not found; lending: an array of states."""
    lends = F.arrays_overlap(F.coalesce(lending, F.array().cast("array<string>")), F.array(*map(F.lit, LENDABLE)))
    yes = F.lower(F.btrim(F.coalesce(restricted.cast("string"), F.lit("")))).isin("true", "1", "yes")
    return F.when(~found, "missing").when(~yes, "open").when(lends, "borrow").otherwise("printdisabled-only")


def offered_access(access: Column, in_library: Column) -> Column:
    """What a link is labelled: open, borrow, restricted; unknown where never checked. Items of the lending library can be borrowed."""
    return F.when(access.isNull(), "unknown").when(access.isin("open", "borrow"), access).when(F.coalesce(in_library, F.lit(False)), "borrow").otherwise("restricted")


def split_volume(v: Column, year: Column, designation: str = r"(?i)^[^\p{L}\p{N}_]*(?:巻|vol\.?|v\.|no\.|pt\.?|第)?\s*[\dIVXivx一二三四五六七八九十]+\s*(?:巻|編|輯|冊)?[^\p{L}\p{N}_]*$") -> Column:
    """struct(designation, part_title): a volume field holds either; neither where it only repeats the year."""
    text = F.btrim(F.coalesce(v, F.lit("")))
    repeats = text.rlike(r"^\[?\d{4}\]?年?$") & (year.isNull() | (F.regexp_extract(text, r"\d{4}", 0) == year.cast("string")))
    return F.when((text == "") | repeats, F.struct(F.lit("").alias("designation"), F.lit("").alias("part_title"))).when(
        text.rlike(designation), F.struct(text.alias("designation"), F.lit("").alias("part_title"))
    ).otherwise(F.struct(F.lit("").alias("designation"), text.alias("part_title")))


def imprint_parts(other: Column) -> Column:
    """struct(place, publisher, container) from the labelled parts of `other`: a state after the first comma is the place's."""
    # fixed value: abbreviated states
    state = r"(?i)^(?:[A-Z]\.?\s?[A-Z]\.?|D\.?\s?C\.?|Mass|Conn|Calif?|Ill|Pa|Va|Md|Mich|Minn|Wis|Ky|Tenn|Ore|Wash|Ont|Que|N\.?\s?[JYCHMD]|Vt|Ind|Iowa|Kan|Mo|Neb|Ohio|Okla|Tex|Utah|Colo)\.?$"
    imprint = F.btrim(F.regexp_extract(F.coalesce(other, F.lit("")), r"Imprint: ([^|]+)", 1))
    bits = F.filter(F.transform(F.split(imprint, ","), lambda b: F.btrim(b)), lambda b: b != "")
    n = F.size(bits)
    taken = F.when((n > 1) & F.get(bits, F.lit(1)).rlike(state), 2).when(n > 1, 1).when((n == 1) & F.get(bits, F.lit(0)).rlike(state), 1).otherwise(0)
    rest = F.slice(bits, taken + 1, F.greatest(n, F.lit(1)))
    return F.struct(F.array_join(F.slice(bits, F.lit(1), taken), ", ").alias("place"), F.array_join(rest, ", ").alias("publisher"), F.btrim(F.regexp_extract(F.coalesce(other, F.lit("")), r"In: ([^|]+)", 1)).alias("container"))


#: What a catalogue prints where place or publisher is not known; words of a title page's line that are no publisher's
#: name; a date in roman numerals, the end of a phrase.
NO_PLACE, NO_PUBLISHER = r"(?i)^s\.\s*l$", r"(?i)^s\.\s*n$"
NOT_A_NAME = (
    r"(?iU)\b(éditeur|editeur|imprimeur|libraire|chevalier|ancien|successeur|rue |street|strasse|straße|piccadilly|avenue|boulevard|"
    r"printed for|published by|publisher|hofbuchhandlung)"
)
ROMAN_DATE, ROMAN_ONLY = r"\bM\.?D\.?C+[^.,;]*", r"^[MDCLXVI. ]+$"
PHRASE_END = r"\.\s+[A-ZÉÈÀÖÜÄ][a-zà-ÿ]"
#: A publisher's name is taken up to the part that makes it longer than this.
LONG_NAME = 40


def catalogue_imprint(line: Column) -> Column:
    """struct(place, publisher) of an imprint as a catalogue prints it, 'Place : Publisher (Printer's place : Printer)'.

    What stands in the first brackets takes the place of what is unknown outside; alone there, it is the printer. Null counts as empty.
    """
    text, marks = F.coalesce(line, F.lit("")), F.lit(" ,.[]")
    parts = lambda c: F.split(c, ":", 2)
    side = lambda c, k: F.coalesce(F.btrim(F.get(parts(c), F.lit(k)), marks), F.lit(""))
    outer, inner = F.regexp_replace(text, r"\s*\([^)]*\)", ""), F.regexp_extract(text, r"\(([^)]+)\)", 1)
    place = F.regexp_replace(side(outer, 0), NO_PLACE, "")
    publisher = F.regexp_replace(side(outer, 1), NO_PUBLISHER, "")
    printer = F.coalesce(F.nullif(side(inner, 1), F.lit("")), side(inner, 0))
    printed_at = F.when(side(inner, 1) != "", side(inner, 0)).otherwise("")
    return F.struct(F.coalesce(F.nullif(place, F.lit("")), printed_at).alias("place"), F.coalesce(F.nullif(publisher, F.lit("")), printer).alias("publisher"))


def from_shouting(c: Column) -> Column:
    """A text all in capitals with each run of letters as a capital and small ones; any other as it is."""
    runs = F.transform(F.split(c, r"(?<!\p{L})(?=\p{L})"), lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.lower(F.substring(w, F.lit(2), F.length(w)))))
    return F.when((c == F.upper(c)) & c.rlike(r"\p{L}"), F.array_join(runs, "")).otherwise(c)


def title_page_imprint(line: Column) -> Column:
    """struct(place, publisher) of an imprint line as a title page has it, with addresses, standings and dates, none of which is a name.

    Place is the first part, each part cut where a phrase ends; publisher the next ones that can be names, up to LONG_NAME letters and the part that passes
    it. Null counts as empty.
    """
    undated = F.coalesce(line, F.lit(""))
    for pattern in (r"\[\d{4}[^\]]*\]", ROMAN_DATE, r"(?<!\d)\d{4}(?!\d)"):
        undated = F.regexp_replace(undated, pattern, " ")
    bare = lambda c, marks: F.btrim(c, F.lit(marks))
    bits = F.filter(F.transform(F.split(undated, "[:,;]"), lambda b: bare(b, " .,:;")), lambda b: b != "")
    phrases = F.transform(bits, lambda b: bare(F.get(F.split(b, PHRASE_END, 2), F.lit(0)), " .,"))
    names = F.filter(F.slice(phrases, F.lit(2), F.greatest(F.size(phrases), F.lit(1))), lambda b: (F.length(b) >= 3) & ~b.rlike(r"\d") & ~b.rlike(ROMAN_ONLY) & ~b.rlike(NOT_A_NAME))
    joined = F.aggregate(names, F.lit(""), lambda all_, b: F.when(F.length(all_) > LONG_NAME, all_).otherwise(F.concat_ws(", ", F.nullif(all_, F.lit("")), b)))
    shown = lambda c: F.btrim(from_shouting(F.regexp_replace(c, r"\s+", " ")))
    return F.struct(shown(F.coalesce(F.get(phrases, F.lit(0)), F.lit(""))).alias("place"), shown(joined).alias("publisher"))


#: What an author's statement may end in; where the first of several names ends; words that make a name a body's.
STATEMENT = r"(?i),?\s+(eds?\.|trs?\.|comps?\.|ed\.\s*(?:and|&)\s*trs?\.)$"
NEXT_NAME = r"\s*(?:,\s*)?(?:&|\band\b)\s+|,\s+"
BODIES = (
    r"(?i)\b(?:Ministry|Bureau|Office|Association|Institute|Society|Department|Commission|University|Press|Government|Command|Section|Committee|Council|"
    r"Agency|Corps|Service|Headquarters|Nations|States|Library|Museum|Company|Board|Staff|Conference)\b"
)


def first_inverted(c: Column, any_case: bool = True) -> Column:
    """'Ann Roe & Bob Poe, eds.' as 'Roe, Ann & Bob Poe, eds.': only the first name of a list is turned, and no body's. any_case: whether
    words that make a name a body's do so without their capital, too."""
    name = F.btrim(F.coalesce(c, F.lit("")))
    ending = F.regexp_extract(name, STATEMENT, 1)
    names = F.when(ending != "", F.btrim(F.regexp_replace(name, STATEMENT, ""))).otherwise(name)
    first = F.get(F.split(names, NEXT_NAME, 2), F.lit(0))
    words = F.split(F.btrim(first), r"\s+")
    turned = F.concat(F.element_at(words, -1), F.lit(", "), F.array_join(F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))), " "))
    bodies = BODIES if any_case else BODIES.removeprefix("(?i)")
    head = F.when(F.size(words).between(2, 4) & ~first.rlike(bodies), turned).otherwise(first)
    return F.btrim(F.concat(head, F.substring(names, F.length(first) + 1, F.length(names)), F.when(ending != "", F.concat(F.lit(", "), ending)).otherwise("")))


#: The year before each era's first, and numerals.
ERAS = {"明治": 1867, "大正": 1911, "昭和": 1925, "慶応": 1864, "元治": 1863, "文久": 1860, "万延": 1859, "安政": 1853}
NUMERALS = {"元": 1, "一": 1, "二": 2, "三": 3, "四": 4, "五": 5, "六": 6, "七": 7, "八": 8, "九": 9, "十": 10}
ERA_DATE = f"({'|'.join(ERAS)})" + r"\s*([0-9]+|元|[一二三四五六七八九十]+)"


def _looked_up(table: dict[str, int], c: Column, default: int) -> Column:
    return F.coalesce(F.create_map(*(F.lit(x) for pair in table.items() for x in pair))[c], F.lit(default))


def numeral(c: Column) -> Column:
    """Arabic digits, or numerals of tens and ones, as a number; 0 for what is neither."""
    before, after = F.substring_index(c, "十", 1), F.substring_index(c, "十", -1)
    tens = F.when(before == "", 1).otherwise(_looked_up(NUMERALS, before, 1))
    return F.when(c.rlike("^[0-9]+$"), c.try_cast("int")).when(c.contains("十"), tens * 10 + _looked_up(NUMERALS, after, 0)).otherwise(_looked_up(NUMERALS, c, 0))


def _era_years(c: Column) -> Column:
    """The Gregorian year of each era date of a text; null for one whose number is none."""
    eras, numbers = (F.regexp_extract_all(c, F.lit(ERA_DATE), F.lit(k)) for k in (1, 2))
    return F.zip_with(eras, numbers, lambda era, n: F.when(numeral(n) > 0, _looked_up(ERAS, era, 0) + numeral(n)))


def to_western(c: Column) -> Column:
    """Era dates as Gregorian years; the rest stays. The text between the dates is joined with their years."""
    text, dated = F.coalesce(c, F.lit("")), ERA_DATE + r"\s*年?"
    printed = F.regexp_extract_all(text, F.lit(dated), F.lit(0))
    years = F.zip_with(_era_years(text), printed, lambda year, whole: F.coalesce(year.cast("string"), whole))
    return F.array_join(F.zip_with(F.split(text, dated, -1), F.concat(years, F.array(F.lit(""))), lambda between, year: F.concat(between, year)), "")


def western_year(*values: Column) -> Column:
    """The first Gregorian year in any of the values, else the first era date's."""
    era = lambda c: F.get(F.filter(_era_years(F.coalesce(c, F.lit(""))), lambda y: y.isNotNull()), F.lit(0))
    return F.coalesce(*(first_year(c) for c in values), *map(era, values))


#: What may stand around a word of a title; words that stay small inside a title (the casing UDF has the same).
AROUND_WORDS = "\"'([{,.;:!?)]}‘’“”"
SMALL = (
    "a an the and but or nor for of in into on onto to from by with without at as over under after before between through during "
    "against about above across along among around per via vs versus is"
).split()


def from_capitals(c: Column, forms: dict[str, str] | None = None) -> Column:
    """A title printed in capitals in ordinary form; one with a small letter stays as it is. forms: lower-case words with a form of
    their own, also before 's. Small words are small but at the start, after a colon, or after a mark that stands alone."""
    own = F.create_map(*(F.lit(x) for pair in forms.items() for x in pair)) if forms else F.lit(None).cast("map<string,string>")
    small = F.array(*map(F.lit, SMALL))
    capital = lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substring(w, F.lit(2), F.length(w)))
    within = lambda w: F.when(F.array_contains(small, w), w).otherwise(capital(w))
    rest_of = lambda w, n: F.substring(w, F.lit(n + 1), F.length(w))

    def split(t: Column) -> Column:
        bare = F.rtrim(F.regexp_replace(t, r"\s+", " "))
        word = F.btrim(bare, F.lit(AROUND_WORDS))
        at = F.when(word == "", F.length(bare)).otherwise(F.call_function("locate", word, bare) - 1)
        return F.struct(t.alias("printed"), word.alias("word"), at.alias("at"), F.substring(t, at + F.length(word) + 1, F.length(t)).alias("after"))

    tokens = F.transform(F.split(c, r"(?<=\s)(?=\S)"), split)

    def shaped(x: Column, before: Column) -> Column:
        opens = before.isNull() | (before["word"] == "") | F.rtrim(before["after"]).endswith(":")
        low = F.lower(x["word"])
        stem = F.when(low.endswith("'s"), F.left(low, F.length(low) - 2))
        parts = F.split(low, "-")
        joined = F.array_join(F.concat(F.array(capital(parts[0])), F.transform(F.slice(parts, F.lit(2), F.size(parts)), within)), "-")
        new = (
            F.when(own[low].isNotNull(), own[low])
            .when(own[stem].isNotNull(), F.concat(own[stem], F.lit("'s")))
            .when(~opens & F.array_contains(small, low), low)
            .when(low.startswith("mc") & (F.length(low) > 3), F.concat(F.lit("Mc"), capital(rest_of(low, 2))))
            .otherwise(joined)
        )
        return F.when(x["word"] == "", x["printed"]).otherwise(F.concat(F.substring(x["printed"], F.lit(1), x["at"]), new, x["after"]))

    all_ = lambda ts: F.array_join(F.transform(ts, lambda x, i: shaped(x, F.get(ts, i - 1))), "")
    return F.when((c == "") | (c != F.upper(c)), c).otherwise(F.transform(F.array(tokens), all_)[0])
