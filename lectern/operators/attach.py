"""Attaching copies: by key, by identifier, by verdict; splitting matches by edition; ordering links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions import text as X
from lectern.functions import agreement as A
from lectern.operators.linkage import TOLERANCE, kind_of
from lectern.plans.workspace import materialize

_NONE = "array<string>"


def no_strings() -> Column:
    return F.array().cast(_NONE)


def attach_by_key(rows: DataFrame, links: DataFrame, key: str = "rowkey", url: str = "url") -> DataFrame:
    """rows with each link appended to every row of its key that does not have it yet; links is many to many by key."""
    order = "ord" if "ord" in links.columns else url
    found = links.groupBy(key).agg(F.array_sort(F.collect_set(F.struct(F.col(order).alias("o"), F.col(url).alias("u")))).alias("_f")).select(key, F.transform("_f", lambda s: s["u"]).alias("_new"))
    joined = rows.join(found, key, "left")
    more = F.when(F.col("_new").isNull(), F.col("links")).otherwise(F.array_distinct(F.concat(F.coalesce("links", no_strings()), "_new")))
    return joined.withColumn("links", more).drop("_new").select(*rows.columns)


def lost(rows: DataFrame, links: DataFrame, key: str = "rowkey") -> DataFrame:
    """Links whose key no row has."""
    return links.join(rows.select(key).distinct(), key, "left_anti")


def attach_by_identifier(rows: DataFrame, records: DataFrame, id_col: str = "id") -> DataFrame:
    """(record columns, row id): the first row that links to the record's archive identifier."""
    own = rows.select(F.col(id_col).alias("row"), F.explode(X.archive_ids(F.col("links"))).alias("identifier"))
    return records.join(own, "identifier").groupBy(*records.columns).agg(F.min("row").alias("row"))


def with_titles_agree(pairs: DataFrame, name: str, title_a: str, author_a: str, title_b: str, author_b: str, strict: Column) -> DataFrame:
    """pairs with a column that tells whether two descriptions, as printed, are of one work.

    Most of one title proper must be in the other title, and small numbers must not contradict one another. Then a shared author
    settles it; or four words in common, in whole titles or in titles proper; else, where both have a subtitle, two fifths of
    either; else the titles proper with three words, unless strict, or that one of the two has no author to contradict.
    Words are written as a table before they are compared, so that no step works them out again.
    """
    c = lambda stem, side: F.col(f"_agree_{stem}{side}")
    sides = {1: (title_a, author_a), 2: (title_b, author_b)}

    def step(df: DataFrame, **made) -> DataFrame:
        return df.withColumns({f"_agree_{stem}{k}": of(k) for stem, of in made.items() for k in sides})

    df = pairs.withColumn("_agree_strict", strict)
    df = step(df, title=lambda k: F.coalesce(F.col(sides[k][0]), F.lit("")), author=lambda k: F.coalesce(F.col(sides[k][1]), F.lit("")))
    df = step(df, head=lambda k: F.split(c("title", k), A.RESPONSIBLE, 2)[0])
    df = step(df, first=lambda k: F.regexp_extract(c("head", k), A.SUBTITLE, 1), second=lambda k: F.regexp_extract(c("head", k), A.SUBTITLE, 2))
    df = step(df, proper=lambda k: A.words_in(X.norm(F.when(c("first", k) != "", c("first", k)).otherwise(c("head", k)))), sub=lambda k: A.words_in(X.norm(c("second", k))))
    df = step(df, p=lambda k: A.telling(c("proper", k)), s=lambda k: A.telling(c("sub", k)), by=lambda k: X.surname(c("author", k)), every=lambda k: A.words_in(X.norm(F.concat_ws(" ", c("author", k), c("title", k)))))
    df = materialize(df, "words")
    df = step(df, f=lambda k: F.concat(c("p", k), c("s", k)))
    df = step(df, small=lambda k: F.array_distinct(F.filter(c("f", k), lambda w: w.rlike("^0*[0-9]{1,2}$"))))
    only = lambda k: F.size(F.array_except(c("small", k), c("small", 3 - k)))
    df = step(df, found=lambda k: A.share(c("p", k), c("f", 3 - k)))
    df = materialize(df, "shares")
    contradict = (F.size(c("small", 1)) > 0) & (F.size(c("small", 2)) > 0) & (only(1) > 0) & (only(2) > 0)
    both = (c("by", 1) != "") & (c("by", 2) != "")
    named = [(c("by", k) != "") & F.array_contains(c("every", 3 - k), c("by", k)) for k in sides]
    shorter = F.size(c("f", 1)) <= F.size(c("f", 2))
    df = df.withColumns({
        "_agree_possible": (F.size(c("p", 1)) > 0) & (F.size(c("p", 2)) > 0) & ~contradict & (F.greatest(c("found", 1), c("found", 2)) >= 0.8),
        "_agree_both": both,
        "_agree_named": named[0] | named[1] | (both & (A.similarity(c("by", 1), c("by", 2)) >= 0.8)),
        "_agree_short": F.when(shorter, c("f", 1)).otherwise(c("f", 2)),
        "_agree_long": F.when(shorter, c("f", 2)).otherwise(c("f", 1)),
    })
    df = materialize(df, "settled")
    # what is settled is not compared any further
    open_ = F.col("_agree_possible") & ~F.col("_agree_named")
    asked = lambda words: F.when(open_, words).otherwise(F.array().cast("array<string>"))
    df = df.withColumn("_agree_common", (F.size("_agree_short") >= 4) & (A.share(asked(F.col("_agree_short")), F.col("_agree_long")) >= 0.8))
    df = step(df, own=lambda k: A.share(asked(c("p", k)), c("p", 3 - k)), sub_own=lambda k: A.share(asked(c("s", k)), c("s", 3 - k)))
    proper = F.least(c("own", 1), c("own", 2)) >= 0.8
    words = F.least(F.size(c("p", 1)), F.size(c("p", 2)))
    subtitles = F.greatest(c("sub_own", 1), c("sub_own", 2)) >= 0.4
    rest = F.when((F.size(c("s", 1)) > 0) & (F.size(c("s", 2)) > 0), subtitles).otherwise((proper & (words >= 3) & ~F.col("_agree_strict")) | ~F.col("_agree_both"))
    agrees = F.col("_agree_possible") & (F.col("_agree_named") | F.col("_agree_common") | (proper & (words >= 4)) | rest)
    return df.withColumn(name, agrees).select(*(x for x in pairs.columns if x != name), name)


def verified_by_identifier(rows: DataFrame, records: DataFrame, id_col: str = "id") -> DataFrame:
    """(identifier, row, agrees) of each record(identifier, r_title, r_author) whose copy a row links to: whether the two describe
    one work. Parts of works are held to the strict rule. rows: id_col, author, title, type, links."""
    found = attach_by_identifier(rows, records.select("identifier", "r_title", "r_author"), id_col)
    named = found.join(rows.select(F.col(id_col).alias("row"), "author", "title", "type"), "row")
    strict = F.coalesce(kind_of(F.col("type")) == "part", F.lit(False))
    return with_titles_agree(named, "agrees", "title", "author", "r_title", "r_author", strict).select("identifier", "row", "agrees")


def without_false_links(rows: DataFrame, records: DataFrame, id_col: str = "id") -> DataFrame:
    """rows without the archive links whose record describes another work."""
    wrong = verified_by_identifier(rows, records, id_col).filter(~F.col("agrees"))
    return remove_links(rows, wrong.select(F.col("row").alias(id_col), F.concat(F.lit("https://archive.org/details/"), "identifier").alias("url")), id_col)


#: Letters of an anchor, by which identifiers find the texts that may contain them.
ANCHOR = 6


def containing(rows: DataFrame, records: DataFrame, part: str = "identifier", id_col: str = "id") -> DataFrame:
    """As attach_by_identifier, by substring: an identifier that starts another one matches it too; of several rows the first.

    Each identifier has one anchor, its run of ANCHOR letters (or it itself, if it is shorter) that fewest texts have; a text meets the
    identifiers whose anchors it has, and only those are looked for in it. An empty identifier is in every row's links, a null one in
    none. Rows without links have an empty text.
    """
    own = rows.select(F.col(id_col).alias("row"), F.array_join(F.coalesce("links", no_strings()), "\n").alias("_all"))
    named = records.select(part).filter(F.col(part) != "").distinct()
    lengths = [r[0] for r in named.select(F.least(F.length(part), F.lit(ANCHOR)).alias("n")).distinct().collect()]  # ANCHOR at most
    runs = lambda c, n: F.transform(F.sequence(F.lit(1), F.length(c) - n + 1), lambda i: F.substring(c, i, F.lit(n) if isinstance(n, int) else n))
    some = F.array_distinct(F.concat(no_strings(), *(F.when(F.length("_all") >= n, runs(F.col("_all"), n)).otherwise(no_strings()) for n in sorted(lengths))))
    texts = own.select("row", F.explode(some).alias("_anchor"))
    counts = texts.groupBy("_anchor").agg(F.count(F.lit(1)).alias("_c"))
    size = F.least(F.length(part), F.lit(ANCHOR))
    mine = named.select(part, F.explode(F.array_distinct(runs(F.col(part), size))).alias("_anchor")).join(counts, "_anchor", "left")
    anchors = mine.groupBy(part).agg(F.min(F.struct(F.coalesce("_c", F.lit(0)).alias("c"), F.col("_anchor").alias("a"))).alias("_m")).filter("_m.c > 0").select(part, F.col("_m.a").alias("_anchor"))
    met = texts.join(anchors, "_anchor").select("row", part).join(own, "row").filter(F.col("_all").contains(F.col(part)))
    first = met.groupBy(part).agg(F.min("row").alias("row"))
    if not records.filter(F.col(part) == "").isEmpty():
        first = first.unionByName(own.agg(F.min("row").alias("row")).filter("row IS NOT NULL").select(F.lit("").alias(part), "row"))
    return records.distinct().join(first, part).select(*records.columns, "row")


def remove_links(rows: DataFrame, false_links: DataFrame, id_col: str = "id", url: str = "url") -> DataFrame:
    """rows without the links shown to be wrong."""
    wrong = false_links.groupBy(id_col).agg(F.collect_set(url).alias("_wrong"))
    kept = F.when(F.col("_wrong").isNull() | F.col("links").isNull(), F.col("links")).otherwise(F.array_except("links", F.coalesce("_wrong", no_strings())))
    return rows.join(wrong, id_col, "left").withColumn("links", kept).select(*rows.columns)


def usable(matches: DataFrame, access: DataFrame) -> DataFrame:
    """Matches that can be read or borrowed, or whose access is unknown, with their access."""
    known = access.select("identifier", X.offered_access(F.col("access"), F.col("inlibrary")).alias("access"))
    return matches.join(known, "identifier", "left").withColumn("access", F.coalesce("access", F.lit("unknown"))).filter("access <> 'restricted'")


def split_editions(matches: DataFrame, tolerance: int = TOLERANCE) -> DataFrame:
    """matches with edition: 'same', 'other', or null where a match proves nothing.

    matches: years (array), type, author, title_words (size of the title key), m_year, m_creator, m_score. A match dated within
    tolerance of any year is the same edition; of a periodical, any from its first year on; an undated one needs a personal
    author; a short title without creator never counts.
    """
    near = F.exists("years", lambda y: F.abs(F.col("m_year") - y) <= tolerance)
    serial = (F.col("type") == "periodical") & (F.size("years") > 0) & (F.col("m_year") >= F.array_min("years") - tolerance)
    personal = X.surname(F.col("author")) != ""
    creator = F.coalesce("m_creator", F.lit("")) != ""
    edition = (
        F.when((F.col("title_words") < 4) & ~creator, None)
        .when(F.col("m_year").isNull(), F.when(personal, "same"))
        .when(near | serial, "same")
        .when(personal & creator & (F.col("m_score") >= 0.95), "other")
    )
    return matches.withColumn("edition", edition)


def fallback(strict: Column, others: Column, loose: Column) -> Column:
    """Loose matches where the strict pass ran and gave neither links nor editions."""
    empty = strict.isNotNull() & (F.size(strict) == 0) & (F.coalesce(F.size(others), F.lit(0)) <= 0)
    return F.when(empty, F.coalesce(loose, no_strings())).otherwise(strict)


def with_verdicts(hits: DataFrame, decisions: DataFrame, record: str, candidate: str, points: str = "points", least: float = 3) -> DataFrame:
    """One accepted hit a record: (record, candidate, verdict yes or edition, by hand or score).

    The first hit with a hand verdict of yes or edition wins; else the best score from least on, first on a tie, unless that
    very hit was refused. hits: record, candidate, pos, points. decisions: record, candidate, verdict.
    """
    judged = hits.join(decisions.dropDuplicates([record, candidate]), [record, candidate], "left")
    hand = F.min(F.when(F.col("verdict").isin("yes", "edition"), F.struct("pos", candidate, "verdict")))
    best = F.max_by(F.struct(candidate, points, "verdict"), F.struct(F.col(points), -F.col("pos")))
    out = judged.groupBy(record).agg(hand.alias("h"), best.alias("b"))
    scored = (F.col(f"b.{points}") >= least) & (F.coalesce("b.verdict", F.lit("")) != "no")
    return out.select(
        record,
        F.when(F.col("h").isNotNull(), F.col(f"h.{candidate}")).when(scored, F.col(f"b.{candidate}")).alias(candidate),
        F.when(F.col("h").isNotNull(), F.col("h.verdict")).when(scored, "yes").alias("verdict"),
        F.when(F.col("h").isNotNull(), "hand").when(scored, "score").alias("by"),
    ).filter("verdict IS NOT NULL")


def top_candidates(hits: DataFrame, record: str, k: int, *order: Column) -> DataFrame:
    """The k best hits of each record; on equal terms, by the columns given last."""
    return hits.withColumn("_n", F.row_number().over(Window.partitionBy(record).orderBy(*order))).filter(F.col("_n") <= k).drop("_n")


def first_stage(hits: DataFrame, record: str, stage: str = "stage") -> DataFrame:
    """Hits of each record's first stage that has any: a ladder of searches, from the strictest."""
    least = hits.groupBy(record).agg(F.min(stage).alias("_least"))
    return hits.join(least, record).filter(F.col(stage) == F.col("_least")).drop("_least")


def ordered_links(links: Column, access: Column, checked: Column) -> Column:
    """array<struct(url, access, checked)>: checked by hand first, then open, borrow, restricted, unknown, then as they stood.

    access: map from archive identifier to access; checked: map from address to access. Links elsewhere count as open.
    """
    ranks = F.create_map(*(F.lit(x) for pair in (("open", 0), ("borrow", 1), ("restricted", 2), ("unknown", 3)) for x in pair))
    known = lambda u: F.coalesce(checked[u], F.when(u.contains("archive.org/details/"), F.coalesce(access[X.last_segment(u)], F.lit("unknown"))).otherwise("open"))
    made = F.transform(F.coalesce(links, no_strings()), lambda u, i: F.struct(checked[u].isNull().alias("later"), ranks[known(u)].alias("rank"), i.alias("i"), u.alias("url"), known(u).alias("access")))
    return F.transform(F.array_sort(made), lambda s: F.struct(s["url"].alias("url"), s["access"].alias("access"), (~s["later"]).alias("checked")))
